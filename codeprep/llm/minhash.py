"""Near copies by circulant MinHash: links at a Jaccard similarity of shingle sets, and groups.

A document's set holds its distinct shingles of ``SHINGLE`` words, as 64-bit hashes. Two
permutations of the 2^32 places give all coordinates of its signature: the first deals the
shingles out to places, the second orders the places and is shifted circularly by one for each
further coordinate, which is the smallest order of the set under that shift. ``BANDS`` bands of
``ROWS`` coordinates are cut from it. Sets that agree in a band are candidates; at a similarity
of 0.8 a pair agrees in none with probability 5e-8. All that follows is exact.

Equal sets are one. Of a band shared by several sets, the bucket, each is first compared with
one of them, its pivot: as many pairs as members, whatever the bucket's size. Only
buckets that these links leave in several components are looked at again, across components:
all pairs if a bucket has at most ``BUCKET`` members; in larger ones those that the pivot P does
not rule out. A set differs from P in u elements that no other set of a large bucket has, and in
v others, which a map of 256 bits shows. Two sets share no more of their differences than the
smaller v, nor than the bits that both maps have; all others set them apart, which most pairs
cannot afford.

A pair is ruled out before its sets are fetched if their sizes are too far apart, or counts of
their elements by 7 bits of hash are; both are bounds and lose nothing. All others are
confirmed on the full sets, which are made again from the texts of the sets concerned. Buckets
are joined by key, so Spark splits large ones, and counts are combined before their shuffle.

Null texts have no words. Documents without words have the empty set and link with nothing.
Rows without an id, or of one id, are told apart by their sets: a null id is never a
component's id, and a component of only null ids has none. ``kept`` is true where the id is the
component's, null with null. Repeated rows get the same result. Further columns are not looked
at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays, bitmaps
from codeprep.llm.components import connected_components
from codeprep.staging import stage

SHINGLE = 4
PERCENT = 80
BANDS = 32
ROWS = 4
BUCKET = 32

_BINS = 128
_CHUNK = 1 << 14
_PLACES = np.uint64(0xA0761D6478BD642F)
_NAMES = (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and the bounds of the texts in them.

    A text of fewer words, but not none, has all of them as one shingle.
    """
    words = arrays.find_words(arrays.lower_ascii(data), offsets, arrays.NON_SPACE)
    hashes, counts = words.hashes[0], words.counts
    starts = np.flatnonzero(words.left() >= size)
    values, owners = [arrays.grams(hashes, size)[starts]], [words.owners()[starts]]
    for few in range(1, size):
        short = np.flatnonzero(counts == few)
        if len(short):
            values.append(arrays.grams(hashes, few)[words.first[short]])
            owners.append(short)
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[first], owner[first]
    return value, np.searchsorted(owner, np.arange(len(counts) + 1))


def _order(places: np.ndarray, spare: np.ndarray) -> None:
    """The second permutation of the 2^32 places, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(places, np.uint32(shift), out=spare)
        np.bitwise_xor(places, spare, out=places)
        np.multiply(places, np.uint32(factor), out=places)
    np.right_shift(places, np.uint32(16), out=spare)
    np.bitwise_xor(places, spare, out=places)


def signatures(values: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """``count`` coordinates of each set; no set is empty."""
    places = (arrays.mix(values + _PLACES) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, count), np.uint32)
    a = 0
    while a < len(out):
        # Sets of about a chunk together, so that their arrays stay in the processor's cache.
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + _CHUNK, side="right")) - 1)
        part, starts = places[bounds[a] : bounds[b]], bounds[a:b] - bounds[a]
        shifted, spare = np.empty_like(part), np.empty_like(part)
        for k in range(count):
            np.subtract(part, np.uint32(k), out=shifted)
            _order(shifted, spare)
            out[a:b, k] = np.minimum.reduceat(shifted, starts)
        a = b
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per set and band."""
    numbers = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(arrays.mix(np.arange(1, bands + 1, dtype=np.uint64)), numbers.shape[:2])
    for row in range(rows):
        keys = arrays.mix(keys * np.uint64(arrays.STEPS[1]) + numbers[..., row])
    return keys


def set_names(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """16 bytes per set that do not depend on the order of its elements."""
    starts = bounds[:-1]
    halves = [np.add.reduceat(arrays.mix(arrays.mix(values ^ c) + c), starts) for c in _NAMES]
    return [bytes(name) for name in np.stack(halves, axis=1).astype(">u8").view("V16").ravel()]


def set_features(documents: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(id, n, node, bands, bins)`` per row: size and name of its set, band keys, element counts."""
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("bins", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.slices(batches, text_col):
            values, every = shingle_sets(data, offsets, size)
            sizes = np.diff(every)
            some = np.flatnonzero(sizes)
            # Positions of the texts with words among these.
            at = np.full(len(sizes), -1)
            at[some] = np.arange(len(some))
            at = pa.array(at, mask=at < 0)
            bounds = np.concatenate([every[some], every[-1:]])
            names: list = set_names(values, bounds) if len(some) else []
            keys = band_keys(signatures(values, bounds, BANDS * ROWS)) if len(some) else np.zeros((0, BANDS))
            place = np.repeat(np.arange(len(some)), sizes[some]) * _BINS + (values >> np.uint64(57)).astype(np.int64)
            bins = np.minimum(np.bincount(place, minlength=len(some) * _BINS), 255).astype(np.uint8)
            bands = arrays.list_array(pa.array(keys.astype(np.uint64).view(np.int64).ravel()), np.full(len(some), BANDS))
            flat = bins.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(id_col),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()).take(at),
                    bands.take(at),
                    pa.array([flat[i : i + _BINS] for i in range(0, len(flat), _BINS)], pa.binary()).take(at),
                ],
                names=names_out,
            )

    names_out = schema.names
    return documents.select(id_col, text_col).mapInArrow(run, schema)


def full_sets(documents: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(node, elements)`` of the wanted sets (node, first), made from the texts of their first ids.

    A bitmap spares most other rows the join on the id.
    """
    bits = documents.sparkSession.sparkContext.broadcast(
        bitmaps.bitmap(wanted.filter("first IS NOT NULL").select(F.xxhash64("first").alias("h")), "h")
    )

    @F.pandas_udf("boolean")
    def may_be_wanted(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmaps.held(bits.value, hashes.to_numpy(np.int64).view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in arrays.slices(batches, "text"):
            values, every = shingle_sets(data, offsets, size)
            sizes = np.diff(every)
            some = np.flatnonzero(sizes)
            if len(some):
                bounds = np.concatenate([every[some], every[-1:]])
                lists = arrays.list_array(pa.array(values.view(np.int64)), sizes[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_names(values, bounds), pa.binary()), lists], names=["node", "elements"]
                )

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    doubtful = rows.filter(F.col("id").isNull() | may_be_wanted(F.xxhash64("id")))
    ids = wanted.select("first").distinct()
    texts = doubtful.join(ids, F.col("id").eqNullSafe(F.col("first")), "left_semi")
    made = texts.select("text").mapInArrow(run, "node binary, elements array<bigint>")
    return made.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


@F.pandas_udf(T.LongType())
def _bins_apart(one: pd.Series, other: pd.Series) -> pd.Series:
    """Sum of differences of counts: at most the number of elements in only one of the sets."""
    a, b = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, _BINS).astype(np.int64) for s in (one, other))
    return pd.Series(np.abs(a - b).sum(axis=1))


class _Sets:
    """The distinct sets of a table, and pairs of them confirmed on their full sets."""

    def __init__(self, documents: DataFrame, features: DataFrame, id_col: str, text_col: str, size: int, percent: int):
        self.documents, self.columns, self.size, self.percent = documents, (id_col, text_col), size, percent
        self.table = stage(
            features.filter("n > 0").groupBy("node").agg(
                F.min("id").alias("first"), *[F.first(c).alias(c) for c in ("n", "bands", "bins")]
            ),
            "sets",
        )

    def _may_link(self, apart: Column) -> Column:
        """Links differ in at most (100 - percent) / (100 + percent) of the sum of their sizes."""
        return (100 + self.percent) * apart <= (100 - self.percent) * (F.col("n_a") + F.col("n_b"))

    def compare(self, pairs: DataFrame) -> DataFrame:
        """``(a, b, n_a, n_b, common, linked)`` of the pairs (a, b, always) that may link, and of those with ``always``."""
        facts = self.table.select("node", "n", "bins", "first")
        for side in "ab":
            own = facts.select(*[F.col(c).alias(f"{c}_{side}") for c in facts.columns])
            pairs = pairs.join(own, F.col(side) == F.col(f"node_{side}"))
        near = F.col("always") | self._may_link(F.abs(F.col("n_a") - F.col("n_b")))
        close = F.col("always") | self._may_link(_bins_apart("bins_a", "bins_b"))
        kept = stage(pairs.filter(near).filter(close).select("a", "b", "n_a", "n_b", "first_a", "first_b"), "pairs")
        ends = [kept.select(F.col(s).alias("node"), F.col(f"first_{s}").alias("first")) for s in "ab"]
        wanted = stage(ends[0].unionAll(ends[1]).distinct(), "wanted")
        self.full = stage(full_sets(self.documents, wanted, *self.columns, self.size), "full-sets")
        found = kept
        for side in "ab":
            own = self.full.select(F.col("node").alias(side), F.col("elements").alias(f"of_{side}"))
            found = found.join(own, side)
        common = F.size(F.array_intersect("of_a", "of_b")).cast("bigint")
        apart = F.col("n_a") + F.col("n_b") - 2 * F.col("common")
        return stage(
            found.select("a", "b", "n_a", "n_b", common.alias("common")).withColumn("linked", self._may_link(apart)),
            "compared",
        )

    def affordable(self, crowded: DataFrame) -> DataFrame:
        """Pairs (a, b) of members (pivot, node, root) of large buckets, of different roots, that
        their differences from the pivot do not rule out.
        """
        # All of them were compared with a pivot.
        elements = stage(self.full.join(crowded.select("node").distinct(), "node"), "crowded")
        own = (
            elements.select("node", F.explode("elements").alias("element"))
            .groupBy("element").agg(F.count("*").alias("holders"), F.min("node").alias("node"))
            .filter("holders = 1").groupBy("node").agg(F.collect_list("element").alias("own"))
        )
        none = F.array().cast("array<bigint>")
        sized = stage(
            elements.join(own, "node", "left").withColumn("own", F.coalesce("own", none))
            .select(
                "node", F.size("elements").alias("n"), F.size("own").alias("u"),
                F.array_except("elements", "own").alias("shared"),
            ),
            "shared-elements",
        )
        of_pivot = sized.select(F.col("node").alias("pivot"), F.col("shared").alias("of_pivot"))
        apart = F.concat(F.array_except("shared", "of_pivot"), F.array_except("of_pivot", "shared"))
        placed = (
            crowded.distinct().join(sized, "node").join(of_pivot, "pivot")
            .select("pivot", "node", "root", "n", "u", apart.alias("apart"))
            .withColumn("v", F.size("apart"))
        )

        def bits(word: int) -> Column:
            """Bits that the differences set in one of the words of a map of 256 bits."""

            def add(acc, e):
                place = F.shiftright(e, 56).bitwiseAND(F.lit(63)).cast("int")
                bit = F.call_function("shiftleft", zero + 1, place)
                return acc.bitwiseOR(F.when(F.shiftrightunsigned(e, 62) == word, bit).otherwise(zero))

            return F.aggregate("apart", zero, add)

        zero = F.lit(0).cast("bigint")
        maps = [f"m{word}" for word in range(4)]
        used = sum(F.bit_count(F.col(m)) for m in maps)
        gain, cost = F.lit(100 - self.percent).cast("bigint"), F.lit(100 + self.percent).cast("bigint")
        low = gain * F.col("n") - cost * (F.col("v") + F.col("u"))
        bounds = stage(
            placed.withColumns({m: bits(word) for word, m in enumerate(maps)})
            .withColumn("low", low).withColumn("high", F.col("low") + 2 * cost * F.col("v"))
            .withColumn("more", F.col("v") - used)
            .drop("apart", "n", "u"),
            "bounds",
        )
        # Most members of a bucket are in one component; every pair has an end outside of it.
        main = bounds.groupBy("pivot", "root").count().groupBy("pivot").agg(
            F.max(F.struct("count", "root"))["root"].alias("main")
        )
        told = stage(bounds.join(main, "pivot").withColumn("out", F.col("root") != F.col("main")).drop("main"), "told")
        most = told.groupBy("pivot").agg(
            F.max("low").alias("low_all"),
            F.max("high").alias("high_all"),
            F.max(F.when(F.col("out"), F.col("low"))).alias("low_out"),
            F.max(F.when(F.col("out"), F.col("high"))).alias("high_out"),
        )
        joined = told.join(most, "pivot")
        facts = ["node", "root", "low", "v", "more", *maps]
        x = joined.filter("out AND low + high_all >= 0 AND high + low_all >= 0")
        x = x.select("pivot", *[F.col(c).alias(f"{c}_x") for c in facts])
        y = joined.filter("low + high_out >= 0 AND high + low_out >= 0").select("pivot", "out", *facts)
        both_set = sum(F.bit_count(F.col(m).bitwiseAND(F.col(f"{m}_x"))) for m in maps)
        # Elements that share a bit with another of their set count besides.
        together = F.least(F.col("v"), F.col("v_x"), both_set + F.least("more", "more_x"))
        met = x.join(y, "pivot").filter(
            (F.col("root") != F.col("root_x"))
            & (F.col("low") + F.col("low_x") + 2 * cost * together >= 0)
            & (~F.col("out") | (F.col("node") < F.col("node_x")))
        )
        return met.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b"))


def links(sets: _Sets, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between sets that connect all that are similar."""
    # The smallest of numbers is cheaper to find than that of names.
    number = F.xxhash64("node").alias("number")
    rows = sets.table.select("node", number, F.explode("bands").alias("key"))
    shared = stage(
        rows.groupBy("key").agg(F.count("*").alias("size"), F.min("number").alias("least")).filter("size > 1"),
        "shared-bands",
    )
    members = stage(rows.join(shared, "key"), "members")
    pivots = members.filter("number = least").groupBy("key").agg(F.min("node").alias("pivot"))
    starred = stage(members.drop("least", "number").join(pivots, "key"), "starred")
    star = (
        starred.filter("node != pivot")
        .groupBy(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .agg((F.max("size") > bucket).alias("always"))
    )
    compared = sets.compare(star)
    near = compared.filter("linked").select("a", "b")
    roots = stage(connected_components(near), "star-roots")
    rooted = starred.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "rooted")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r != s").select("key")
    unsettled = stage(rooted.join(open_, "key", "left_semi"), "unsettled")
    if unsettled.isEmpty():
        return near
    few = unsettled.filter(F.col("size") <= bucket)
    other = few.select("key", F.col("node").alias("b"), F.col("root").alias("root_b"))
    across = few.join(other, "key").filter("node < b AND root != root_b").select(F.col("node").alias("a"), "b")
    crowded = unsettled.filter(F.col("size") > bucket)
    if not crowded.isEmpty():
        across = across.unionAll(sets.affordable(crowded.select("pivot", "node", "root")))
    fresh = stage(across.distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti"), "across")
    if fresh.isEmpty():
        return near
    more = sets.compare(fresh.withColumn("always", F.lit(False)))
    return near.unionAll(more.filter("linked").select("a", "b"))


def near_copies(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bucket: int = BUCKET,
) -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable), kept."""
    features = stage(set_features(documents, id_col, text_col, size), "features")
    sets = _Sets(documents, features, id_col, text_col, size, percent)
    roots = connected_components(links(sets, bucket))
    rooted = stage(
        sets.table.select("node", "first").join(roots, "node", "left")
        .select("node", "first", F.coalesce("root", "node").alias("root")),
        "set-roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_set = rooted.join(smallest, "root").select("node", "component_id")
    some = features.filter("n > 0").select("id", "n", "node").join(by_set, "node").select("id", "n", "component_id")
    none = features.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.unionAll(none).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
