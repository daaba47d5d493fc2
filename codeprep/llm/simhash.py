"""Near copies by SimHash: fingerprints that differ in few bits, found by deletion variants.

A fingerprint of 64 bits is cut into two segments of 32. Two fingerprints that differ in at
most two bits differ in at most one bit in one segment. Every segment is indexed under its 32
variants with one bit left out; an equality of variants proposes a pair, which is then
verified. Distinct fingerprints are indexed, so exact copies cost one row.

A variant that more than ``BUCKET`` fingerprints share (many near copies of one text) gives no
pairs. Its fingerprints are linked exactly in another way: each is filed under itself and the
64 fingerprints one bit away. Two that differ in at most two bits share such a place, and all
at one place differ in at most two bits, so a star per place, of at most 65 members, links
them.

Documents without words have fingerprint zero and link like any other. Null texts are empty.
A null id is kept but never is a component's id; a component of only null ids has none.
Repeated rows get the same result. An empty table gives an empty result. Further columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays, bitmaps
from codeprep.llm.components import connected_components
from codeprep.staging import stage

SHINGLE = 3
SEED = 42
BUCKET = 32

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by a space; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    return np.array(
        [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :])], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    set_in = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(set_in * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, fp)`` per row; fp as a signed number."""
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_col].dataType),
            T.StructField("fp", T.LongType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.slices(batches, text_col):
            flat, bounds = data.tobytes(), offsets.tolist()
            values = [
                fingerprint(shingle_hashes(flat[a:b])) for a, b in zip(bounds, bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column(id_col), pa.array(np.array(values, np.uint64).view(np.int64))],
                names=["id", "fp"],
            )

    return documents.select(id_col, text_col).mapInArrow(run, schema)


def variants(prints: DataFrame) -> DataFrame:
    """64 rows per fingerprint: which bit is left out (upper half of ``key``) and the rest of its segment."""
    half = F.when(F.col("bit") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(
        F.shiftrightunsigned("fp", 32)
    )
    return prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).select(
        half.bitwiseAND(F.expr("~shiftleft(1L, bit % 32)"))
        .bitwiseOR(F.expr("shiftleft(cast(bit as bigint), 32)"))
        .alias("key"),
        "fp",
    )


def _close_pairs(keys: np.ndarray, prints: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of equal keys, each told by one of the variants that it shares."""
    left, right = [], []
    values = prints.view(np.uint64)
    bit = (keys >> 32).astype(np.uint64)
    upper = bit >= 32
    alone = np.uint64(1) << (bit % np.uint64(32))
    for d in range(1, longest):
        same = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(same):
            break
        x = values[same] ^ values[same + d]
        low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)
        here = np.where(upper[same], high, low)
        told = (here == alone[same]) | ((here == 0) & (alone[same] == 1))
        told &= ~upper[same] | (np.bitwise_count(low) > 1)
        ok = same[told & (np.bitwise_count(x) <= 2) & (x != 0)]
        left.append(prints[ok])
        right.append(prints[ok + d])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _scan_buckets(batches: Iterator[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key: links of small buckets (a, b), members of large ones (a, null).

    Holds one batch and at most one unfinished bucket of ``bucket`` rows.
    """

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b], names=["a", "b"])

    def finish(keys, prints):
        if not len(keys):
            return
        edges = np.flatnonzero(np.diff(keys)) + 1
        sizes = np.diff(np.concatenate([[0], edges, [len(keys)]]))
        small = np.repeat((sizes > 1) & (sizes <= bucket), sizes)
        large = np.repeat(sizes > bucket, sizes)
        if large.any():
            members = np.unique(prints[large])
            yield out(members, pa.nulls(len(members), pa.int64()))
        k, p = keys[small], prints[small]
        a, b = _close_pairs(k, p, int(min(sizes.max(), bucket)))
        if len(a):
            yield out(a, pa.array(b, pa.int64()))

    held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    over = None  # key of a large bucket that goes on
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        if over is not None:
            n = int(np.searchsorted(keys, over, side="right"))
            if n:
                yield out(prints[:n], pa.nulls(n, pa.int64()))
            keys, prints = keys[n:], prints[n:]
            if not len(keys):
                continue
            over = None
        keys, prints = np.concatenate([held_keys, keys]), np.concatenate([held, prints])
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        yield from finish(keys[:cut], prints[:cut])
        held_keys, held = keys[cut:], prints[cut:]
        if len(held) > bucket:
            yield out(held, pa.nulls(len(held), pa.int64()))
            over, held_keys, held = held_keys[0], held_keys[:0], held[:0]
    yield from finish(held_keys, held)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) that connect the distinct fingerprints ``fp`` which differ in at most two bits."""
    found = stage(
        variants(prints)
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(lambda batches: _scan_buckets(batches, bucket), "a bigint, b bigint"),
        "links",
    )
    crowded = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    places = crowded.select(
        "fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")
    ).select(
        "fp",
        F.expr("CASE WHEN bit < 0 THEN fp ELSE fp ^ shiftleft(1L, bit) END").alias("place"),
    )
    stars = (
        places.withColumn("b", F.min("fp").over(Window.partitionBy("place")))
        .filter("fp != b")
        .select(F.col("fp").alias("a"), "b")
    )
    return found.filter("b IS NOT NULL").unionAll(stars)


def near_copies(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """Per document: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = stage(fingerprints(documents, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("first"))
    roots = connected_components(links(distinct.select("fp"), bucket))
    rooted = stage(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", without_ids: bool = False
) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id.

    Rows are named by their id and two hashes of their text, so unlike texts under one id are in
    groups of their own. Of several texts of the smallest id the one of smallest hash stays, of
    rows with one id and text the smallest row (in the order of its JSON if it holds a map).

    Rows without an id stay, unless ``without_ids``: then they are copies like any other, and a
    group with an id keeps none of them. Further columns may have any name and type.
    """
    row_id, text = F.col(id_col), F.col(text_col)
    hashes = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    # Rows with an id are smaller.
    name = F.struct(row_id.isNull().alias("none"), row_id.alias("id"), *[h.alias(f"hash{i}") for i, h in enumerate(hashes)])
    named = documents.select(name.alias("name"), text.alias("body"))
    places = stage(near_copies(named, "name", "body"), "near-copies")
    if not without_ids:
        places = places.filter("NOT name.none")
    parts = [F.col(f"name.{part}") for part in ("id", "hash0", "hash1")]
    first = F.col("name") == F.col("component_id")
    gone = places.filter(~first).select(F.xxhash64(*parts[:2]), *parts).distinct()
    often = places.filter(first).groupBy("name").count().filter("count > 1").select(F.xxhash64(*parts[:2]), *parts)
    key = F.xxhash64(row_id, hashes[0])
    names = [row_id, *hashes]
    _, kept = bitmaps.parted(documents, key, names, stage(gone, "copies"))
    often = stage(often, "repeated-rows")
    if often.isEmpty():
        return kept
    # Only these rows meet, one row per task and name.
    repeated, kept = bitmaps.parted(kept, key, names, often)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    has_map = any("map<" in kind for _, kind in documents.dtypes)
    smallest = F.min_by(row, F.to_json(row)) if has_map else F.min(row)
    own = [f"_{i}" for i in range(len(names))]
    grouped = repeated.groupBy(*[n.alias(c) for n, c in zip(names, own)]).agg(smallest.alias("row"))
    return kept.unionByName(grouped.select("row.*"))
