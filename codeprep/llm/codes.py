"""Vector code compression: parts of vectors replaced by indexes into trained codebooks.

A component x counts as the integer floor(256 * x). Every vector is cut into ``PARTS`` equal
consecutive parts, and every part position has a codebook of ``ENTRIES`` entries. It starts as
that part of the vectors with the smallest ids. A round assigns every part to its nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry by the
componentwise floor(sum / count) of its parts; unused entries stay.

Nearest entries are found by equal-average search. Entries stand in order of the sum of their
components. The search goes outward from a part's own sum, the nearer side first, and ends when
the squared gap of the sums, divided by the dimension, strictly exceeds the best distance so
far: no entry beyond can be as near. An equal gap goes on, as it may tie with a lower index.

All vectors take part in every round. Tasks keep one sum per codebook component and send these;
they are added up by key, and what comes to the driver and goes back is a codebook of fixed
size. All numbers are integers, so no partitioning changes a result.

Vectors that are null, or hold a null or a non-finite number, are dropped. A length that is no
multiple of ``PARTS`` is filled up with zeros. Vectors of each length are a set of their own,
with their own codebooks, trained one after the other; one table usually has one length. With
fewer vectors than ``ENTRIES`` each is an entry. Rows that repeat an id are vectors of their own
and take the places among the first ids in order of their components; null ids stand last.
Components beyond 2^30 / (length of a part) count as that bound, so that sums fit in 64 bits.
Further columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.staging import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

# Sums of labels are sent to all tasks up to this many.
MOST_LABELS = 100_000


def usable(vectors: DataFrame, id_col: str, vector_col: str, *keep: Column) -> DataFrame:
    """``(vec_id, vector, *keep)`` of rows whose vector has finite numbers only."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    vector = F.col(vector_col).cast("array<double>").alias("vector")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vector, *keep)
    return rows.filter(F.col("vector").isNotNull() & finite)


def to_parts(vectors: pa.Array, length: int, parts: int = PARTS) -> np.ndarray:
    """Integers of shape (rows, parts, components of a part)."""
    rows = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), length)
    size = -(-length // parts)
    limit = (1 << 30) // max(size, 1)
    with np.errstate(over="ignore"):
        numbers = np.clip(np.floor(rows * SCALE), -limit, limit).astype(np.int64)
    filled = np.zeros((len(rows), parts * size), np.int64)
    filled[:, :length] = numbers
    return filled.reshape(len(rows), parts, size)


def nearest_entries(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, the lower one of ties, and its squared distance."""
    dims = points.shape[1]
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = points.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    index = np.full(len(points), len(entries))
    best = np.zeros(len(points), np.int64)
    far = np.int64(np.iinfo(np.int64).max)
    active = np.arange(len(points))
    while len(active):
        l, r, s = left[active], right[active], own[active]
        down = np.where(l >= 0, s - sums[l], far)
        up = np.where(r < len(sums), sums[np.minimum(r, len(sums) - 1)] - s, far)
        gap = np.minimum(down, up)
        unseen = index[active] == len(entries)
        on = gap != far
        on &= unseen | (np.where(on, gap, 0) ** 2 <= best[active] * dims)
        active, down, up, unseen = active[on], down[on], up[on], unseen[on]
        to_left = down <= up
        entry = order[np.where(to_left, left[active], np.minimum(right[active], len(sums) - 1))]
        left[active] -= to_left
        right[active] += ~to_left
        apart = ((points[active] - entries[entry]) ** 2).sum(axis=1)
        better = unseen | (apart < best[active]) | ((apart == best[active]) & (entry < index[active]))
        index[active[better]], best[active[better]] = entry[better], apart[better]
    return index, best


def assign(parts: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (rows, parts) and squared distances summed over the parts of a row."""
    found = [nearest_entries(parts[:, p], codebooks[p]) for p in range(len(codebooks))]
    return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)


def _first_entries(rows: DataFrame, length: int) -> np.ndarray:
    """Codebooks (parts, entries, components) of the vectors with the smallest ids."""
    first = rows.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES)
    table = first.toArrow()
    vectors = table.column("vector").combine_chunks()
    return to_parts(vectors, length).transpose(1, 0, 2).copy()


def _refine(rows: DataFrame, codebooks: np.ndarray, length: int) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts that are nearest to it."""
    parts, entries, size = codebooks.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, size + 1), np.int64)
        for batch in batches:
            points = to_parts(batch.column("vector"), length)
            index, _ = assign(points, codebooks)
            for p in range(parts):
                np.add.at(sums[p, :, :size], index[:, p], points[:, p])
                sums[p, :, size] += np.bincount(index[:, p], minlength=entries)
        flat = sums.ravel()
        place = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(flat[place])], names=["place", "total"])

    added = (
        rows.select("vector").mapInArrow(totals, "place bigint, total bigint")
        .groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    )
    sums = np.zeros(parts * entries * (size + 1), np.int64)
    sums[added["place"].to_numpy()] = added["total"].to_numpy()
    sums = sums.reshape(parts, entries, size + 1)
    counts = sums[..., size:]
    return np.where(counts > 0, sums[..., :size] // np.maximum(counts, 1), codebooks)


def train(rows: DataFrame, length: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, components) of usable vectors of one length."""
    codebooks = _first_entries(rows, length)
    for _ in range(rounds):
        codebooks = _refine(rows, codebooks, length)
    return codebooks


def encode(rows: DataFrame, codebooks: np.ndarray, length: int) -> DataFrame:
    """Usable rows with ``code`` (two hex digits per part) and ``error`` instead of the vector."""
    others = rows.drop("vector").schema
    kept = others.names
    schema = T.StructType(
        [*others.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, error = assign(to_parts(batch.column("vector"), length), codebooks)
            digits, width = index.astype(np.uint8).tobytes().hex(), 2 * codebooks.shape[0]
            code = [digits[i : i + width] for i in range(0, len(digits), width)]
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=[*kept, "code", "error"]
            )

    return rows.select(*kept, "vector").mapInArrow(run, schema)


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Per usable vector: id, code, error, error summed over its label, digest of the codebooks.

    Null labels are one label.
    """
    rows = usable(vectors, id_col, vector_col, F.col(label_col).alias("label"))
    size = F.size("vector")
    coded = [rows.drop("vector").filter("false").selectExpr("*", "'' AS code", "0L AS error", "'' AS codebooks_sha256")]
    for (length,) in sorted(rows.select(size).distinct().collect()):
        same = rows.filter(size == length)
        codebooks = train(same, length)
        coded.append(encode(same, codebooks, length).withColumn("codebooks_sha256", F.lit(digest(codebooks))))
    table = stage(reduce(DataFrame.unionByName, coded), "codes")
    sums = stage(table.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    by_label = sums.withColumnRenamed("label", "of")
    if sums.count() <= MOST_LABELS:
        by_label = F.broadcast(by_label)
    joined = table.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", "codebooks_sha256")
