"""Approximate nearest neighbours by cosine: an adaptive dimension scan of probed lists.

Index: k-means centres, fitted on a bounded sample, divide the unit vectors into lists; every
vector is in the list of its nearest centre. Vectors are rotated by one random orthogonal
matrix, after which any leading block of dimensions estimates the whole squared distance.

Search: a query probes the lists of its nearest centres. Dimensions are read in blocks of
columns. After each block the distance so far, scaled to all dimensions, is tested against the
query's bound: a candidate is abandoned if its distance would be above the bound even after the
allowance ``1 + EPSILON / sqrt(dimensions read)`` for the estimate's error. The bound is the
k-th smallest distance among the sampled ids, and is not lowered while a list is read, which costs
time and loses no neighbour. Candidates that survive
are scored on the original vectors in double precision, each pair by the same sums, so equal
vectors have equal scores.

A list of any size is dealt out in blocks, and the queries that probe it in chunks, of about
``DEALT`` numbers; a task holds one block and one chunk, compares them ``BLOCK`` by ``QUERIES`` at a
time and keeps ``k`` candidates per query. So a vector is sent once for each chunk of its own list,
which is once unless very many queries probe it. What is sent to all tasks is bounded: the sample of at most ``SAMPLE`` ids, a vector each, its centres
and the rotation. How many lists are probed is fitted on the sample: enough that ``RECALL`` of its
vectors' neighbours within the sample, which lie farther than those among all, are in them, and
always enough to hold ``4 * k`` ids.

Vectors that are null, empty, zero, or hold a null or a non-finite number take no part, nor do
rows without an id. Vectors compare with those of their own length; each length is a set of its
own, with its own index, one after the other. Further columns are not looked at. Rows that repeat an id are one candidate, by their best score, and one query, the smallest of
their vectors. Fewer candidates than ``k`` are all returned. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeprep.staging import stage

K = 5
SAMPLE = 4096
PER_LIST = 64  # sampled vectors per centre
MOST_LISTS = 64
BLOCK = 2048
QUERIES = 512
DEALT = 1 << 20  # numbers in the vectors that are dealt to a task together
COLUMNS = 16
FEW = 0.1  # share of pairs below which they are followed one by one
PAIRS = 1 << 15
EPSILON = 3.0
RECALL = 0.99
SEED = 20240229

_PAIRS = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)`` of rows that take part, vectors as doubles."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(finite & F.exists("vector", lambda x: x != 0))
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; the sums of a row do not depend on other rows."""
    one = np.abs(a).max(axis=1, keepdims=True)
    two = np.abs(b).max(axis=1, keepdims=True)
    big = (one > 1e100) | (one < 1e-100) | (two > 1e100) | (two < 1e-100)
    if big.any():
        a, b = np.where(big, a / one, a), np.where(big, b / two, b)
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / norms


class Index:
    """What is fitted on the sample: rotation, centres, number of lists to probe."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        rng = np.random.default_rng(SEED)
        self.k, self.ids, self.vectors = k, ids, vectors
        n, dims = vectors.shape
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        points = unit(vectors)
        self.sample = points @ self.rotation
        lists = int(np.clip(n // PER_LIST, 1, MOST_LISTS))
        centres = points[rng.choice(n, lists, replace=False)]
        for _ in range(12):
            near = np.argmax(points @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
        self.centres = centres
        self.probes = self._fit_probes(points)

    def lists_of(self, points: np.ndarray) -> np.ndarray:
        return np.argmax(points @ self.centres.T, axis=1)

    def _fit_probes(self, points: np.ndarray) -> int:
        """Lists within which ``RECALL`` of the neighbours of up to 512 sampled vectors lie."""
        own = self.lists_of(points)
        some = points[:512]
        nearness = some @ points.T
        nearness[np.arange(len(some)), np.arange(len(some))] = -2
        k = min(self.k, len(points) - 1)
        if k < 1:
            return len(self.centres)
        best = np.argpartition(-nearness, k - 1, axis=1)[:, :k]
        order = np.argsort(-(some @ self.centres.T), axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
        needed = np.take_along_axis(rank, own[best], axis=1)
        return int(np.quantile(needed, RECALL, method="higher")) + 1

    def bounds(self, query_ids: np.ndarray, rotated: np.ndarray) -> np.ndarray:
        """Squared distance of the k-th nearest sampled vector, the query's own left out."""
        distance = np.maximum(2 - 2 * rotated @ self.sample.T, 0)
        distance[query_ids[:, None] == self.ids[None, :]] = np.inf
        if distance.shape[1] < self.k:
            return np.full(len(rotated), np.inf)
        return np.partition(distance, self.k - 1, axis=1)[:, self.k - 1]

    def probed(self, point: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Nearest lists, at least ``probes`` and enough for ``4 * k`` ids."""
        order = np.argsort(-(self.centres @ point), kind="stable")
        enough = int(np.searchsorted(np.cumsum(sizes[order]), 4 * self.k + 1)) + 1
        return order[: max(self.probes, enough)]


def fit(rows: DataFrame, k: int) -> Index | None:
    """Index over the ``SAMPLE`` ids of smallest hash, each with the smallest of its vectors.

    They alone come to the driver. As no id is there twice, the k-th smallest distance to them
    is never below that of the k-th nearest id.
    """
    ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    sample = (
        rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector"))
        .withColumn("hash", F.xxhash64("vec_id")).collect()
    )
    if not sample:
        return None
    sample.sort(key=lambda r: (r.hash, r.vec_id))
    return Index(
        np.array([r.vec_id for r in sample], np.int64),
        np.array([r.vector for r in sample], np.float64),
        k,
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _to_lists(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = unit(_matrix(batch.column("vector")))
                lists = pa.array(index.value.lists_of(points).astype(np.int32))
                yield batch.append_column("list", lists)

    return run


def _to_probes(index, sizes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = unit(_matrix(batch.column("vector")))
                probed = [index.value.probed(p, sizes).astype(np.int32) for p in points]
                counts = [len(p) for p in probed]
                take = pa.array(np.repeat(np.arange(len(points)), counts))
                rows = batch.take(take)
                yield rows.append_column("list", pa.array(np.concatenate(probed)))

    return run


def scan_block(
    index: Index, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to k best of a block for each query: places of queries and vectors, scores."""
    k, dims = index.k, vectors.shape[1]
    q, x = unit(queries) @ index.rotation, unit(vectors) @ index.rotation
    bound = index.bounds(query_ids, q)
    alive = query_ids[:, None] != ids[None, :]
    so_far = np.zeros(alive.shape)
    pairs = None  # places of queries and vectors still alive, once they are few
    for low in range(0, dims, COLUMNS):
        high = min(low + COLUMNS, dims)
        a, b = q[:, low:high], x[:, low:high]
        if pairs is None and np.count_nonzero(alive) <= FEW * alive.size:
            pairs = np.nonzero(alive)
            partial = so_far[pairs]
        allowance = 1 + EPSILON / np.sqrt(high) if high < dims else 1.0
        most = bound * allowance**2 * (high / dims) + 1e-9
        if pairs is None:
            # Most pairs are alive: one product for all.
            so_far += (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
            alive &= so_far <= most[:, None]
        else:
            for i in range(0, len(partial), PAIRS):
                some = slice(i, i + PAIRS)
                difference = a[pairs[0][some]] - b[pairs[1][some]]
                partial[some] += (difference * difference).sum(axis=1)
            stay = partial <= most[pairs[0]]
            pairs, partial = (pairs[0][stay], pairs[1][stay]), partial[stay]
    alive_q, alive_x = np.nonzero(alive) if pairs is None else pairs
    score = np.empty(len(alive_q))
    for i in range(0, len(score), PAIRS):
        some = slice(i, i + PAIRS)
        score[some] = cosine(queries[alive_q[some]], vectors[alive_x[some]])
    order = np.lexsort((ids[alive_x], -score, alive_q))
    alive_q, alive_x, score = alive_q[order], alive_x[order], score[order]
    # Rows that repeat an id are one candidate.
    key = np.unique(np.stack([alive_q, ids[alive_x]]), axis=1, return_index=True)[1] if len(alive_q) else []
    first = np.sort(np.asarray(key, np.int64))
    alive_q, alive_x, score = alive_q[first], alive_x[first], score[first]
    place = np.arange(len(alive_q)) - np.searchsorted(alive_q, alive_q)
    best = place < k
    return alive_q[best], alive_x[best], score[best]


def _scan(index):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in columns})
        query_ids, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        queries, vectors = np.stack(left["vector"].to_list()), np.stack(right["vector"].to_list())
        found = []
        # In steps, so that the distances held at once stay few.
        for a in range(0, len(ids), BLOCK):
            for b in range(0, len(query_ids), QUERIES):
                i, j, score = scan_block(
                    index.value, query_ids[b : b + QUERIES], queries[b : b + QUERIES],
                    ids[a : a + BLOCK], vectors[a : a + BLOCK],
                )
                found.append(
                    pd.DataFrame({"query_id": query_ids[b + i], "vec_id": ids[a + j], "score": score})
                )
        return pd.concat(found)

    return run


def _from_sample(index):
    """The sample's own k nearest, so that every query has as many candidates as there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, queries = batch.column("query_id").to_numpy(), _matrix(batch.column("vector"))
            for a in range(0, len(ids), QUERIES):
                i, j, score = scan_block(known, ids[a : a + QUERIES], queries[a : a + QUERIES], known.ids, known.vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + i]), pa.array(known.ids[j]), pa.array(score)],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every row for which ``is_query``
    (a condition on the column ``vec_id``) holds, nearest first, ties to the smaller id.
    """
    rows = usable(vectors, id_col, vector_col)
    size = F.size("vector")
    lengths = [r[0] for r in rows.select(size).distinct().collect()]
    found = vectors.sparkSession.createDataFrame([], _PAIRS)
    for length in sorted(lengths):
        found = found.unionByName(_candidates(rows.filter(size == length), is_query, k))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _candidates(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Pairs (query_id, vec_id, score) of vectors of one length that hold the k nearest found."""
    spark = rows.sparkSession
    fitted = fit(rows, k)
    if fitted is None:
        return spark.createDataFrame([], _PAIRS)
    index = spark.sparkContext.broadcast(fitted)
    # A row that is there several times is one candidate, whatever the number.
    listed = stage(
        rows.distinct().mapInArrow(_to_lists(index), "vec_id bigint, vector array<double>, list int"),
        "listed",
    )
    # Two numbers per list, at most MOST_LISTS.
    sizes, members = np.zeros(len(fitted.centres), np.int64), np.zeros(len(fitted.centres), np.int64)
    per_id = listed.groupBy("list", "vec_id").count()
    for row in per_id.groupBy("list").agg(F.sum("count").alias("rows"), F.count("*").alias("ids")).collect():
        sizes[row["list"]], members[row["list"]] = row["rows"], row["ids"]
    queries = listed.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    queries = stage(queries, "queries")
    probes = stage(
        queries.mapInArrow(_to_probes(index, members), "query_id bigint, vector array<double>, list int"), "probes"
    )
    asked = np.zeros(len(sizes), np.int64)
    for row in probes.groupBy("list").count().collect():
        asked[row["list"]] = row["count"]
    rows_dealt = max(BLOCK, DEALT // fitted.vectors.shape[1])

    def pieces(counts: np.ndarray) -> Column:
        """In how many pieces each list's vectors or queries are dealt out."""
        each = F.array(*[F.lit(int(max(1, -(-n // rows_dealt)))) for n in counts])
        return F.get(each, F.col("list"))

    def piece(counts: np.ndarray, *of: str) -> Column:
        return F.pmod(F.xxhash64(*of), pieces(counts)).cast("int")

    def every(counts: np.ndarray) -> Column:
        return F.explode(F.sequence(F.lit(0), pieces(counts) - 1))

    # Vectors meet the queries that probe their own list only.
    left = probes.withColumn("chunk", piece(asked, "query_id")).withColumn("block", every(sizes))
    wanted = F.array(*[F.lit(bool(n)) for n in asked])
    right = (
        listed.filter(F.get(wanted, F.col("list")))
        .withColumn("block", piece(sizes, "vec_id", "vector")).withColumn("chunk", every(asked))
    )
    keys = ["list", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_scan(index), _PAIRS)
    return found.unionByName(queries.mapInArrow(_from_sample(index), _PAIRS))
