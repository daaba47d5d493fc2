import numpy as np
import pytest
from pyspark.sql import functions as F

from codeprep.llm import nearest
from codeprep.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, query_id int, vector string"


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "a") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, VECTORS)


def brute(ids, vectors, is_query, k):
    vectors = np.asarray(vectors, np.float32).astype(float)
    units = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    out = {}
    for q in [i for i in range(len(ids)) if is_query(ids[i])]:
        score = units @ units[q]
        others = sorted((-round(score[j], 12), ids[j]) for j in range(len(ids)) if ids[j] != ids[q])
        out[ids[q]] = [i for _, i in others[:k]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append(r.vec_id)
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(90, 7))
    vectors[40:45] = vectors[3]
    ids = list(range(90))
    got = nearest.nearest(table(spark, ids, vectors), F.col("vec_id") % 10 == 0).collect()
    assert found(got) == brute(ids, vectors, lambda i: i % 10 == 0, 5)


def test_scores_and_ties(spark):
    vectors = [[1, 0], [2, 0], [4, 0], [0, 1], [-1, 0], [1, 1]]
    got = nearest.nearest(table(spark, [0, 9, 5, 7, 8, 6], vectors), F.col("vec_id") == 0).collect()
    assert found(got) == {0: [5, 9, 6, 7, 8]}
    assert [r.score for r in sorted(got, key=lambda r: r["rank"])] == [1, 1, pytest.approx(2**-0.5), 0, -1]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], None, [0, 0], [1, None], [1, nan], [inf, 1], [], [1, 0, 0], [0, 1], [1, 1], [3e38, 1e38], [1e-30, 0]]
    df = table(spark, [*range(11), 50], vectors)
    got = found(nearest.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == {0: [50, 10, 9, 8], 50: [0, 10, 9, 8]}
    repeated = table(spark, [0, 0, 1, 1, None], [[1, 0], [0, 1], [1, 1], [1, 0], [1, 0]])
    rows = nearest.nearest(repeated, F.col("vec_id") == 0).collect()
    assert found(rows) == {0: [1]}
    assert nearest.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert nearest.nearest(table(spark, [0], [[1, 2]]), F.col("vec_id") == 0).count() == 0


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 20))
    vectors[100:250] = vectors[7] + 1e-3 * rng.normal(size=(150, 20))
    ids = list(range(400))
    df = table(spark, ids, vectors)
    expected = brute(ids, vectors, lambda i: i % 5 == 0, 5)
    monkeypatch.setattr(nearest, "BLOCK", 40)
    monkeypatch.setattr(nearest, "QUERIES", 16)
    monkeypatch.setattr(nearest, "PER_LIST", 400)
    got = found(nearest.nearest(df, F.col("vec_id") % 5 == 0).collect())
    assert got == expected


@pytest.mark.parametrize("sample", [4096, 40])
def test_repeated_rows_change_nothing(spark, monkeypatch, sample):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(200, 20))
    ids = list(range(200))
    times = [5] * 199 + [300]
    monkeypatch.setattr(nearest, "SAMPLE", sample)
    df = table(spark, np.repeat(ids, times).tolist(), np.repeat(vectors, times, axis=0)).repartition(4)
    got = found(nearest.nearest(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute(ids, vectors, lambda i: i % 10 == 0, 5)


def test_an_id_with_many_vectors_leaves_room_for_others(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 8))
    vectors[1:31] = vectors[0] + 1e-3 * rng.normal(size=(30, 8))
    ids = [0] + [1] * 30 + list(range(2, 31))
    got = found(nearest.nearest(table(spark, ids, vectors), F.col("vec_id") == 0).collect())
    units = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    best = sorted(range(2, 31), key=lambda i: -(units[ids.index(i)] @ units[0]))
    assert got == {0: [1, *best[:4]]}


def test_recall_on_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    expected = brute(ids, vectors, lambda i: i % 50 == 0, 5)
    got = found(QUERIES["op2_nearest"](spark, folder).collect())
    assert set(got) == set(expected)
    hits = sum(len(set(got[q]) & set(expected[q])) for q in expected)
    assert hits >= 0.95 * 5 * len(expected)


def test_every_length_is_a_set_of_its_own(spark):
    rng = np.random.default_rng(12)
    lengths = [4, 8, 1, 4, 8, 8]
    rows = [(i, rng.normal(size=lengths[i % 6]).astype(np.float32)) for i in range(120)]
    got = found(nearest.nearest(table(spark, *zip(*rows)), F.col("vec_id") % 5 == 0).collect())
    expected = {}
    for length in {4, 8}:
        own = [(i, v) for i, v in rows if len(v) == length]
        ids, vectors = zip(*own)
        expected |= brute(ids, np.stack(vectors), lambda i: i % 5 == 0, 5)
    assert {q: v for q, v in got.items() if lengths[q % 6] != 1} == expected
    # Vectors of one component point one way or the other.
    assert all(len(v) == 5 for q, v in got.items()) and set(got) == set(range(0, 120, 5))


def test_a_vector_is_sent_once_for_each_chunk_of_its_list(spark, monkeypatch):
    """Few numbers dealt together: many blocks and chunks, and the same neighbours."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(600, 6))
    df = table(spark, range(600), vectors)
    before = found(nearest.nearest(df, F.col("vec_id") % 2 == 0).collect())
    monkeypatch.setattr(nearest, "DEALT", 6 * 40)
    monkeypatch.setattr(nearest, "BLOCK", 40)
    assert found(nearest.nearest(df, F.col("vec_id") % 2 == 0).collect()) == before
