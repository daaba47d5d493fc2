import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeprep.llm import codes
from codeprep.llm.oracles import OP13
from codeprep.llm.queries import op13_vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, vector string"


def brute(rows, rounds=2):
    """Plain integers, every entry tried."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for length in sorted({len(r[1]) for r in kept}):
        own = [(r[0], [math.floor(256 * x) for x in r[1]], r[2]) for r in kept if len(r[1]) == length]
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        w = -(-length // 16)
        cut = [[(v + [0] * (16 * w - length))[p * w : p * w + w] for p in range(16)] for _, v, _ in own]
        books = [[list(c[p]) for c in cut[:64]] for p in range(16)]

        def nearest(part, book):
            return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

        for _ in range(rounds):
            for p in range(16):
                groups = {}
                for c in cut:
                    groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
                for e, members in groups.items():
                    books[p][e] = [sum(x) // len(members) for x in zip(*members)]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (i, _, label), c in zip(own, cut):
            found = [nearest(c[p], books[p]) for p in range(16)]
            out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label, sha))
    sums = {}
    for r in out:
        sums[r[3]] = sums.get(r[3], 0) + r[2]
    return sorted(((i, c, e, sums[label], s) for i, c, e, label, s in out), key=repr)


def single(x):
    return float(np.float32(x))


@pytest.mark.parametrize("seed", range(8))
def test_search_finds_the_lowest_of_the_nearest(seed):
    rng = np.random.default_rng(seed)
    dims = int(rng.integers(1, 6))
    points = rng.integers(-9, 9, size=(300, dims))
    entries = rng.integers(-9, 9, size=(int(rng.integers(1, 64)), dims))
    index, apart = codes.nearest_entries(points, entries)
    every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (apart == every.min(axis=1)).all()


def test_search_goes_on_at_an_equal_gap():
    """The entry beyond has the same bound and distance, and a lower index."""
    entries = np.array([[2, 2], [0, 0]])
    index, apart = codes.nearest_entries(np.array([[1, 1]]), entries)
    assert (index.tolist(), apart.tolist()) == ([0], [2])


def odd_rows(rng, count=150, length=32):
    rows = [(i * 3, [single(rng.gauss(0, 1)) for _ in range(length)], rng.choice([0, 1, None]), "x", "y") for i in range(count)]
    rows += [(r[0] + 1, list(r[1]), 7, "x", "y") for r in rows[:40]]  # equal vectors
    rows += [rows[0], rows[0], (0, [single(0.5)] * length, 1, "x", "y")]  # repeated rows and ids
    rows += [(None, [single(-0.25)] * length, 1, "x", "y"), (5000, [0.0] * length, None, None, None)]
    rows += [(5001, None, 1, "x", "y"), (5002, [1.0] * (length - 1) + [None], 1, "x", "y")]
    rows += [(5003, [math.nan] * length, 1, "x", "y"), (5004, [math.inf] + [0.0] * (length - 1), 1, "x", "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_query_against_brute_force(spark, tmp_path, parts):
    rows = odd_rows(random.Random(5))
    spark.createDataFrame(rows, VECTORS).repartition(parts).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_vector_codes(spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_query_against_sql(spark, duck):
    rng = random.Random(6)
    rows = [r[:3] for r in odd_rows(rng, 90, 16) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((tuple(r) for r in codes.compress(df).collect()))
    expected = duck(OP13, embeddings=("vec_id BIGINT, embedding FLOAT[], label INTEGER", rows))
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got == sorted(tuple(r[n] for n in names) for r in expected)


def test_every_length_is_a_set_and_few_vectors_are_entries(spark):
    rng = random.Random(7)
    rows = [(i, [single(rng.gauss(0, 2)) for _ in range([16, 20, 0, 1][i % 4])], i % 2, "", "") for i in range(24)]
    got = codes.compress(spark.createDataFrame(rows, VECTORS))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert got.select("codebooks_sha256").distinct().count() == 4


def test_large_components_and_empty_tables(spark):
    rows = [(i, [single(10.0 ** (i + j % 3)) for j in range(16)], 1, "", "") for i in range(30)]
    got = codes.compress(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 30 and all(r.error >= 0 for r in got)
    empty = codes.compress(spark.createDataFrame([], VECTORS))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert empty.count() == 0


def test_many_labels_are_joined_not_broadcast(spark, monkeypatch):
    rows = [(i, [single(i % 9)] * 16, i // 2 if i % 5 else None, "", "") for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS)
    before = sorted(map(tuple, codes.compress(df).collect()))
    monkeypatch.setattr(codes, "MOST_LABELS", 3)
    monkeypatch.setattr(F, "broadcast", None)
    assert sorted(map(tuple, codes.compress(df).collect())) == before == sorted(brute(rows))
