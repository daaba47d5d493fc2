import random

from codeprep.llm import mixing
from codeprep.llm.oracles import OP7

DOCS = "doc_id bigint, text string, source string, size int, hash string, target int"


def make(seed, n):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        source = rng.choice(["b", "a", "Z", "é", None, "big", "big", "big"])
        words = rng.choice([0, 1, 3, 10, 200]) if source != "a" else 1
        docs.append((i, None if rng.random() < 0.05 else "w\t" * words, source, 1, "x", 2))
    return docs


def test_against_sql(spark, duck):
    docs = make(1, 400) + [(None, "x y", "a", 1, "x", 2)]
    got = mixing.mix(spark.createDataFrame(docs, DOCS)).collect()
    rows = duck(OP7, documents=("doc_id BIGINT, text VARCHAR, source VARCHAR", [d[:3] for d in docs]))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert [[r[c] for c in columns] for r in sorted(got, key=key)] == [
        [r[c] for c in columns] for r in sorted(rows, key=key)
    ]


def targets_by_sharing(sizes, weights, most):
    """Shares by weight; what is over a stop is shared again."""
    target, left, open_ = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_nearness(spark):
    docs = make(2, 3000)
    got = mixing.mix(spark.createDataFrame(docs, DOCS)).collect()
    by_id = {d[0]: d for d in docs}
    sizes, taken, target, largest = {}, {}, {}, {}
    for r in got:
        source = by_id[r.doc_id][2]
        assert r.size == len((by_id[r.doc_id][1] or "").split())
        assert r.taken <= 3 * r.size and r.taken == r.times * r.size
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
        largest[source] = max(largest.get(source, 0), r.size)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    expected = targets_by_sharing(sizes, weights, 3)
    for s in sizes:
        assert abs(target[s] - expected[s]) < 1e-6 * max(1, expected[s])
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.mix(spark.createDataFrame(docs[::-1], DOCS).repartition(5)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_rows_of_the_mix(spark):
    docs = spark.createDataFrame(make(3, 500), DOCS)
    times = {r.doc_id: r.times for r in mixing.mix(docs).collect()}
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    counts = {}
    for r in rows.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in times.items() if n}


def test_odd_tables(spark):
    docs = spark.createDataFrame(make(4, 10), DOCS)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 0, "", 0), (2, " ", None, 0, "", 0)], DOCS)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2
    same = spark.createDataFrame([(1, "a b", "s", 0, "", 0)] * 4, DOCS)
    assert [r.taken for r in mixing.mix(same).collect()] == [2] * 4
