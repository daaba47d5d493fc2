import random

import pytest
import xxhash
from pyspark.sql import functions as F

from codeprep.llm import simhash
from codeprep.llm.components import connected_components

DOCS = "doc_id bigint, text string, fp string, first int"


def brute_print(text):
    words = (text or "").lower() if (text or "").isascii() else "".join(
        c.lower() if c.isascii() else c for c in text
    )
    words = words.split(" ") if words else []
    words = [w for w in words if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    """Smallest number reachable over differences of at most two bits."""
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and root[a] > root[b]:
                    root[a], changed = root[b], True
    return root


def test_documents_against_brute_force(spark):
    rng = random.Random(4)
    docs = []
    for i in range(60):
        words = [rng.choice(["The", "é", "Ünd", "x1", "to", "of"]) for _ in range(rng.randint(0, 12))]
        docs.append((i, " ".join(words), "a", 0))
    docs += [(100, docs[7][1], "a", 0), (101, docs[7][1] + " ", "a", 0), (102, None, "a", 0), (103, "", "a", 0)]
    got = simhash.near_copies(spark.createDataFrame(docs, DOCS)).collect()
    prints = {d[0]: brute_print(d[1]) for d in docs}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    root = brute_roots(set(prints.values()))
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(root[p], i)
    assert {r.doc_id: r.component_id for r in got} == {i: first[root[p]] for i, p in prints.items()}


@pytest.mark.parametrize("bucket", [2, 8, 32])
def test_no_link_is_lost(spark, bucket):
    """Fingerprints around a few centres: large buckets, chains, and bits in both segments."""
    rng = random.Random(bucket)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(rng.randint(0, 5)):
                p ^= 1 << rng.choice([0, 1, 31, 32, 33, 63, rng.randrange(64)])
            prints.add(p)
    prints |= {0, 1, 3, 7, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint").repartition(3)
    found = connected_components(simhash.links(df, bucket)).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    expected = {}
    for p, r in brute_roots(prints).items():
        expected.setdefault(r, set()).add(signed(p))
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(g) for g in expected.values() if len(g) > 1
    }


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    odd = [(200, 200), (None, 3), (300, 299), (299, 300)]
    edges = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {299: 299, 300: 299}
    assert connected_components(edges.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    text = "one two three four"
    docs = spark.createDataFrame(
        [(3, text, "a", 0), (2, text, "b", 1), (2, text, "c", 2), (9, "other words here", "d", 3), (None, text, "e", 4)],
        DOCS,
    )
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, text), (2, text), (9, "other words here"),
    ]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    only_null = simhash.near_copies(docs.filter(F.col("doc_id").isNull())).first()
    assert only_null.component_id is None


def test_copies_without_ids_go_too(spark):
    named, bare = "one two three four", "five six seven eight nine"
    rows = [(3, named, "a", 0), (4, "quite other words", "b", 1), (4, "quite other words", "b", 0)]
    rows += [(None, named, "c", i) for i in range(40)] + [(None, bare, "d", i) for i in range(40)]
    rows += [(None, bare + " ", "e", 0), (None, "alone here", "f", 0), (None, None, "g", 0), (None, "", "h", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    kept = simhash.keep_one(docs, without_ids=True)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert set(got) <= set(rows) and len(got) == 5
    assert sorted((r[0] or 0, (r[1] or "").strip()) for r in got) == [
        (0, ""), (0, "alone here"), (0, bare), (3, named), (4, "quite other words"),
    ]
    assert [r[3] for r in got if r[1] == bare] in ([0], [])
    assert simhash.keep_one(docs).filter("doc_id IS NULL").count() == 84


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b, c = "one two three four", "five six seven eight", "quite other words here"
    rows = [(3, a, "", 0), (5, a, "", 0), (5, b, "", 0), (7, c, "", 0), (9, b, "", 0)]
    for without_ids in (False, True):
        kept = simhash.keep_one(spark.createDataFrame(rows, DOCS).repartition(3), without_ids=without_ids)
        assert sorted(map(tuple, kept.collect())) == [(3, a, "", 0), (5, b, "", 0), (7, c, "", 0)]


def test_columns_of_any_name_and_type(spark):
    text, other = "one two three four", "five six seven eight"
    rows = [(i, t, 7, 8, {"k": i}, "x") for i, t in ((1, text), (1, text), (2, text), (4, other), (None, other), (None, None))]
    schema = "doc_id bigint, text string, _id int, _place int, _bad map<string,int>, `a.b` string"
    docs = spark.createDataFrame(rows, schema)
    for without_ids, count in ((False, 4), (True, 3)):
        kept = simhash.keep_one(docs, without_ids=without_ids)
        assert kept.columns == docs.columns and kept.count() == count
        assert {r[0] for r in kept.collect()} == {1, 4, None}
        assert all(r._id == 7 and r._place == 8 for r in kept.collect())
