import random

import pytest
from pyspark.sql import functions as F

from codeprep.llm import substrings
from codeprep.llm.oracles import OP8

DOCS = "doc_id bigint, text string, tag string, doc int"


def test_cover_and_anchor_fit_the_window():
    differences = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert differences == set(range(substrings.PERIOD))
    assert substrings.PERIOD + substrings.ANCHOR - 1 <= substrings.WINDOW


def results(df):
    return sorted(
        (r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
        for r in substrings.remove_repeats(df).collect()
    )


def oracle(duck, docs):
    rows = duck(OP8, documents=("doc_id BIGINT, text VARCHAR", [d[:2] for d in docs]))
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_against_sql(spark, duck, seed):
    """Shared passages at random places, repeated words, whole copies, near copies."""
    rng = random.Random(seed)
    fresh = iter(range(10**6))
    text = lambda n: [f"w{next(fresh)}" for _ in range(n)]
    passages = [text(n) for n in (49, 50, 51, 80, 200)]
    passages += [["x"] * 120, ["a", "b"] * 60, ["a", "b", "c"] * 30]
    docs = []
    for i in range(40):
        words = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            low = rng.randint(0, max(0, len(passage) - 60))
            words += passage[low:] + text(rng.randint(0, 30))
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(words), "x", 0))
    docs += [(40 + i, docs[i][1], "x", 0) for i in range(5)]
    docs += [(45 + i, docs[i][1] + " end", "x", 0) for i in range(5)]
    docs += [(50, None, "x", 0), (51, "", "x", 0)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    assert results(df) == oracle(duck, docs)


def test_groups_over_many_batches(spark, duck):
    """A passage in all documents, streamed in batches smaller than its groups."""
    passage = " ".join(f"p{i}" for i in range(70))
    docs = [(i, f"{passage} own{i} " + " ".join(f"q{i}_{j}" for j in range(i % 60)), "x", 0) for i in range(60)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        assert results(spark.createDataFrame(docs, DOCS)) == oracle(duck, docs)
    finally:
        spark.conf.set(name, kept)


def test_ids_that_repeat_or_are_null(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(3, passage, "x", 0), (3, passage, "x", 0), (3, passage + " more", "x", 0), (4, "a " + passage, "x", 0)]
    docs += [(None, passage, "x", 0), (None, "b " + passage, "x", 0)]
    got = substrings.remove_repeats(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((r.doc_id or 99, r.n_words, r.n_removed) for r in got) == [
        (3, 60, 0), (3, 60, 0), (3, 61, 0), (4, 61, 60), (99, 60, 60), (99, 61, 60),
    ]
    alone = [(None, passage, "x", 0), (None, "b " + passage, "x", 0)]
    assert {r.n_removed for r in substrings.remove_repeats(spark.createDataFrame(alone, DOCS)).collect()} == {0}
    assert substrings.remove_repeats(spark.createDataFrame(docs, DOCS).limit(0)).count() == 0


@pytest.mark.parametrize("shared_id", [None, 7])
def test_rows_of_one_id_with_equal_short_hashes(spark, shared_id):
    """Two texts whose 32-bit hashes are equal: only one of them repeats an earlier document."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(59)), lambda j: F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x"), j.cast("string"))))
    pairs = spark.range(300_000).select(words.alias("text")).groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("texts"))
    one, two = pairs.filter(F.size("texts") > 1).first().texts[:2]
    docs = spark.createDataFrame([(1, one, "", 0), (shared_id, one, "", 0), (shared_id, two, "", 0), (None, "a b", "", 0)], DOCS)
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert got == sorted([(1, 0), (shared_id or 0, 60), (shared_id or 0, 0), (0, 0)])


def test_many_rows_without_ids_share_a_passage(spark):
    """Null ids are not earlier than each other, whatever the partitions and their number."""
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(None, f"own{i} {passage} end{i}", "", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert {r.n_removed for r in substrings.remove_repeats(docs).collect()} == {0}
    with_first = spark.createDataFrame([(3, passage, "", 0), *rows], DOCS).repartition(5)
    got = [(r.doc_id, r.n_removed) for r in substrings.remove_repeats(with_first).collect()]
    assert sorted(got, key=repr) == sorted([(3, 0), *[(None, 70)] * 300], key=repr)
