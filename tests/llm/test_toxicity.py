import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeprep.llm import toxicity
from codeprep.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, score string, label int"
LABELS = "doc_id bigint, toxic int, text string"


def make(n, seed=1, insults=("zork", "blarg")):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.2)
        for at in range(0, len(text), 15) if toxic else ():
            text[at] = rng.choice(insults) + rng.choice(["", "ed", "ing", "ly"])
        docs.append((i, " ".join(text), "x", 0))
        labels.append((i, toxic, "x"))
    return docs, labels


def test_folds_and_held_out_accuracy(spark):
    docs, labels = make(600)
    truth = {i: y for i, y, _ in labels}
    # Labels of held-out rows are wrong on purpose: they must not be learnt.
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    given = [(i, 1 - y if i in held else y, t) for i, y, t in labels]
    got = toxicity.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(given, LABELS)).collect()
    assert {r.doc_id for r in got if r.held_out} == held
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > 0.97
    again = toxicity.toxicity(
        spark.createDataFrame(docs[::-1], DOCS).repartition(5), spark.createDataFrame(given, LABELS)
    ).collect()
    assert {r.doc_id: r.predicted for r in again} == {r.doc_id: r.predicted for r in got}


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id").collect()
    tell = lambda y, p: sum(r.toxic == y and r.predicted == p for r in rows)
    # Some labels are noise that no text shows.
    assert tell(1, 1) / (tell(1, 1) + tell(0, 1)) > 0.95
    assert tell(1, 1) / (tell(1, 1) + tell(1, 0)) > 0.85


def test_label_model_estimates_accuracies_and_shares():
    rng = np.random.default_rng(3)
    truth = (rng.random(4000) < 0.2).astype(int)
    rates = [(0.9, 0.01), (0.6, 0.05), (0.3, 0.3)]
    votes = np.stack([rng.random(4000) < np.where(truth == 1, a, b) for a, b in rates], axis=1)
    votes = np.concatenate([votes, votes[:, 1:2]], axis=1).astype(float)  # the second voter twice
    labels = np.where(rng.random(4000) < 0.5, truth, -1)
    model, posterior = toxicity.fit_labels(votes, labels, np.ones(4000))
    assert model.toxic[0] == pytest.approx(0.9, abs=0.05) and model.clean[0] == pytest.approx(0.01, abs=0.02)
    assert model.share[1] == pytest.approx(0.5, abs=0.05) == model.share[3]
    assert model.share[0] > 0.9 and model.share[2] > 0.9
    assert np.mean((posterior > 0.5) == truth) > 0.97


def test_odd_tables(spark):
    docs, labels = make(60)
    df, given = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    odd = spark.createDataFrame([(1, None, "x", 0), (2, "", "x", 0), (None, "zork " * 9, "x", 0), (2, "?", "x", 0)], DOCS)
    scores = toxicity.toxicity(df.unionByName(odd), given).collect()
    assert len(scores) == 64
    assert [r.held_out for r in scores if r.doc_id is None] == [False]
    assert toxicity.toxicity(df.limit(0), given).count() == 0
    none = toxicity.toxicity(df, given.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    one_kind = given.withColumn("toxic", F.lit(1))
    assert {r.score for r in toxicity.toxicity(df, one_kind).collect()} == {1.0}
    unknown = given.withColumn("toxic", F.lit(None).cast("int"))
    assert {r.score for r in toxicity.toxicity(df, unknown).collect()} == {0.0}


def test_filter_keeps_rows_and_columns(spark):
    docs, labels = make(300)
    df, given = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    kept = toxicity.keep_clean(df, given)
    assert kept.schema == df.schema
    clean = {r.doc_id for r in toxicity.toxicity(df, given).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == clean
