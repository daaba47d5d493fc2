import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from codeprep.llm import arrays, langid
from codeprep.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, score string, source string"
SYLLABLES = {"one": "ka lo mi tu ra", "two": "sch ein ung ber ch", "three": "ão é ñi ção ll"}


def make(n, seed=1):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        word = lambda: "".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 4)))
        docs.append((i, " ".join(word() for _ in range(rng.randint(3, 60))), lang, "x", "y"))
    return docs


def test_held_out_accuracy(spark):
    docs = make(400)
    truth = {d[0]: d[2] for d in docs}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    # Held-out rows carry a language that must not be learnt.
    given = [(*d[:2], "never" if d[0] in held else d[2], *d[3:]) for d in docs]
    got = langid.predict_language(spark.createDataFrame(given, DOCS)).collect()
    assert {r.doc_id for r in got if r.held_out} == held
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.98


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op10_langid"](spark, folder).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.99


def test_odd_texts_and_tables(spark):
    odd = [(1000, None, "one", "x", "y"), (1001, "", "one", "x", "y"), (1002, "12 ?! _", "one", "x", "y")]
    odd += [(None, "schein", "one", "x", "y"), (3, "kalo", None, "x", "y"), (3, "kalo", None, "x", "y")]
    got = langid.predict_language(spark.createDataFrame(make(100) + odd, DOCS)).collect()
    assert len(got) == 106
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if (r.doc_id or 0) >= 1000} == {
        i: ("und", 0.0) for i in (1000, 1001, 1002)
    }
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert langid.predict_language(spark.createDataFrame([], DOCS)).count() == 0
    unlearnt = spark.createDataFrame([(*d[:2], None, *d[3:]) for d in make(20)], DOCS)
    assert {(r.lang_pred, r.score) for r in langid.predict_language(unlearnt).collect()} == {("und", 0.0)}
    single = spark.createDataFrame([(*d[:2], "one", *d[3:]) for d in make(20)], DOCS)
    assert {(r.lang_pred, r.score) for r in langid.predict_language(single).collect()} == {("one", 1.0)}


def grams(text):
    """Distinct runs of one to three bytes, by definition."""
    data = bytes(langid._FOLD[np.frombuffer(text.encode(), np.uint8)])
    return {data[i : i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}


def test_presence_counts_and_values():
    texts = [d[1] for d in make(30)] + ["", "a", "ab"]
    data, offsets = arrays.utf8(pa.array(texts))
    owner, gram = langid._codes(data, offsets)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(grams(t)) for t in texts]
    per_text = [gram[owner == i] for i in range(30)]
    langs = [d[2] for d in make(30)]
    marks = np.arange(30) < 12
    model = langid.fit_model(per_text, langs, marks)
    # The kernel by definition, and the regression through it.
    sets = [grams(t) for t in texts[:30]]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    to_marks = np.array([[kernel(a, b) for b in sets[:12]] for a in sets])
    values, vectors = np.linalg.eigh(to_marks[:12])
    keep = values > 1e-6 * values[-1]
    x = to_marks @ (vectors[:, keep] / np.sqrt(values[keep]))
    y = np.array([[1.0 if lang == one else -1.0 for one in model.languages] for lang in langs])
    centred = x - x.mean(axis=0)
    beta = np.linalg.solve(
        centred.T @ centred + langid.RIDGE * 30 * np.eye(x.shape[1]), centred.T @ (y - y.mean(axis=0))
    )
    expected = centred @ beta + y.mean(axis=0)
    assert model.values(data, offsets)[:30] == pytest.approx(expected, abs=1e-4)


def test_repeated_ids_give_the_same_model_under_any_partitioning(spark):
    docs = make(120)
    docs += [(i, text, lang, "x", "y") for (i, _, lang, _, _), (_, text, _, _, _) in zip(docs[:60], docs[60:])]
    scores = []
    for parts in (1, 3, 7):
        got = langid.predict_language(spark.createDataFrame(docs, DOCS).repartition(parts, "text")).collect()
        scores.append(sorted((r.doc_id, r.lang_pred, r.score) for r in got))
    assert scores[0] == scores[1] == scores[2]
