"""Very long texts, nulls in every column and repeated rows, through all operators and stages."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from codeprep.llm import (
    credentials,
    decontamination,
    langid,
    mixing,
    simhash,
    substrings,
    toxicity,
)
from codeprep.llm.queries import token_records

FOLDER = "/root/testdata/sf0.001"
N = 250_000


@pytest.fixture(scope="module")
def long_documents(spark):
    """Documents of a quarter of a million words, one of them a single word."""
    passage = " ".join(f"p{i}" for i in range(60))
    words = " ".join(f"w{i}" for i in range(N))
    rows = [
        (1, f"{words} {passage}", "en", "a", 0),
        (2, f"{passage} {words} token=abcdef12", "en", "a", 0),
        (3, "x" * 2_000_000, "de", "b", 0),
        (4, passage, "de", None, 0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_long_texts(spark, long_documents):
    docs = long_documents
    items = spark.createDataFrame([(9, " ".join(f"p{i}" for i in range(60)))], "item_id bigint, text string")
    hits = by_id(decontamination.find_contamination(docs, items))
    assert [(hits[i].n_words, hits[i].n_hit) for i in (1, 2, 3, 4)] == [
        (N + 60, 60), (N + 62, 60), (1, 0), (60, 60),
    ]
    removed = by_id(substrings.remove_repeats(docs))
    assert [(removed[i].n_words, removed[i].n_removed) for i in (1, 2, 3, 4)] == [
        (N + 60, 0), (N + 61, N + 60), (1, 0), (60, 60),
    ]
    rest = "token=abcdef12"
    assert removed[2].kept_sha256 == hashlib.sha256(rest.encode()).hexdigest()
    prints = by_id(simhash.near_copies(docs))
    assert len({prints[i].fingerprint for i in (1, 2, 3, 4)}) >= 3
    spans = by_id(credentials.with_secrets(docs).select("doc_id", credentials.listed(F.col("base_spans")).alias("s")))
    assert spans[2].s.startswith("assign:") and spans[1].s == ""
    assert {i: r.size for i, r in by_id(mixing.mix(docs)).items()} == {1: N + 60, 2: N + 61, 3: 1, 4: 60}
    assert set(by_id(langid.predict_language(docs))) == {1, 2, 3, 4}
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id bigint, toxic int")
    assert set(by_id(toxicity.toxicity(docs, labels))) == {1, 2, 3, 4}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = by_id(docs)[2].text
    ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
    written = by_id(token_records(docs))
    assert (written[2].n_tokens, written[2].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_stages_on_odd_documents(spark, kind):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    schema = docs.schema
    rows = [
        (None, None, None, None, None),
        (None, "some words here", None, None, None),
        (10_001, None, None, "src1", None),
        (10_002, "", "en", None, 0),
        (10_003, "one two three four", None, "src1", 5),
        (10_003, "one two three four", None, "src1", 5),
        (10_003, "other text", None, "src2", 5),
    ]
    odd = spark.createDataFrame(rows if kind == "odd" else [], schema)
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, odd, FOLDER)
        assert out.columns == docs.columns
        kept = [tuple(r) for r in out.collect()]
        assert set(kept) <= set(rows)
        if name != "mixing" and kind == "odd":
            assert (None, "some words here", None, None, None) in kept
            # Two of them are copies of each other, the third is another text.
            assert sum(r[0] == 10_003 for r in kept) == (2 if name.startswith("simhash") else 3)
    last = corpus_pipeline.STAGES[-1][1](spark, odd, FOLDER).collect()
    assert sorted((r.doc_id or 0) for r in last) == sorted((r[0] or 0) for r in rows if kind == "odd")
