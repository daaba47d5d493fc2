import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from codeprep.llm import decontamination, mixing, queries, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.QUERIES) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_do_what_their_operators_decide(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    clean = stages[0](spark, docs, FOLDER).cache()
    scored = toxicity.toxicity(docs, labels)
    assert ids(clean) == ids(scored.filter("predicted = 0"))

    single = stages[1](spark, clean, FOLDER).cache()
    assert ids(single) == ids(simhash.near_copies(clean).filter("doc_id = component_id"))

    decontaminated = stages[2](spark, single, FOLDER).cache()
    assert ids(decontaminated) == ids(
        decontamination.find_contamination(single, benchmark).filter("NOT contaminated")
    )

    mixed = stages[3](spark, decontaminated, FOLDER).cache()
    times = {r.doc_id: r.times for r in mixing.mix(decontaminated).collect()}
    assert ids(mixed) == sorted(i for i, n in times.items() for _ in range(n))
    for df in (clean, single, decontaminated, mixed):
        assert df.columns == docs.columns

    written = stages[4](spark, mixed, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for row in sorted(mixed.collect(), key=lambda r: (r.doc_id, r.text)):
        tokens = np.array(tokenizer.encode(row.text, add_special_tokens=False).ids + [2], "<u4")
        expected.append((row.doc_id, start, len(tokens), zlib.crc32(tokens.tobytes())))
        start += len(tokens)
    assert sorted(tuple(r) for r in written) == sorted(expected)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    docs = corpus_pipeline._table(spark, FOLDER, "documents")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
    assert sorted(rows) == sorted(docs.collect())
