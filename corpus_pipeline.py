"""A training corpus in five stages: toxic texts go, near copies go, benchmark passages go, sources
are mixed to their targets, and what is left is written as token records.

Every function takes (spark, docs, sf_dir) and returns a DataFrame, which a caller writes and
reads again as the next stage's docs. All but the last return the columns of documents.

Null and empty texts are clean, like each other as near copies, contaminated by nothing, of size 0
in the mix and a record with the end id alone. Rows without an id are kept by all stages but the
near-copy one, which takes them as copies like any other. Unlike texts under one id are judged
apart, equal rows alike. Of near copies that tie the smallest id stays, then the smallest hash of
the text. Further columns pass the first four stages, but for names that begin with ``_mix_``, which
the mix uses. Empty documents give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codeprep.llm import decontamination, mixing, simhash, toxicity
from codeprep.llm.queries import token_records
from codeprep.workers import reachable
from codeprep.staging import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return simhash.keep_one(docs, without_ids=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return token_records(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token records", write_tokens),
]

# Weak supervision, XXH64 fingerprints and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
