"""Cleaning, quality rules and duplicate removal for instruction triples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeprep.functions.text import clean_text, computed_once, dedup_key
from codeprep.sources.instructions import ORDER

# Bounds in code points, both inclusive, and the code keywords.
MIN_OUTPUT = 50
MAX_OUTPUT = 4000
MIN_INSTRUCTION = 10
CODE_KEYWORDS = ("def ", "import ", "class ", "return ", "print(", "for ", "if ")


def clean(samples: DataFrame) -> DataFrame:
    """Strip instruction and output and take foreign end markers out; input stays as it is."""
    return computed_once(
        samples, {c: clean_text(F.col(c)) for c in ("instruction", "output")}
    )


def output_length_ok(output: Column) -> Column:
    return F.length(output).between(MIN_OUTPUT, MAX_OUTPUT)


def has_keyword(output: Column) -> Column:
    return reduce(or_, [output.contains(keyword) for keyword in CODE_KEYWORDS])


def instruction_ok(instruction: Column) -> Column:
    return F.length(instruction) >= MIN_INSTRUCTION


def is_good(instruction: Column, output: Column) -> Column:
    """All quality rules."""
    return instruction_ok(instruction) & output_length_ok(output) & has_keyword(output)


def quality_filter(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(is_good(F.col("instruction"), F.col("output")))


def quality_rejects(cleaned: DataFrame) -> DataFrame:
    """Rows that fail each rule; a row may fail several."""
    output, instruction = F.col("output"), F.col("instruction")
    failed = {
        "output_length": ~output_length_ok(output),
        "instruction_length": ~instruction_ok(instruction),
        "no_keyword": ~has_keyword(output),
        "any_rule": ~is_good(instruction, output),
    }
    counts = cleaned.agg(*[F.count_if(rule).alias(name) for name, rule in failed.items()])
    return counts.unpivot([], list(failed), "reason", "n_rejected")


def first_wins(samples: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Keep, per dedup key, the first row in source order.

    Every map task keeps one row per key before the shuffle (a partial group
    limit in the plan), so a key that holds a third of the rows reaches its
    reducer as one row per map task.
    """
    in_order = Window.partitionBy("key").orderBy(*order)
    return (
        samples.withColumn("key", dedup_key(F.col("instruction")))
        .withColumn("rn", F.row_number().over(in_order))
        .filter(F.col("rn") == 1)
        .drop("rn")
    )


def copy_groups(samples: DataFrame) -> DataFrame:
    """Histogram of dedup group sizes: how many keys have how many rows."""
    sizes = samples.groupBy(dedup_key(F.col("instruction")).alias("key")).agg(
        F.count("*").alias("group_size")
    )
    return sizes.groupBy("group_size").agg(
        F.count("*").alias("n_groups"), F.sum(F.col("group_size") - 1).alias("n_dropped")
    )


def funnel(samples: DataFrame) -> DataFrame:
    """Rows per source: loaded, after the quality rules, after duplicate removal.

    One scan. Texts are reduced to one row per (source, key) before the
    shuffle; rejected rows share the null key. The window then sees at most
    one row per source for each key.
    """
    cleaned = clean(samples)
    good = is_good(F.col("instruction"), F.col("output"))
    per_key = (
        cleaned.select(
            "source_rank", F.when(good, dedup_key(F.col("instruction"))).alias("key")
        )
        .groupBy("key", "source_rank")
        .agg(F.count("*").alias("n"))
    )
    kept = F.col("key").isNotNull()
    first_source = F.min("source_rank").over(Window.partitionBy("key"))
    return (
        per_key.withColumn("survives", kept & (F.col("source_rank") == first_source))
        .groupBy("source_rank")
        .agg(
            F.sum("n").alias("n_raw"),
            F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("n_quality"),
            F.count_if("survives").alias("n_dedup"),
        )
    )


def last_steps(encoded: DataFrame) -> DataFrame:
    """Rows per source after encoding, and how many are for training and for evaluation.

    ``encoded`` has ``split`` besides the source rank.
    """
    return encoded.groupBy("source_rank").agg(
        F.count("*").alias("n_tokenised"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "eval").alias("n_eval"),
    )
