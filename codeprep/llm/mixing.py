"""Mixing sources to target weights by hash-threshold histograms.

Every source has a target number of words. A document is taken whole as often as its source's
target holds all of the source, and once more if its hash lies below the source's threshold.
Words are summed by source and the first hex digits of the hash; the bucket in which the
running sum passes the budget is the only one looked at again, with the next digits. After
``LEVELS`` levels the last bucket is taken or left, whichever ends nearer to the budget. No
rows are sorted; sums combine before the shuffle, so a source with a third of all rows is no
burden; per source and level only the buckets' sums meet.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share all words. A
target stops at ``MOST`` times its source's words; what is over is shared again by weight
until none is above. That is one common level, targets being the smaller of level times
weight and the stop, and it is found from running sums over the sources, ordered by the level
at which they stop.

Null texts and texts without words have size 0 and take no part in sums. A null source is a
source of its own. Rows that repeat have one hash: they are all taken or all left. Null ids
are told apart by their texts. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeprep.staging import stage

WEIGHTS = (1, 2, 3)
MOST = 3
LEVELS = 3
DIGITS = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)``, one row per source, from rows of source and size."""
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(in_order))
        .withColumn(
            "weight", F.array(*[F.lit(w) for w in weights])[(F.col("n") - 1) % len(weights)].cast("bigint")
        )
        .withColumn("stop", F.lit(most) * F.col("source_size"))
    )
    # Sources that stop at a lower level come first.
    by_level = Window.orderBy(F.col("stop") / F.col("weight"), "n").rowsBetween(
        Window.unboundedPreceding, -1
    )
    measured = (
        sources.withColumn("stopped", F.coalesce(F.sum("stop").over(by_level), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(by_level), F.lit(0)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights_all", F.sum("weight").over(everything))
        .withColumn("rest", (F.col("total") - F.col("stopped")).cast("double"))
        .withColumn("open", (F.col("weights_all") - F.col("weights_before")).cast("double"))
        # This source stays below its stop if all before it have stopped.
        .withColumn("fits", F.col("rest") * F.col("weight") <= F.col("stop") * F.col("open"))
        .withColumn("first_fit", F.min(F.when(F.col("fits"), F.struct("stopped", "rest", "open"))).over(everything))
    )
    level = F.col("first_fit")
    target = F.when(
        level.isNotNull() & (F.col("stopped") >= level["stopped"]) & (F.col("open") <= level["open"]),
        F.col("weight") * level["rest"] / level["open"],
    ).otherwise(F.col("stop").cast("double"))
    return measured.select("source", "source_size", target.alias("target"))


def _per_source(rows: DataFrame, of_sources: DataFrame) -> DataFrame:
    """Adds the columns of a table with one row per source; null is a source."""
    named = of_sources.withColumnRenamed("source", "_source")
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")


def _cuts(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(source, prefix, with_prefix)``: hashes below this prefix are taken once more.

    Level by level the one bucket is kept in which the running sum passes the budget.
    """
    at = budgets.select("source", F.lit("").alias("prefix"), "budget")
    for level in range(1, LEVELS + 1):
        digits = level * DIGITS
        inside = _per_source(sized, at).filter(
            F.substring("hash", 1, digits - DIGITS) == F.col("prefix")
        )
        buckets = inside.groupBy(
            "source", "budget", F.substring("hash", 1, digits).alias("bucket")
        ).agg(F.sum("size").alias("words"))
        up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        passing = buckets.withColumn("upto", F.sum("words").over(up_to)).filter(
            (F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("words") <= F.col("budget"))
        )
        left = F.col("budget") - (F.col("upto") - F.col("words"))
        at = passing.select("source", F.col("bucket").alias("prefix"), left.alias("budget"), "words")
    return at.select(
        "source",
        "prefix",
        # The last bucket is taken if that ends nearer to the budget.
        (F.col("words") - F.col("budget") < F.col("budget")).alias("with_prefix"),
    )


def plan_mix(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """One row per source: source_size, target, whole (times that all of it is taken), prefix and
    with_prefix (which hashes are taken once more). ``sized`` has source, size and hash.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    goals = stage(
        targets(sized, weights, most)
        .withColumn("whole", F.floor(ratio))
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")),
        "targets",
    )
    cuts = _cuts(sized.filter("size > 0"), goals.filter("budget > 0").select("source", "budget"))
    named = cuts.withColumnRenamed("source", "_source")
    return stage(
        goals.join(named, goals["source"].eqNullSafe(named["_source"]), "left").select(
            "source", "source_size", "target", "whole", "prefix", "with_prefix"
        ),
        "mix-plan",
    )


def times_taken(hash_of_row: Column, whole: Column, prefix: Column, with_prefix: Column) -> Column:
    """How often a row is taken, by the plan of its source."""
    head = F.substring(hash_of_row, 1, LEVELS * DIGITS)
    once_more = (head < prefix) | ((head == prefix) & with_prefix)
    return (whole + F.coalesce(once_more, F.lit(False)).cast("int")).cast("int")


def _sizes(documents: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return stage(
        documents.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            row_hash(F.col(id_col), F.col(text_col)).alias("hash"),
        ),
        "sizes",
    )


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """Per document: id, hash, size, source_size, target, times (how often it is taken), taken."""
    sized = _sizes(documents, id_col, text_col, source_col)
    times = times_taken(*map(F.col, ("hash", "whole", "prefix", "with_prefix")))
    return _per_source(sized, plan_mix(sized, weights, most)).withColumn("times", times).select(
        F.col("id").alias(id_col),
        "hash",
        "size",
        "source_size",
        "target",
        "times",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def row_hash(row_id: Column, text: Column) -> Column:
    """MD5 of id and text as hex; the same for the same row in every run."""
    return F.md5(F.concat_ws(":", row_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def mixed_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of the mix: every document as often as it is taken.

    Only the plan, one row per source, is joined with the documents; texts do not move.
    """
    plan = plan_mix(_sizes(documents, id_col, text_col, source_col))
    names = {c: f"_mix_{c}" for c in plan.columns}
    plan = plan.withColumnsRenamed(names)
    times = times_taken(
        row_hash(documents[id_col], documents[text_col]),
        *[F.col(f"_mix_{c}") for c in ("whole", "prefix", "with_prefix")],
    )
    return (
        documents.join(plan, documents[source_col].eqNullSafe(plan["_mix_source"]))
        .withColumn("_mix_times", times)
        .filter("_mix_times > 0")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times"))))
        .select(*[documents[c] for c in documents.columns])
    )
