"""Exact order statistics and row numbers without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.staging import stage

# monotonically_increasing_id() keeps the partition number above this many bits.
_ROW_BITS = 33

# Rows that one task may rank, and how far around the wanted place a sketch is asked.
MOST_RANKED = 100_000
SLACK = 0.02


def smallest_cutoff(keys: DataFrame, count: int | Column, prefix: int = 4) -> DataFrame:
    """The ``count``-th smallest value of the text column ``key``, as a one-row table.

    ``count`` is a number or an expression over ``total``, the number of keys. Besides ``key``
    the row tells how many keys have this value (``ties``) and how many of them are among the
    first ``count`` (``take``). The table is empty when there are fewer keys.

    Keys are counted by their first ``prefix`` characters, the running count
    finds the one prefix that holds the cutoff, and only the different keys with that
    prefix are ranked. For hashed keys the prefixes are equally full: 16^4 of
    them leave one task with 1/65536 of the different keys, and only the keys. Counts are
    combined before the shuffle, so a key of many rows is one row per task.
    """
    wanted = F.lit(count) if isinstance(count, int) else count
    head = F.substring("key", 1, prefix)
    sizes = keys.groupBy(head.alias("head")).agg(F.count("*").alias("size"))
    everything = Window.partitionBy()
    up_to = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, 0)
    target = (
        sizes.withColumn("upto", F.sum("size").over(up_to))
        .withColumn("total", F.sum("size").over(everything))
        .withColumn("wanted", wanted.cast("bigint"))
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("size") < F.col("wanted")))
        .select("head", (F.col("wanted") - F.col("upto") + F.col("size")).alias("nth"))
    )
    # target has at most one row.
    candidates = keys.withColumn("head", head).join(F.broadcast(target), "head")
    in_head = Window.partitionBy("head").orderBy("key")
    before = F.col("upto") - F.col("ties")
    return (
        candidates.groupBy("head", "nth", "key").agg(F.count("*").alias("ties"))
        .withColumn("upto", F.sum("ties").over(in_head))
        .filter((F.col("upto") >= F.col("nth")) & (before < F.col("nth")))
        .select("key", "ties", (F.col("nth") - before).alias("take"))
    )


def nth_smallest(df: DataFrame, column: str, count: int) -> Row | None:
    """``(value, ties, take)`` like ``smallest_cutoff``, for the numbers in a column.

    Nulls are smaller than all numbers. Nothing when there are fewer rows. A quantile sketch
    proposes two numbers around the wanted place, and an exact count tells on which of them or
    between which it lies; the rows that are left shrink to a few hundredths each time, until
    they are few enough to rank. Only the column is read.
    """
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    kind, sort = ("bigint", "bigint") if whole else ("double", "double")
    values = df.select(F.col(column).cast(sort).alias("value"))
    total = values.agg(F.count("*").alias("n"), F.count("value").alias("known")).first()
    nulls = total.n - total.known
    if count > total.n:
        return None
    if count <= nulls:
        return Row(value=None, ties=nulls, take=count)
    inside, size, wanted = values.filter("value IS NOT NULL"), total.known, count - nulls
    sketch = getattr(F, f"kll_sketch_agg_{kind}")("value")
    quantile = getattr(F, f"kll_sketch_get_quantile_{kind}")
    while size > MOST_RANKED:
        around = [min(max((wanted + d * SLACK * size) / size, 0.0), 1.0) for d in (-1, 1)]
        low, high = inside.agg(sketch.alias("s")).select(*[quantile("s", F.lit(r)) for r in around]).first()
        value = F.col("value")
        counts = inside.agg(
            F.count_if(value < low), F.count_if(value == low), F.count_if((value > low) & (value < high)),
            F.count_if((value == high) & (value != low)),
        ).first()
        for n, part in zip(counts, (value < low, low, (value > low) & (value < high), high)):
            if wanted <= n:
                break
            wanted -= n
        else:
            n, part = size - sum(counts), value > high
        if not isinstance(part, Column):
            return Row(value=part, ties=n, take=wanted)
        inside, size = inside.filter(part), n
    upto = Window.orderBy("value")
    return (
        inside.groupBy("value").agg(F.count("*").alias("ties"))
        .withColumn("upto", F.sum("ties").over(upto))
        .filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("ties") < wanted))
        .select("value", "ties", (F.lit(wanted) - F.col("upto") + F.col("ties")).alias("take"))
        .first()
    )


def number_as_stored(df: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the order of the partitions.

    A row's number is its place in its partition plus the size of the partitions before it.
    The rows are written once, so both steps see the same partitions.
    """
    placed = stage(df.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn(
        "_part", F.shiftright("_at", _ROW_BITS)
    )
    # One row per partition, a few numbers each.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, place + F.col("_start"))
        .drop("_at", "_part", "_start")
    )


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the total order ``order``.

    The rows are range-partitioned and sorted, then numbered as they are stored. ``order`` must
    not tie.
    """
    return number_as_stored(df.orderBy(*order), name)
