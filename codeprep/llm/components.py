"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeprep.staging import stage

_ROUNDS = 60


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row.n, row.h


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns a, b); root is its smallest reachable node.

    Each round links all larger neighbours of a node to its smallest one, then all smaller
    neighbours to the smallest. Minima combine before the shuffle and nodes are joined by key,
    so the centre of a large star is spread over tasks. Rounds grow with the logarithm of the
    graph. Each round's edges are a written table, so no lineage piles up. Nulls and
    self-links are ignored; no edges give no rows.
    """
    current = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(_ROUNDS):
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = (
            both.filter("b > a").join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        current = stage(
            small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lowest.select("a", F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
        after = _digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
