"""pass@k and score rounding."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column
from pyspark.sql import functions as F


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """Chance that at least one of ``k`` drawn samples is among the ``c`` of ``n`` correct ones.

    C(n-c, k) / C(n, k) is the product of (n-c-j) / (n-j) for j < k, so the work
    per row is ``k`` steps however many samples a problem has.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    wrong = n - c
    # nullif keeps ANSI division safe where the first branch applies anyway.
    ratios = [
        (wrong - F.lit(j)).cast("double") / F.nullif((n - F.lit(j)).cast("double"), F.lit(0.0))
        for j in range(k)
    ]
    return F.when(wrong < k, F.lit(1.0)).otherwise(F.lit(1.0) - reduce(mul, ratios))


def percent(share: Column) -> Column:
    return F.round(share * 100, 2)


def percent_or_null(share: Column) -> Column:
    """Percent, with a share of exactly zero reported as null."""
    return F.when(share != 0, percent(share))
