"""Problem sets of an evaluation run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeprep.operators.ranking import nth_smallest, number_rows


def first_problems(problems: DataFrame, max_problems: int | None) -> DataFrame:
    """The first ``max_problems`` problems in ``row_idx`` order; all when not set or fewer.

    Problems without a ``row_idx`` come first. Problems of one ``row_idx`` stand in order of
    their other columns, so there are never more or fewer than asked for, and rows that still
    tie are equal.

    The last ``row_idx`` that counts is found from this column alone; then it is a filter. Only
    if it repeats, and not all of its problems are wanted, are these put in order.
    """
    if not max_problems:
        return problems
    last = nth_smallest(problems, "row_idx", max_problems)
    if last is None:
        return problems
    at = F.col("row_idx")
    earlier = F.lit(False) if last.value is None else at.isNull() | (at < last.value)
    tied = problems.filter(at.eqNullSafe(F.lit(last.value)))
    if last.take < last.ties:
        order = [F.col(c) for c in problems.columns if c != "row_idx"]
        numbered = number_rows(tied, order or [at], "_place")
        tied = numbered.filter(F.col("_place") < last.take).select(problems.columns)
        return problems.filter(earlier).unionByName(tied)
    return problems.filter(earlier | at.eqNullSafe(F.lit(last.value)))
