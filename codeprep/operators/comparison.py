"""Comparing two evaluation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASELINE = "baseline"
FINETUNED = "finetuned"


def fixed_and_broken(
    failed: DataFrame, baseline: str = BASELINE, finetuned: str = FINETUNED
) -> DataFrame:
    """Problems that failed in one run only, in text order of the task id.

    "fixed" failed in the baseline only, "broken" in the new run only. One
    aggregation per task replaces the two set differences.
    """
    sides = failed.groupBy("task_id").agg(
        F.bool_or(F.col("label") == baseline).alias("before"),
        F.bool_or(F.col("label") == finetuned).alias("after"),
    )
    change = F.when(F.col("before"), "fixed").otherwise("broken")
    sides = sides.filter(F.col("before") != F.col("after"))
    return sides.select(change.alias("change"), "task_id").orderBy("change", "task_id")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count("*").alias("n_tasks"))


def _side_by_side(summary: DataFrame, baseline: str, finetuned: str) -> DataFrame:
    """Both summaries in one row; empty unless both runs are there."""
    sides = {"old": F.col("label") == baseline, "new": F.col("label") == finetuned}
    values = [
        F.max(F.when(run, F.col(metric))).alias(f"{metric}_{side}")
        for side, run in sides.items()
        for metric in ("pass_at_1", "pass_at_10", "num_passed", "num_problems")
    ]
    both = F.col("num_problems_old").isNotNull() & F.col("num_problems_new").isNotNull()
    return summary.agg(*values).filter(both)


def metric_table(
    summary: DataFrame, baseline: str = BASELINE, finetuned: str = FINETUNED
) -> DataFrame:
    """Metric, value of each run, and change.

    The pass@10 line needs a non-zero value on both sides; the total has no change.
    """

    def line(order: int, title: str, metric: str, with_delta: bool = True):
        old, new = (F.col(f"{metric}_{side}").cast("double") for side in ("old", "new"))
        delta = F.round(new - old, 2) if with_delta else F.lit(None).cast("double")
        return F.struct(
            F.lit(order).alias("line"),
            F.lit(title).alias("metric"),
            old.alias("baseline"),
            new.alias("finetuned"),
            delta.alias("delta"),
        )

    lines = F.array(
        line(1, "pass@1 (%)", "pass_at_1"),
        line(2, "pass@10 (%)", "pass_at_10"),
        line(3, "Problems passed", "num_passed"),
        line(4, "Total problems", "num_problems", with_delta=False),
    )
    table = _side_by_side(summary, baseline, finetuned).select(F.inline(lines))
    both = (F.col("baseline") != 0) & (F.col("finetuned") != 0)
    return table.filter((F.col("metric") != "pass@10 (%)") | both)


def headline(
    summary: DataFrame,
    model: str,
    n_training_samples: int,
    baseline: str = BASELINE,
    finetuned: str = FINETUNED,
) -> DataFrame:
    """One sentence on the gain in pass@1; the sample count is the caller's."""
    old, new = F.col("pass_at_1_old"), F.col("pass_at_1_new")
    text = F.concat(
        F.lit(f"Fine-tuned {model} on {n_training_samples} Python samples, improving pass@1 from "),
        old.cast("string"),
        F.lit("% -> "),
        new.cast("string"),
        F.format_string("%% (+%.1f%%)", new - old),
    )
    return _side_by_side(summary, baseline, finetuned).select(text.alias("headline"))
