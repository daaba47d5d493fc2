"""From attempts to stored reports, and from stored reports to a comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeprep.functions.completions import assemble_solution, extract_code
from codeprep.operators.comparison import BASELINE, FINETUNED, fixed_and_broken, metric_table
from codeprep.operators.evaluation import (
    RUN,
    failed_tasks,
    per_problem,
    problem_errors,
    run_summary,
    with_run_details,
)
from codeprep.sources.reports import read_problems, read_summary, write_reports
from codeprep.staging import stage


def solutions(completions: DataFrame) -> DataFrame:
    """Code of each answer, and the problem text completed with it."""
    code = extract_code(F.col("response"))
    return completions.select("task_id", "sample_idx", "prompt", code.alias("code")).withColumn(
        "solution", assemble_solution(F.col("prompt"), F.col("code"))
    )


def evaluate(attempts: DataFrame, runs: DataFrame, path: str) -> None:
    """Score all runs in ``attempts`` and write their reports below ``path``.

    Runs of other calls stay as they are; a run that is evaluated again is replaced.
    """
    problems = stage(per_problem(attempts), "problems")
    summary = with_run_details(run_summary(problems), runs)
    write_reports(summary, problems, problem_errors(attempts), path)


def compare(
    spark: SparkSession,
    paths: Sequence[str],
    baseline: str = BASELINE,
    finetuned: str = FINETUNED,
) -> tuple[DataFrame, DataFrame]:
    """Metric table, and fixed and broken problems, of two runs stored in one or more folders."""
    summary = read_summary(spark, paths, [baseline, finetuned])
    failed = failed_tasks(read_problems(spark, paths))
    chosen = failed.filter(F.col(RUN).isin(baseline, finetuned))
    return (
        metric_table(summary, baseline, finetuned),
        fixed_and_broken(chosen, baseline, finetuned),
    )
