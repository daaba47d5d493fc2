"""From attempts to per-problem scores, run summaries, progress and error lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeprep.functions.scores import pass_at_k, percent, percent_or_null
from codeprep.operators.ranking import number_rows

# Sample count from which pass@10 is defined, problems per progress line.
PASS_10_SAMPLES = 10
PROGRESS_STEP = 20

# Progress steps whose running sum one task forms.
STEPS_PER_BLOCK = 4096

RUN = "label"
PROBLEM = ("label", "task_id")


def per_problem(attempts: DataFrame) -> DataFrame:
    """Correct and total samples and pass@1 per problem of a run.

    Counts only, so each map task sends one row per problem; a problem that
    holds a third of the attempts needs no special care. ``row_idx`` is the
    problem's position in the problem set.
    """
    counts = attempts.groupBy(*PROBLEM).agg(
        F.min("row_idx").alias("row_idx"),
        F.count_if("passed").alias("num_correct"),
        F.count("*").alias("num_samples"),
        F.count_if(has_error(F.col("error"))).alias("num_errors"),
    )
    return counts.withColumn(
        "pass_at_1", pass_at_k(F.col("num_samples"), F.col("num_correct"), 1)
    )


def has_error(error: Column) -> Column:
    return F.coalesce(error != "", F.lit(False))


def problem_errors(attempts: DataFrame) -> DataFrame:
    """Non-empty errors, a row each; ``sample_idx`` gives their order in a problem."""
    return attempts.filter(has_error(F.col("error"))).select(*PROBLEM, "sample_idx", "error")


def run_summary(problems: DataFrame) -> DataFrame:
    """One row per run: mean scores in percent, passed and failed problems.

    pass@10 needs ten samples for every problem; a pass@10 of exactly zero is
    reported as null, too.
    """
    n, c = F.col("num_samples"), F.col("num_correct")
    means = problems.groupBy(RUN).agg(
        F.count("*").alias("num_problems"),
        F.min("num_samples").alias("num_samples"),
        F.avg("pass_at_1").alias("mean_1"),
        F.avg(pass_at_k(n, c, 10)).alias("mean_10"),
        F.count_if(F.col("pass_at_1") > 0).alias("num_passed"),
        F.count_if(F.col("pass_at_1") == 0).alias("num_failed"),
    )
    return means.select(
        RUN,
        "num_problems",
        "num_samples",
        percent(F.col("mean_1")).alias("pass_at_1"),
        F.when(
            F.col("num_samples") >= PASS_10_SAMPLES, percent_or_null(F.col("mean_10"))
        ).alias("pass_at_10"),
        "num_passed",
        "num_failed",
    )


def with_run_details(summary: DataFrame, runs: DataFrame) -> DataFrame:
    """Add what is known about each run: model_path, timestamp, temperature, elapsed_sec.

    Of several rows for one run the one with the latest timestamp counts.
    """
    newest = F.max(F.struct("timestamp", "model_path", "temperature", "elapsed_sec")).alias("run")
    details = (
        runs.groupBy(RUN)
        .agg(newest)
        .select(
            RUN,
            "run.model_path",
            "run.timestamp",
            "run.temperature",
            F.round("run.elapsed_sec", 1).alias("elapsed_sec"),
        )
    )
    return summary.join(details, RUN, "left")


def failed_tasks(problems: DataFrame) -> DataFrame:
    """Problems without a correct sample, as rows; ``row_idx`` gives their order."""
    return problems.filter(F.col("pass_at_1") == 0).select(RUN, "row_idx", "task_id")


def running_pass1(problems: DataFrame) -> DataFrame:
    """Mean pass@1 of the problems so far, at every 20th problem of a run.

    Problems are counted in ``row_idx`` order, whatever their numbers. Scores
    are first summed per step of 20; the running sum is formed inside blocks
    of steps, and a second one over block totals gives each block its start.
    No task sees more than one block, or the block totals of one run. Both
    read the same shuffle.
    """
    named = problems.filter(F.col(RUN).isNotNull()).select(*PROBLEM, "row_idx", "pass_at_1")
    order = [F.col(RUN), F.col("row_idx"), F.col("task_id"), F.col("pass_at_1")]
    numbered = number_rows(named, order, "place")
    first = numbered.groupBy(F.col(RUN).alias("run")).agg(F.min("place").alias("first"))
    step = F.floor((F.col("place") - F.col("first")) / PROGRESS_STEP)
    steps = (
        numbered.join(first, numbered[RUN] == first["run"])
        .groupBy(RUN, step.alias("step"))
        .agg(F.sum("pass_at_1").alias("score"), F.count("*").alias("n"))
        .withColumn("block", F.floor(F.col("step") / STEPS_PER_BLOCK))
    )
    in_block = Window.partitionBy(RUN, "block").orderBy("step")
    before = Window.partitionBy(RUN).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        steps.groupBy(RUN, "block")
        .agg(F.sum("score").alias("score"), F.sum("n").alias("n"))
        .select(
            RUN,
            "block",
            F.coalesce(F.sum("score").over(before), F.lit(0.0)).alias("score_before"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        )
    )
    so_far = steps.select(
        RUN,
        "block",
        "n",
        F.sum("score").over(in_block).alias("score_in"),
        F.sum("n").over(in_block).alias("n_in"),
    ).filter(F.col("n") == PROGRESS_STEP)
    done = F.col("n_before") + F.col("n_in")
    return so_far.join(starts, [RUN, "block"], "left").select(
        RUN,
        done.alias("n_done"),
        ((F.col("score_before") + F.col("score_in")) / done).alias("pass_at_1_so_far"),
    )


def report_lines(summary: DataFrame) -> DataFrame:
    """The text block that a run prints at its end."""
    title = F.concat(F.lit("RESULTS - "), F.upper(RUN))
    lines = F.concat_ws(
        "\n",
        title,
        F.concat(F.lit("pass@1: "), F.col("pass_at_1").cast("string"), F.lit("%")),
        F.concat(F.lit("pass@10: "), F.col("pass_at_10").cast("string"), F.lit("%")),
        F.format_string("Passed: %d / %d", "num_passed", "num_problems"),
        F.when(
            F.col("elapsed_sec").isNotNull(),
            F.format_string("Time: %.1f min", F.col("elapsed_sec") / 60),
        ),
    )  # concat_ws leaves out the lines that are null
    return summary.select(RUN, lines.alias("report"))
