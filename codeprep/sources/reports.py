"""Run reports: three JSON tables, versioned under a manifest, and one nested document as an export."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeprep.operators.evaluation import RUN

# Keys of a nested report and of its per-problem entries.
REPORT_SCHEMA = """
    label string, model_path string, timestamp string, num_problems bigint,
    num_samples bigint, temperature double, `pass@1` double, `pass@10` double,
    num_passed bigint, num_failed bigint, elapsed_sec double, failed_tasks array<string>,
    per_problem array<struct<task_id: string, num_correct: bigint, num_samples: bigint,
                             `pass@1`: double, errors: array<string>>>
"""

# The store: one folder per table, in it one folder per version, which one evaluation wrote.
TABLES = {
    "summary": """label string, num_problems bigint, num_samples bigint, pass_at_1 double,
        pass_at_10 double, num_passed bigint, num_failed bigint, model_path string,
        timestamp string, temperature double, elapsed_sec double""",
    "per_problem": """label string, task_id string, row_idx bigint, num_correct bigint,
        num_samples bigint, num_errors bigint, pass_at_1 double""",
    "errors": "label string, task_id string, sample_idx bigint, error string",
}

# Manifests are numbered; the one of the highest number holds.
_MANIFEST = "manifest-"


class Manifest:
    """Which version of each run holds: a small file that is put in its place whole.

    An evaluation first writes its tables under a new version, where no reader looks, and then
    a manifest that names it. A driver that is lost on the way leaves the old manifest, and
    with it all old reports. Two evaluations that end together cannot take the same number: the
    later one reads again what holds, adds its runs and takes the next number.
    """

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._jvm, self._folder = jvm, jvm.org.apache.hadoop.fs.Path(path)
        conf = spark._jsc.hadoopConfiguration()
        self._store = self._folder.getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), conf)
        # A rename without options fails where the name is taken.
        self._keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def _last(self) -> int:
        if not self._store.exists(self._folder):
            return 0
        names = [status.getPath().getName() for status in self._store.listStatus(self._folder)]
        return max([int(n.removeprefix(_MANIFEST)) for n in names if n.startswith(_MANIFEST)], default=0)

    def _read(self, number: int) -> list[dict]:
        if not number:
            return []
        source = self._store.open(self._child(f"{_MANIFEST}{number:08d}"))
        try:
            return json.loads(bytes(source.readAllBytes()))
        finally:
            source.close()

    def runs(self) -> list[dict]:
        """``run`` and ``version`` of all runs; a run may have no name."""
        return self._read(self._last())

    def put(self, version: str, runs: Sequence[str | None]) -> None:
        """The runs are those of this version from now on; others stay."""
        while True:
            number = self._last()
            others = [entry for entry in self._read(number) if entry["run"] not in runs]
            entries = others + [{"run": run, "version": version} for run in runs]
            draft = self._child(f"_{version}-{number}")
            out = self._store.create(draft, True)
            out.write(json.dumps(entries, indent=1).encode())
            out.close()
            final = self._child(f"{_MANIFEST}{number + 1:08d}")
            try:
                if not self._store.exists(final):
                    return self._files.rename(self._store.makeQualified(draft), self._store.makeQualified(final), self._keep)
            except Py4JJavaError:
                if not self._store.exists(final):
                    raise
            self._store.delete(draft, False)


def write_reports(summary: DataFrame, problems: DataFrame, errors: DataFrame, path: str) -> None:
    """Write the runs below ``path``; runs that are there already are replaced, others stay.

    They are replaced together, when all three tables are written.
    """
    version = uuid.uuid4().hex
    for name, table in (("summary", summary), ("per_problem", problems), ("errors", errors)):
        # Null fields are written: a report always has the key pass@10.
        table.write.option("ignoreNullFields", False).json(f"{path}/{name}/version={version}")
    spark = summary.sparkSession
    written = spark.read.schema(TABLES["summary"]).json(f"{path}/summary/version={version}")
    runs = [r[RUN] for r in written.select(RUN).distinct().collect()]
    Manifest(spark, path).put(version, runs)


def read_table(spark: SparkSession, paths: Sequence[str], name: str) -> DataFrame:
    """One table of the runs in one or several folders; a folder without reports is an error."""
    parts = []
    for path in paths:
        versions: dict[str, list] = {}
        for entry in Manifest(spark, path).runs():
            versions.setdefault(entry["version"], []).append(entry["run"])
        if not versions:
            raise FileNotFoundError(f"run all evaluations to compare first: no reports in {path}")
        folders = [f"{path}/{name}/version={version}" for version in versions]
        # Labels and versions are text, whatever they look like.
        rows = spark.read.schema(f"{TABLES[name]}, version string").option("basePath", f"{path}/{name}").json(folders)
        holds = [
            (F.col("version") == version) & (F.col(RUN).isin([r for r in runs if r is not None]) | F.lit(None in runs) & F.col(RUN).isNull())
            for version, runs in versions.items()
        ]
        parts.append(rows.filter(reduce(or_, holds)).drop("version"))
    return reduce(DataFrame.unionByName, parts)


def read_summary(spark: SparkSession, paths: Sequence[str], runs: Sequence[str] = ()) -> DataFrame:
    """Summaries of all runs, or of the wanted ones, which all must be there."""
    summary = read_table(spark, paths, "summary")
    if runs:
        summary = summary.filter(F.col(RUN).isin(*runs))
        found = {r[RUN] for r in summary.select(RUN).distinct().collect()}
        if missing := set(runs) - found:
            raise FileNotFoundError(f"run all evaluations to compare first: {sorted(missing)}")
    return summary


def read_problems(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "per_problem")


def read_errors(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "errors")


def nested_report(summary: DataFrame, problems: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per run in the report layout, problems in problem-set order.

    All problems and errors of a run meet in one row: for runs that fit in memory, by the
    caller's choice. A run without problems has empty lists.
    """
    listed = F.array_sort(F.collect_list(F.struct("sample_idx", "error")))
    lists = (
        errors.groupBy(RUN, "task_id")
        .agg(listed.alias("listed"))
        .select(RUN, "task_id", F.col("listed.error").alias("errors"))
    )
    entry = F.struct(
        "task_id",
        "num_correct",
        "num_samples",
        F.col("pass_at_1").alias("pass@1"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
    )
    placed = F.array_sort(F.collect_list(F.struct("row_idx", entry.alias("entry"))))
    details = (
        problems.join(lists, [RUN, "task_id"], "left")
        .groupBy(RUN)
        .agg(placed.alias("placed"))
        .select(RUN, F.col("placed.entry").alias("per_problem"))
    )
    failed = F.filter("per_problem", lambda p: p["pass@1"] == 0)
    none = "cast(array() as array<struct<task_id: string, num_correct: bigint, num_samples: bigint, `pass@1`: double, errors: array<string>>>)"
    whole = summary.join(details, RUN, "left").withColumn(
        "per_problem", F.coalesce("per_problem", F.expr(none))
    )
    return whole.select(
        RUN,
        "model_path",
        "timestamp",
        "num_problems",
        "num_samples",
        "temperature",
        F.col("pass_at_1").alias("pass@1"),
        F.col("pass_at_10").alias("pass@10"),
        "num_passed",
        "num_failed",
        "elapsed_sec",
        F.transform(failed, lambda p: p["task_id"]).alias("failed_tasks"),
        "per_problem",
    )


def export_nested(spark: SparkSession, paths: Sequence[str], runs: Sequence[str], out: str) -> None:
    """Write stored runs as one JSON document each, in a folder per run below ``out``."""
    chosen = F.col(RUN).isin(*runs)
    report = nested_report(
        read_summary(spark, paths, runs),
        read_problems(spark, paths).filter(chosen),
        read_errors(spark, paths).filter(chosen),
    )
    (
        report.withColumn("run", F.col(RUN))
        .write.partitionBy("run")
        .option("ignoreNullFields", False)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .json(out)
    )


def read_nested(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read nested documents; every path must exist.

    The schema is given because an all-null pass@10 would be inferred as text.
    """
    try:
        return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(list(paths))
    except AnalysisException as error:
        raise FileNotFoundError(f"run all evaluations to compare first: {error}") from error


def nested_summary(reports: DataFrame) -> DataFrame:
    """Nested documents in the shape of ``evaluation.run_summary``."""
    return reports.select(
        RUN,
        "num_problems",
        "num_samples",
        F.col("`pass@1`").alias("pass_at_1"),
        F.col("`pass@10`").alias("pass_at_10"),
        "num_passed",
        "num_failed",
    )


def nested_problems(reports: DataFrame) -> DataFrame:
    """Per-problem rows of nested documents in the shape of ``evaluation.per_problem``."""
    return reports.select(RUN, F.posexplode("per_problem").alias("row_idx", "p")).select(
        RUN,
        "p.task_id",
        F.col("row_idx").cast("bigint").alias("row_idx"),
        "p.num_correct",
        "p.num_samples",
        F.size("p.errors").cast("bigint").alias("num_errors"),
        F.col("p.`pass@1`").alias("pass_at_1"),
    )
