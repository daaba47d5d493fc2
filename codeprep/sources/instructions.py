"""Instruction triples from several sources, in source order."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeprep.functions.text import or_empty
from codeprep.sources.guard import broken_files, can_check, whole_file
from codeprep.staging import stage

logger = logging.getLogger(__name__)

# Files of one source that may be left out one by one.
MOST_REJECTED = 1000

TEXT_COLUMNS = ("instruction", "input", "output")
# What orders rows that are numbered inside their source, and loaded rows of any source.
ORDER = ("source_rank", "row_idx")
SOURCE_ORDER = ("source_rank", "file", "row_idx")


@dataclass(frozen=True)
class SourceSpec:
    """One instruction source.

    ``columns`` maps a triple column to the source column that feeds it; a
    triple column that is not mapped, or whose source column is absent, is "".
    ``equals`` and ``contains`` keep rows by case-insensitive match on a source
    column. ``order_col`` is the row number inside the source and should not
    repeat; without it rows stand by file name and place in the file, so what a
    seeded sample takes depends on the file names, too.
    """

    name: str
    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=lambda: {c: c for c in TEXT_COLUMNS})
    equals: Mapping[str, str] = field(default_factory=dict)
    contains: Mapping[str, str] = field(default_factory=dict)
    order_col: str | None = None


@dataclass(frozen=True)
class SourceStatus:
    name: str
    source_rank: int
    loaded: bool
    error: str | None
    # Files that were left out, and why.
    rejected: tuple[tuple[str, str], ...] = ()


def text_column(df: DataFrame, name: str | None) -> Column:
    """A source column as non-null text; "" if the source has no such column."""
    return or_empty(F.col(f"`{name}`")) if name in df.columns else F.lit("")


def equals_ignoring_case(c: Column, value: str) -> Column:
    return F.lower(c) == value.lower()


def contains_ignoring_case(c: Column, value: str) -> Column:
    return F.lower(c).contains(value.lower())


def keep_rows(df: DataFrame, spec: SourceSpec) -> DataFrame:
    rules = [equals_ignoring_case(text_column(df, c), v) for c, v in spec.equals.items()]
    rules += [contains_ignoring_case(text_column(df, c), v) for c, v in spec.contains.items()]
    return reduce(DataFrame.filter, rules, df)


def to_triples(df: DataFrame, columns: Mapping[str, str], *keep: str) -> DataFrame:
    """Project to the three text columns, plus ``keep``; all other columns go."""
    return df.select(*keep, *[text_column(df, columns.get(c)).alias(c) for c in TEXT_COLUMNS])


def _open(spark: SparkSession, spec: SourceSpec, broken: Sequence[str] | None = None) -> DataFrame:
    """The rows of a source; with a list of broken files, those of the others."""
    reader = spark.read.format(spec.format).options(**spec.options)
    if broken is None:
        return reader.load(spec.path)
    # Other formats take their schema from all files that can be read.
    reader = reader.option("ignoreCorruptFiles", "true")
    if spec.format in ("parquet", "orc") and (whole := whole_file(spark, spec.path, broken)):
        reader = reader.schema(spark.read.format(spec.format).load(whole).schema)
    read = reader.load(spec.path)
    return read.filter(~F.col("_metadata.file_path").isin(list(broken))) if broken else read


def with_file_position(
    spark: SparkSession, spec: SourceSpec, broken: Sequence[str] | None = None
) -> DataFrame:
    """Read a source with ``file`` and ``row_idx``, which order its rows as they are stored.

    No rows are moved, counted or joined. Parquet knows the row number inside a
    file. Other formats are written once as parquet, so that the numbers cannot
    change when a task is repeated; there a file is a stretch of a file.
    """
    read = _open(spark, spec, broken)
    if spec.format == "parquet":
        return read.select(
            "*",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row_idx"),
        )
    stretch = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
    return stage(
        read.select(
            "*",
            F.concat_ws("#", F.col("_metadata.file_path"), stretch).alias("file"),
            F.monotonically_increasing_id().alias("row_idx"),
        ),
        "positions",
    )


def read_source(
    spark: SparkSession, spec: SourceSpec, source_rank: int, broken: Sequence[str] | None = None
) -> DataFrame:
    if spec.order_col:
        rows = _open(spark, spec, broken).withColumns(
            {"file": F.lit(""), "row_idx": F.col(spec.order_col).cast("bigint")}
        )
    else:
        rows = with_file_position(spark, spec, broken)
    rows = keep_rows(rows, spec)
    triples = to_triples(rows, spec.columns, "file", "row_idx")
    return triples.select(
        F.lit(spec.name).alias("source"),
        F.lit(source_rank).alias("source_rank"),
        "file",
        "row_idx",
        *TEXT_COLUMNS,
    )


def _broken(spark: SparkSession, spec: SourceSpec) -> dict[str, str] | None:
    """Files of a source that cannot be read to their end, and why; at most ``MOST_REJECTED``."""
    if not can_check(spark, spec.path):
        return None
    used = [*spec.columns.values(), *spec.equals, *spec.contains, spec.order_col]
    found = broken_files(spark, spec.path, spec.format, [c for c in used if c])
    rejected = {r.file: r.reason for r in found.limit(MOST_REJECTED + 1).collect()}
    if len(rejected) > MOST_REJECTED:
        raise OSError(f"more than {MOST_REJECTED} files cannot be read")
    return rejected


def load_sources(
    spark: SparkSession, specs: Sequence[SourceSpec], guarded: bool = False
) -> tuple[DataFrame, list[SourceStatus]]:
    """Union all sources that can be opened; warn about the others and go on.

    Row order is (source_rank, file, row_idx). A source fails here when its path or
    schema cannot be resolved; rows are not read yet.

    With ``guarded`` every file is read through first. Those that break on the way are left out
    and named in the status, and the rest of their source is loaded; without, the job that reads
    them fails. A source of which more than ``MOST_REJECTED`` files break is left out whole.
    """
    frames, statuses = [], []
    for source_rank, spec in enumerate(specs):
        try:
            broken = _broken(spark, spec) if guarded else None
            frames.append(read_source(spark, spec, source_rank, None if broken is None else list(broken)))
            rejected = tuple((broken or {}).items())
            for file, reason in rejected:
                logger.warning("source %s: file %s skipped: %s", spec.name, file, reason)
            statuses.append(SourceStatus(spec.name, source_rank, True, None, rejected))
        except (PySparkException, Py4JJavaError, OSError) as error:
            reason = str(error).splitlines()[0]
            logger.warning("source %s skipped: %s", spec.name, reason)
            statuses.append(SourceStatus(spec.name, source_rank, False, reason))
    if not frames:
        raise RuntimeError("none of the instruction sources could be loaded")
    return reduce(DataFrame.unionByName, frames), statuses


def load_report(
    spark: SparkSession, combined: DataFrame, statuses: Sequence[SourceStatus]
) -> DataFrame:
    """One row per configured source: did it load, how many rows it gave, and how many of its
    files were rejected.
    """
    listed = spark.createDataFrame(
        [(s.name, s.source_rank, s.loaded, len(s.rejected)) for s in statuses],
        "source string, source_rank int, loaded boolean, n_rejected bigint",
    )
    counts = combined.groupBy("source_rank").agg(F.count("*").alias("n_rows"))
    return listed.join(counts, "source_rank", "left").select(
        "source", "source_rank", "loaded", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_rejected"
    )


def rejected_files(spark: SparkSession, statuses: Sequence[SourceStatus]) -> DataFrame:
    """One row per file that was left out: its source, its address, and why."""
    rows = [(s.name, s.source_rank, *entry) for s in statuses for entry in s.rejected]
    return spark.createDataFrame(rows, "source string, source_rank int, file string, reason string")
