"""Directories of code files and the prompts over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeprep.functions import prompts
from codeprep.functions.text import is_blank, truncate_code
from codeprep.staging import stage
from codeprep.workers import reachable

_ENTRIES = "path string, source_path string, is_folder boolean, size bigint, error string"
_FILES = "source_path string, source_name string, code string, error string"

# Bytes of files that a task opens together, and files per task.
GROUP_BYTES = 64 << 20
GROUP_FILES = 1000

# Names of file systems that Arrow calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


@dataclass(frozen=True)
class Place:
    """A file or folder: the address of its file system, and its path there as it is.

    Only the address is ever parsed. Names may hold spaces, ``#``, ``?``, ``%`` or anything
    else that an address would give a meaning.
    """

    store: str
    path: str

    def open(self) -> tuple[fs.FileSystem, str]:
        """The file system, and the path that it knows this place by."""
        system, base = fs.FileSystem.from_uri(self.store)
        return system, f"{base.rstrip('/')}/{self.path}" if base else self.path


def locate(spark: SparkSession, path: str) -> Place:
    """Where a path leads: one without a file system is on Spark's default one, and a relative
    one in the working folder there.
    """
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()
    scheme, _, rest = whole.partition(":")
    authority = ""
    if rest.startswith("//"):
        authority, _, rest = rest[2:].partition("/")
    store = f"{_SCHEMES.get(scheme, scheme)}://{authority}/"
    return Place(store, rest.strip("/"))


def _why(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}".splitlines()[0]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), types[kind]) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _list_folders(store: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Children of every folder, or one entry that tells why it could not be listed."""
        system, _ = fs.FileSystem.from_uri(store)
        for batch in batches:
            for path, relative in zip(batch.column("path").to_pylist(), batch.column("source_path").to_pylist()):
                prefix = f"{relative}/" if relative else ""
                try:
                    rows = [
                        (i.path, prefix + i.base_name, i.type == fs.FileType.Directory, i.size or 0, None)
                        for i in system.get_file_info(fs.FileSelector(path))
                    ]
                except (OSError, ValueError) as problem:
                    rows = [(path, relative, False, 0, _why(problem))]
                yield _batch(rows, _ENTRIES)

    return run


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, source_path, size, error)`` of all files below a folder, or of one file.

    Whatever their names, at any depth. Folders are listed by tasks, one level after the
    other; file names never come to the driver. A folder that cannot be listed is an entry
    with the reason. A missing path is an error.
    """
    reachable(spark)
    place = locate(spark, path)
    system, whole = place.open()
    root = system.get_file_info(whole)
    if root.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no such file or folder: {path}")
    if root.type == fs.FileType.File:
        return spark.createDataFrame([(whole, root.base_name, False, root.size, None)], _ENTRIES).drop("is_folder")
    level = spark.createDataFrame([(whole, "", True, 0, None)], _ENTRIES)
    found = None
    while True:
        children = stage(
            level.select("path", "source_path").repartition("path").mapInArrow(_list_folders(place.store), _ENTRIES),
            "listing",
        )
        files = children.filter(~F.col("is_folder")).drop("is_folder")
        found = files if found is None else found.unionByName(files)
        level = children.filter("is_folder")
        if level.isEmpty():
            return found


def _read_files(store: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Text of every file, or why it could not be read."""
        system, _ = fs.FileSystem.from_uri(store)
        for batch in batches:
            for path, relative, error in zip(*[batch.column(c).to_pylist() for c in ("path", "source_path", "error")]):
                code = None
                try:
                    if error is None:
                        with system.open_input_stream(path) as source:
                            code = source.read().decode("utf-8")
                except (OSError, ValueError) as problem:
                    error = _why(problem)
                yield _batch([(relative, relative.rpartition("/")[2], code, error)], _FILES)

    return run


def scan_code_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: relative path, base name, text, and an error if it could not be read.

    As in text mode every line end is a line feed. Files are dealt to tasks in groups of about
    ``GROUP_BYTES`` bytes and ``GROUP_FILES`` files. A folder that cannot be listed is a row
    with an error, too.
    """
    listed = list_files(spark, path)
    total = listed.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    groups = max(1, -(-total.n // GROUP_FILES), -(-(total.size or 0) // GROUP_BYTES))
    texts = listed.repartition(groups, "path").mapInArrow(_read_files(locate(spark, path).store), _FILES)
    return texts.withColumn("code", F.regexp_replace("code", "\r\n?", "\n"))


def split_blank(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with code, and the rejected ones: only whitespace, or not read."""
    has_code = F.coalesce(~is_blank(F.col("code")), F.lit(False))
    return files.filter(has_code), files.filter(~has_code)


def code_prompts(files: DataFrame, name: str = "source_name") -> DataFrame:
    """Explain, review and fix prompts per file, over code cut to the prompt limit."""
    code = F.col("code")
    cut = files.withColumn("code", truncate_code(code))
    return cut.select(
        name,
        prompts.explain_prompt(code).alias("explain"),
        prompts.review_prompt(code).alias("review"),
        prompts.fix_prompt(code).alias("fix"),
    )
