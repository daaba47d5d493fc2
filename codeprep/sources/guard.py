"""A ledger of files that cannot be read to their end, so that the others can be.

A job that meets such a file fails as a whole. So tasks first read the wanted columns of every
file, batch by batch, and keep only what went wrong; the job then leaves these files out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs, orc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeprep.sources.files import Place, locate
from codeprep.workers import reachable

# Bytes of files that a task reads, and of what it holds of one.
TASK_BYTES = 256 << 20
BLOCK_BYTES = 1 << 20
BATCH_ROWS = 4096

_SUFFIXES = {"gz": "gzip", "gzip": "gzip", "bz2": "bz2", "zst": "zstd", "lz4": "lz4"}
_LEDGER = "file string, reason string"


def _read_through(system: fs.FileSystem, path: str, kind: str, columns: Sequence[str]) -> None:
    """Read a file to its end; an error is the caller's."""
    if kind == "parquet":
        with system.open_input_file(path) as source, pq.ParquetFile(source) as table:
            known = [c for c in columns if c in table.schema_arrow.names]
            for _ in table.iter_batches(BATCH_ROWS, columns=known):
                pass
    elif kind == "orc":
        with system.open_input_file(path) as source:
            table = orc.ORCFile(source)
            for stripe in range(table.nstripes):
                table.read_stripe(stripe, [c for c in columns if c in table.schema.names])
    else:
        codec = _SUFFIXES.get(path.rpartition(".")[2].lower())
        with system.open_input_stream(path, compression=codec, buffer_size=BLOCK_BYTES) as source:
            while source.read(BLOCK_BYTES):
                pass


def _check(store: str, kind: str, columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(store)
        for batch in batches:
            bad = {"file": [], "reason": []}
            for file, path in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist()):
                try:
                    _read_through(system, path, kind, columns)
                except Exception as problem:  # noqa: BLE001 - damaged files raise errors of all kinds
                    bad["file"].append(file)
                    bad["reason"].append(f"{type(problem).__name__}: {problem}".splitlines()[0][:500])
            yield pa.RecordBatch.from_pydict(bad, pa.schema([("file", pa.string()), ("reason", pa.string())]))

    return run


def can_check(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open the files of a source; a store that only Spark reads is not checked."""
    try:
        locate(spark, path).open()
    except Exception:  # noqa: BLE001 - as above
        return False
    return True


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """Address, path and size of the files that Spark reads below ``path``; empty ones are not."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("path"), "length"
    )


def whole_file(spark: SparkSession, path: str, broken: Sequence[str]) -> str | None:
    """A file that is not broken, from which a schema can be taken."""
    found = _listed(spark, path).filter(~F.col("file").isin(list(broken))).agg(F.min("path")).first()
    return found[0]


def broken_files(spark: SparkSession, path: str, kind: str, columns: Sequence[str]) -> DataFrame:
    """``(file, reason)`` of the files below ``path`` that cannot be read to their end.

    Files are those that Spark reads there, named as in ``_metadata.file_path``. They are dealt
    to tasks by their size.
    """
    reachable(spark)
    place: Place = locate(spark, path)
    base = place.open()[1][: -len(place.path) or None]
    listed = _listed(spark, path)
    total = listed.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(-(-total // TASK_BYTES), 10_000))
    # The path as the store knows it: without the address before it.
    inside = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/", "")
    named = listed.select("file", F.concat(F.lit(base), inside).alias("path"))
    return named.repartition(tasks, "file").mapInArrow(_check(place.store, kind, tuple(columns)), _LEDGER)
