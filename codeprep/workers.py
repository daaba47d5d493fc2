"""Lets Python workers import this package where it is not installed, and bounds what they are sent."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def reachable(spark: SparkSession) -> None:
    """Put the folder of this package on the workers' path, for runs from a checkout.

    A cluster whose machines have no such folder gets the package as usual, through
    ``--py-files`` or an installation.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, ROOT])


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run inside send Python workers Arrow batches of about ``size`` bytes.

    Else a batch has up to 64 MB, of which a worker holds one while it reads the next.
    """
    kept = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, kept)
