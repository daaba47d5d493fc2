"""Session for tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("codeprep")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(Path.cwd() / "spark-warehouse/checkpoints"))
        # Arrays of this many texts are collected in memory before a task sorts instead.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "2048")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
