"""Writing an intermediate table once so that later steps read it instead of redoing it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_REMOVED_AT_END: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for intermediate data, which all executors reach.

    A session that names none uses its warehouse, unless that is a folder of the driver's
    machine and executors are elsewhere: they would write what nobody reads.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = f"{spark.conf.get(WAREHOUSE_DIR)}/checkpoints"
        machine_only = folder.startswith(("file:", "/"))
        if machine_only and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} is not set, and {folder} is a folder of one machine")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder.

    All paths of an application are in one folder, which is removed when it ends.
    """
    run = f"{shared_folder(spark)}/codeprep-{spark.sparkContext.applicationId}"
    if run not in _REMOVED_AT_END:
        path = spark._jvm.org.apache.hadoop.fs.Path(run)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        # Only what is there already can be marked for removal.
        store.mkdirs(path)
        store.deleteOnExit(path)
        _REMOVED_AT_END.add(run)
    return f"{run}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and return the written table.

    Unlike cached blocks the table outlives lost executors, and unlike a
    checkpoint it keeps column pruning and filter pushdown for its readers.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    kept = spark.conf.get(SHUFFLE_CLEANUP)
    # The written table replaces the shuffles that led to it; else they stay on disk.
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, kept)
    return spark.read.schema(df.schema).parquet(path)
