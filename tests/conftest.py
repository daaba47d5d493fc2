import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("codeprep-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of a column function over a list of strings, in order."""
    from pyspark.sql import functions as F

    def run(function, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
        got = rows.select("i", function(F.col("s")).alias("r")).orderBy("i").collect()
        return [r.r for r in got]

    return run
