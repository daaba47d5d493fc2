"""Every registered query against its SQL, and the whole jobs."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from codeprep.plans.dataset import DatasetConfig, build_dataset
from codeprep.plans.oracles import ORACLES
from codeprep.plans.queries import QUERIES, source_specs
from codeprep.sources.instructions import SourceSpec
from codeprep.staging import shared_folder

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLES[name])
    expected = in_name_order([d[0] for d in result.description], result.fetchall())
    assert in_name_order(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_known_counts(spark):
    queries = contract.queries()
    funnel = queries["funnel_counts"](spark, MEDIUM)
    totals = funnel.agg(F.sum("n_raw"), F.sum("n_quality"), F.sum("n_dedup")).first()
    assert tuple(totals) == (1000, 388, 362)
    sizes = {r.split: r.n_rows for r in queries["split_sizes"](spark, MEDIUM).collect()}
    assert sizes == {"eval": 8, "train": 354}


def test_build_dataset(spark, tmp_path):
    documents = f"{SMALL}/documents.parquet"
    specs = [
        *source_specs(SMALL),
        SourceSpec("files", documents, columns={"instruction": "text", "output": "text"}),
    ]
    statuses = build_dataset(spark, specs, str(tmp_path / "all"))
    assert [s.loaded for s in statuses] == [True, True, False, True, True, True]
    assert statuses[2].error and statuses[2].n_raw == 0
    rows = spark.read.parquet(str(tmp_path / "all"))
    assert set(rows.columns) >= {"input_ids", "attention_mask", "labels", "split"}
    n = rows.count()
    assert n > 0 and rows.filter("split = 'eval'").count() == -(-n // 50)
    # Counted by the jobs that wrote the rows.
    assert sum(s.n_train + s.n_eval for s in statuses) == n
    for s in statuses:
        assert s.n_raw >= s.n_quality >= s.n_dedup == s.n_sampled == s.n_train + s.n_eval
        own = rows.filter(F.col("source_rank") == s.source_rank)
        assert own.filter("split = 'train'").count() == s.n_train
    assert sum(s.n_quality for s in statuses) > n
    assert rows.filter(F.size("input_ids") > 4096).count() == 0
    config = DatasetConfig(max_samples=10, max_vocab=50, max_tokens=64)
    counted = build_dataset(spark, specs, str(tmp_path / "few"), config)
    assert sum(s.n_sampled for s in counted) == 10 == sum(s.n_train + s.n_eval for s in counted)
    assert [s.n_dedup for s in counted] == [s.n_dedup for s in statuses]
    few = spark.read.parquet(str(tmp_path / "few"))
    assert few.count() == 10
    assert few.agg(F.max(F.array_max("input_ids"))).first()[0] <= 52


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_session_without_the_setting_uses_its_warehouse():
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": "hdfs:///warehouse"})

        class sparkContext:
            master = "spark://host:7077"

    assert shared_folder(Session()) == "hdfs:///warehouse/checkpoints"
    assert Session.conf["spark.checkpoint.dir"] == "hdfs:///warehouse/checkpoints"
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_folder(Session()) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local[4]", "spark://host:7077", "yarn"])
def test_a_folder_of_one_machine_is_refused_on_a_cluster(master):
    class Conf(dict):
        set = dict.__setitem__

    for folder in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        session = type("Session", (), {"conf": Conf({"spark.sql.warehouse.dir": folder}), "sparkContext": type("C", (), {"master": master})})
        if master.startswith("local"):
            assert shared_folder(session()) == f"{folder}/checkpoints"
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                shared_folder(session())
