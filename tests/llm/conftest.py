import duckdb
import pytest

from codeprep.workers import reachable

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    reachable(spark)


@pytest.fixture
def duck():
    """Rows of a query over the given tables, each a list of column names and rows."""

    def run(sql, **tables):
        db = duckdb.connect()
        for name, (columns, rows) in tables.items():
            db.execute(f"CREATE TABLE {name} ({columns})")
            if rows:
                db.executemany(
                    f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows
                )
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        return [dict(zip(names, row)) for row in result.fetchall()]

    return run


@pytest.fixture
def rows_of():
    """Rows of a DataFrame as dicts, sorted."""

    def run(df):
        return sorted((r.asDict() for r in df.collect()), key=lambda r: repr(sorted(r.items())))

    return run
