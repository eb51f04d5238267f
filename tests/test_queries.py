"""Every query with SQL against that SQL in an independent engine, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from clipstrata.session import clear, new_folder
from tests.conftest import DATA
from tools.compare import norm

SQL = entry.oracle_sql()


@pytest.fixture(scope="session")
def db():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    clear(spark)
    cur = db.execute(SQL[name])
    have = [d[0] for d in cur.description]
    assert cols == sorted(have)
    assert got == sorted((tuple(norm(r[have.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_stored_copies_are_deleted(spark):
    clear(spark)
    path = new_folder(spark, "x")
    spark.range(3).write.parquet(path)
    assert clear(spark) == 1 and clear(spark) == 0 and not Path(path.removeprefix("file://")).exists()
