"""Every query with SQL against DuckDB on the small tables, and none of them vacuous."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from doclattice.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(rows):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = con.execute(ORACLE_SQL[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == sorted(df.columns)
    want = norm([tuple(r[names.index(c)] for c in sorted(names)) for r in got.fetchall()])
    have = norm(map(tuple, df.select(*sorted(names)).collect()))
    assert have == want and have


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
