"""Driver contract + DuckDB oracle for every registered query with SQL (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from agrolens.plans.catalog import ORACLE
from agrolens.plans.oracle_check import TABLES, table_hash
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["county", "total_subsidy", "average_subsidy", "equipment_count"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert table_hash(sdf.columns, srows)[0] == table_hash(dcols, drows)[0]
