"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from gatewatch.plans.context import Ctx
from tools.check_oracles import digest, duck

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con(spark):
    Ctx(spark, SF_SMALL).hand_over()  # the score queries read the data job's table
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows and len(set(df.columns)) == len(df.columns)
        return
    rel = con.sql(sql)
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "bl_key" in df.columns
