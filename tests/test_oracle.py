"""Every registered query against its DuckDB oracle on sf0.001."""

import os

import pytest

import __spark_entry__ as ent
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(ent.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = ent.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(rows, df.columns) == canon(orows, ocols)


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0 and "pearson_correlation" in df.columns
