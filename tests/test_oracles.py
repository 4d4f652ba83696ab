"""Every registered query equals its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.compare import rows_of
from zonepulse.plans.catalog import QUERIES as CORE

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def test_every_core_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert set(CORE) <= set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "hit_rate" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
