"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest scale factor to keep the suite quick."""

import pytest

import __spark_entry__ as E
from metricfold.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = [n for n in catalog.queries() if n not in E.oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "mtype", "delta", "value"]
    assert df.count() > 0


def test_lookup_broadcast_decided_from_measured_size(spark):
    # No broadcast from plan estimates; after the state side's shuffle stage
    # ran, AQE sees its real size (tiny) and switches to a broadcast join.
    df = E.queries()["lookup_many"](spark, SF_SMALL)
    before = df._jdf.queryExecution().executedPlan().toString()
    # The only planned broadcasts are the two of the hot keys, 64 rows at most.
    assert "SortMergeJoin" in before and before.count("BroadcastHashJoin") == 2
    df.collect()
    after = df._jdf.queryExecution().executedPlan().toString()
    final = after.split("+- == Initial Plan ==")[0]
    # Without hot keys their joins are gone; the state side was measured.
    assert "isFinalPlan=true" in after and final.count("BroadcastHashJoin") == 1
