"""Every registered query with an oracle equals its DuckDB formulation (smallest test scale)."""
import pytest

import __spark_entry__ as E
from tests._compare import compare, duck
from tests._paths import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    no_cartesian_product(df)
    compare(df, con, ORACLE[name])


def no_cartesian_product(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_runs_or_has_oracle(spark):
    q = E.queries()
    assert set(ORACLE) <= set(q)
    for name in sorted(set(q) - set(ORACLE)):
        df = q[name](spark, SF_SMALL)
        no_cartesian_product(df)
        assert df.count() >= 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "distancia_km" in df.columns
