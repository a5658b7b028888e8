"""Every registered query against its SQL counterpart on an independent engine."""

import pytest
from compare import SF_SMALL, differences, oracle_connection

from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, plan_of, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = plan_of(df)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert differences(df, con, ORACLE[name]) == []


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert {"customer_segment", "churn_risk_level", "rfm_score"} <= set(df.columns)
