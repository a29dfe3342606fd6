"""Every registered query against its SQL; those without SQL must give rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SMALL, executed_plan

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    assert differences(df, duck, SQL[name]) is None
    plan = executed_plan(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 10
