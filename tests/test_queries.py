import pytest

from quillforge.plans import problems, reference
from tests.oracle import agree

ALL = {**reference.QUERIES, **problems.QUERIES}
SQL = {**reference.ORACLE, **problems.ORACLE}


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, small, name):
    agree(spark, small, ALL[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_runs(spark, small, name):
    df = ALL[name](spark, small)
    assert df.columns and df.count() >= 0
