import pytest

from quillforge.llm import queries
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, small, name):
    if name in queries.ORACLE:
        agree(spark, small, queries.QUERIES[name], queries.ORACLE[name])
    else:
        assert queries.QUERIES[name](spark, small).count() > 0
