import pytest

from inkstrata.plans.registry import ORACLE_SQL, QUERIES
from tests.compare import same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name])
