import pytest

from quern.plans import packing_queries, queries, registry, scoring_queries  # noqa: F401
from tests.oracle import database, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, con, name):
    what = difference(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name])
    assert not what or what.startswith("kinds only")


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_gives_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
