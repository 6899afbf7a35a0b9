import pytest

from tessera.plans.catalog import CATALOG


@pytest.mark.parametrize("name", CATALOG)
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, compare, name, sf):
    assert compare(spark, *CATALOG[name], f"/root/testdata/sf{sf}")


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 171
    assert set(CATALOG) <= set(e.queries()) and set(CATALOG) <= set(e.oracle_sql())
