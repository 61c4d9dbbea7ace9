import pytest

from pairloom.plans import catalog
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    assert df.columns and df.count() >= 0
