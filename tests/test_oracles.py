"""Every registered query of the reference's own operators against its oracle, on sf0.001."""

import pytest
from oracle import assert_same, duck

from textloom.plans import catalog

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, sf, con):
    df = catalog.queries()[name](spark, sf)
    if name in ORACLES:
        assert_same(df, ORACLES[name], con)
    else:
        assert df.count() > 0


def test_flagship_and_names(spark):
    import __spark_entry__

    assert catalog.FLAGSHIP in catalog.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 1
