"""Every registered query against its SQL on the given tables."""

import pytest
from compare import SF_DIR, database, differences

import __spark_entry__ as entry
from tickloom.plans import registry

registry.load()
SQL = registry.SQL


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["instrument_id", "sequence", "day", "price", "size", "symbol"]
    assert df.count() > 0


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())


def test_export_is_verified(spark):
    status = entry.queries()["export_and_verify"](spark, SF_DIR)
    assert {r["status"] for r in status.collect()} == {"ok"}
