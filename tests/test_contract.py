"""The driver contract, without the optional subpackage."""

from loomwright import catalog


def test_catalog_is_consistent(spark):
    queries, oracle = catalog.queries(), catalog.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 60
    assert catalog.entry(spark, "/root/testdata/sf0.001").limit(1).count() == 1


def test_entry_module():
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
