"""Every registered query against its SQL, or for its rows where SQL cannot express it."""

import pytest

from orbiscope.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, same_rows, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLE_SQL:
        same_rows(df, catalog.ORACLE_SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
