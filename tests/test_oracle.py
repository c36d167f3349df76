"""Every query with SQL gives what DuckDB gives; those without run and have rows."""

from __future__ import annotations

import pytest

from hindcast.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(name, spark, small, duck, same):
    same(catalog.QUERIES[name](spark, small).toPandas(), duck.sql(catalog.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(name, spark, small):
    assert catalog.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"season", "n", "log_loss", "brier"}
