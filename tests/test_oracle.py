"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

from barloom.catalog.queries import QUERIES as REFERENCE  # noqa: E402

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    ok, note = compare(QUERIES[name](spark, sf_dir), SQL[name], con)
    assert ok, note


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_only_growing_windows_of_the_fitted_forecaster_have_no_sql():
    assert {n for n in set(QUERIES) - set(SQL) if n in REFERENCE} == {"backtest_ets_expanding"}


def test_entry_has_outliers(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "date", "daily_return", "volatility_proxy", "return_zscore"]
    assert df.count() > 0
