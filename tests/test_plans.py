"""Plan shapes that must hold for every registered query."""

import pytest

import __spark_entry__ as entry
from barloom.catalog.queries import QUERIES
from barloom.operators import silver
from helpers import at, plan, raw_rows

#: Queries that run a job while they are built (they write and read a table first).
EAGER = {"pipeline_leaderboard", "refresh_incremental", "refresh_incremental_board", "stream_gold_frozen", "item_statistics_rollup",
         "items_page", "items_page_curated", "items_page_index", "append_new_bucketed", "backtest_runs",
         "stream_silver", "stream_gold", "stream_daily_bars", "stream_first_arrivals", "upsert_table",
         "load_items", "load_selection", "results_csv", "append_new_table", "incremental_silver", "upsert_by_key",
         "incremental_gold", "incremental_gold_reference"}
LAZY = sorted(set(QUERIES) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_product_and_no_row_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "Scan ExistingRDD"):
        if node == "FlatMapGroupsInPandas" and name == "backtest_ets_expanding":
            continue  # one pass over an item's days fits all its origins
        assert node not in text


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(silver.silver_timeseries(raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1))])))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning(ts") < text.index("Partial")


def test_unused_columns_are_not_read(spark, sf_dir):
    text = plan(entry.queries()["daily_latest"](spark, sf_dir))
    assert "p_name" not in text and text.count("FileScan parquet") == 1
    narrow = plan(entry.queries()["auto_discover"](spark, sf_dir))
    assert "p_retailprice" not in narrow.split("ReadSchema")[1]


def test_time_filter_reaches_the_scan(spark, sf_dir):
    text = plan(entry.queries()["item_statistics"](spark, sf_dir))
    scan = text[text.index("FileScan parquet"):]
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00" in scan
