import datetime as dt

from barloom.operators import bronze, gold, silver
from helpers import at, plan, raw_rows, rows

D = dt.date


def test_bronze_drops_rows_without_key(spark):
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, 7, at(1)), (None, 1, 1, 1, 1, 7, at(1)), (at(1), 1, 1, 1, 1, None, at(1))])
    assert bronze.bronze_timeseries(raw).count() == 1


def test_silver_keeps_the_newest_load(spark):
    raw = raw_rows(spark, [
        (at(1), 100, 90, 1, None, 7, at(2)),
        (at(1), 107, 90, 1, None, 7, at(3)),
        (at(1), 103, 90, 1, None, 7, at(1)),
    ])
    assert rows(silver.silver_timeseries(raw), "price_high", "volume", "load_ts") == [(107, 1, at(3))]


def test_silver_ties_are_deterministic(spark):
    raw = raw_rows(spark, [(at(1), p, 90, 1, 1, 7, at(2)) for p in (5, 9, 7)])
    assert rows(silver.silver_timeseries(raw.repartition(3)), "price_high") == [(9,)]


def test_silver_items_labels(spark):
    items = spark.createDataFrame(
        [(1, "Rune bar", True, 10, 30), (2, "Lobster", None, 10, 0), (3, "Bar", False, None, 5)],
        "id long, name string, members boolean, lowalch long, highalch long")
    items = items.selectExpr("*", "'x' AS examine", "1L AS `limit`")
    got = rows(silver.silver_items(items).orderBy("item_id"), "membership_type", "alch_profit_potential", "item_category")
    assert got == [("Members", 20, "Runes"), ("Free-to-Play", None, "Other"), ("Free-to-Play", None, "Bars")]


def test_ten_hourly_rows_become_one_bar(spark):
    raw = raw_rows(spark, [(at(1, h), 100 + h, 90 + h, 1, None, 1001, at(2)) for h in range(10)])
    bar = silver.daily_bars(raw).collect()
    assert len(bar) == 1
    b = bar[0]
    assert (b.high_price, b.low_price, b.open_price, b.close_price, b.total_volume, b.data_points) == (109, 90, 100, 109, 10, 10)
    assert (b.first_timestamp, b.last_timestamp) == (at(1), at(1, 9))


def test_open_and_close_use_rows_without_a_low(spark):
    raw = raw_rows(spark, [
        (at(1, 1), 100, None, 5, 5, 1, at(2)),
        (at(1, 2), 200, 150, 1, 1, 1, at(2)),
        (at(1, 3), None, 150, 5, 5, 1, at(2)),
        (at(1, 4), 300, None, 5, 5, 1, at(2)),
        (at(2, 1), 400, None, 5, 5, 1, at(2)),  # no paired row that day: no bar
    ])
    got = rows(silver.daily_bars(raw), "price_date", "open_price", "close_price", "high_price", "total_volume", "data_points")
    assert got == [(D(2024, 1, 1), 100, 300, 200, 2, 1)]


def test_daily_bar_is_a_hash_aggregate(spark):
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1))])
    text = plan(silver.daily_bars(raw))
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_indicators(spark):
    raw = raw_rows(spark, [(at(d), p, 1, 1, 1, 1, at(9)) for d, p in ((1, 10), (2, 20), (5, 60))])
    got = rows(silver.silver_prices_daily(raw).orderBy("price_date"), "price_change", "ma_7d", "volatility_7d")
    assert got[0] == (None, 10.0, None)
    assert got[1][:2] == (10, 15.0) and abs(got[1][2] - 7.0710678) < 1e-6
    assert got[2][:2] == (40, 30.0)


def test_last_observation_keeps_its_null(spark):
    raw = raw_rows(spark, [(at(1, 1), 100, 90, 1, 1, 1, at(2)), (at(1, 2), None, 80, 1, 1, 1, at(2))])
    assert rows(gold.daily_latest(silver.silver_timeseries(raw)), "latest_price_high", "latest_price_low") == [(None, 80)]


def test_return_after_a_zero_price_is_null(spark):
    raw = raw_rows(spark, [(at(1), 0, 0, 1, 1, 1, at(9)), (at(2), 10, 10, 1, 1, 1, at(9)), (at(3), 20, 20, 1, 1, 1, at(9))])
    got = rows(gold.gold_daily_features(silver.silver_timeseries(raw)).orderBy("date"), "latest_price", "daily_return", "volatility_proxy", "is_outlier")
    assert got == [(0.0, None, None, False), (10.0, None, 0.0, False), (20.0, 1.0, 0.0, False)]


def test_outliers_by_spread_and_by_zscore(spark):
    wide = [(at(1), 300, 100, 1, 1, 1, at(40))]
    calm = [(at(d), 100 + d % 2, 100 + d % 2, 1, 1, 2, at(40)) for d in range(1, 30)] + [(at(30), 200, 200, 1, 1, 2, at(40))]
    out = gold.gold_daily_features(silver.silver_timeseries(raw_rows(spark, wide + calm))).where("is_outlier")
    assert sorted(rows(out, "item_id", "date")) == [(1, D(2024, 1, 1)), (2, D(2024, 1, 30))]


def test_gold_windows_share_one_shuffle(spark):
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1))])
    # one for the keys, one for item-days, one for items
    assert plan(gold.gold_daily_features(silver.silver_timeseries(raw))).count("Exchange") == 3
    assert plan(gold.gold_price_features(silver.silver_prices_daily(raw))).count("Exchange") == 2


def test_item_metrics_quality_bands(spark):
    raw = raw_rows(spark, [
        (at(d), 100 + d, 90, 200, 0, item, at(40)) for item, days in ((1, 25), (2, 12), (3, 4)) for d in range(1, days + 1)])
    items = spark.createDataFrame([(i, f"n{i}", "Other", "Members") for i in (1, 2, 3)],
                                  "item_id long, name string, item_category string, membership_type string")
    out = gold.gold_item_metrics(silver.daily_bars(raw), items, "2024-01-31").orderBy("item_id")
    got = rows(out, "data_quality", "suitable_for_forecasting", "trading_days_30d", "latest_price")
    assert got == [("High", True, 25, 125), ("Medium", False, 12, 112), ("Low", False, 4, 104)]
    change = rows(out, "price_change_pct_30d")[0][0]
    assert abs(change - (125 - 101) / 101 * 100) < 1e-9


def test_item_metrics_period_is_inclusive(spark):
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(40)), (at(2), 1, 1, 1, 1, 1, at(40))])
    items = spark.createDataFrame([(1, "n", "c", "m")], "item_id long, name string, item_category string, membership_type string")
    days = rows(gold.gold_item_metrics(silver.daily_bars(raw), items, "2024-02-01"), "trading_days_30d")
    assert days == [(1,)]  # 2024-01-02 is exactly 30 days before


def test_price_features_keep_rows_with_both_neighbours(spark):
    raw = raw_rows(spark, [(at(d), 100 * d, 1, 10 * d, 0, 1, at(40)) for d in range(1, 10)])
    out = gold.gold_price_features(silver.silver_prices_daily(raw)).orderBy("price_date")
    got = rows(out, "price_date", "close_price", "price_lag_1d", "target_price_1d", "price_lag_7d", "price_volume_interaction")
    assert len(got) == 7 and got[0] == (D(2024, 1, 2), 200, 100, 300, None, 1000.0)
    assert got[-1][4] == 100


def test_interaction_does_not_overflow(spark):
    big = 4_000_000_000
    raw = raw_rows(spark, [(at(d), big, 1, big, 0, 1, at(40)) for d in range(1, 4)])
    assert rows(gold.gold_price_features(silver.silver_prices_daily(raw)), "price_volume_interaction") == [(float(big) * big,)]


def test_series_falls_back_per_item(spark):
    feats = spark.createDataFrame([(1, D(2024, 1, 1), 5.0), (1, D(2024, 1, 2), None)], "item_id long, date date, latest_price double")
    bars = spark.createDataFrame([(1, D(2024, 1, 1), 9), (2, D(2024, 1, 1), 7)], "item_id long, price_date date, close_price long")
    got = sorted(rows(gold.price_series(feats, bars)), key=str)
    assert got == [(1, D(2024, 1, 1), 5.0), (1, D(2024, 1, 2), None), (2, D(2024, 1, 1), 7.0)]


def test_item_predicate_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS item_id", "date'2024-01-01' AS price_date", "id AS close_price", "id AS extra").write.parquet(str(tmp_path / "t"))
    df = gold.scan_item_series(spark.read.parquet(str(tmp_path / "t")), "close_price", item_ids=[5])
    text = plan(df)
    assert "EqualTo(item_id,5)" in text or "In(item_id, [5])" in text
    assert "extra" not in text
    assert df.count() == 1


def test_a_price_on_the_threshold_is_neutral(spark):
    prices = [308, 308, 308, 308, 308, 309, 301, 301]  # on day 7, 301 is 98 % of the mean of seven, 2150 / 7
    raw = raw_rows(spark, [(at(d), p, 1, 1, 0, 1, at(40)) for d, p in enumerate(prices, 1)])
    out = gold.gold_price_features(silver.silver_prices_daily(raw)).where("price_date = '2024-01-07'")
    assert rows(out, "close_price", "trend_signal") == [(301, "Neutral")]
