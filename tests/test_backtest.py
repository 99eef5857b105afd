import datetime as dt

import numpy as np
import pytest

from barloom.operators import backtest, metrics
from helpers import daily, plan, rows


def walk(n=30, seed=0):
    return list(100 + np.cumsum(np.random.default_rng(seed).normal(0, 2, n)))


def reference_smape(y, p):
    y, p = np.asarray(y, float), np.asarray(p, float)
    d = (np.abs(y) + np.abs(p)) / 2
    return float(np.mean(np.abs(y - p) / np.where(d == 0, 1e-8, d)) * 100)


def test_split_invariants(spark):
    out = backtest.expanding_splits(daily(spark, walk()), min_train=10, test_size=1, max_splits=5).orderBy("split").collect()
    assert [r.split for r in out] == [1, 2, 3, 4, 5]
    assert all(r.train_end < r.date for r in out)
    assert [r.train_size for r in out] == [10, 11, 12, 13, 14]
    assert all(r.train_start == dt.date(2024, 1, 1) for r in out)


def test_rolling_window_moves(spark):
    out = backtest.rolling_splits(daily(spark, walk(12)), window=4, horizon=2, max_splits=3).orderBy("split").collect()
    assert [(r.train_start.day, r.train_end.day, r.date.day, r.test_end.day) for r in out] == [(1, 4, 5, 6), (2, 5, 6, 7), (3, 6, 7, 8)]


def test_latest_splits(spark):
    out = backtest.rolling_splits(daily(spark, walk(12)), window=4, horizon=2, max_splits=3, keep="latest").orderBy("split").collect()
    assert [(r.split, r.date.day) for r in out] == [(1, 9), (2, 10), (3, 11)]
    few = backtest.rolling_splits(daily(spark, walk(6)), window=4, horizon=1, max_splits=9, keep="latest").orderBy("split").collect()
    assert [(r.split, r.date.day) for r in few] == [(1, 5), (2, 6)]


def test_too_short_and_unknown_items(spark):
    assert backtest.rolling_splits(daily(spark, walk(5)), window=10).count() == 0
    assert backtest.rolling_splits(daily(spark, walk(10)), window=10).count() == 0
    assert backtest.rolling_splits(daily(spark, walk(11)), window=10).count() == 1
    assert backtest.rolling_splits(daily(spark, walk()).where("item_id = 9999"), window=5).count() == 0


@pytest.mark.parametrize("horizon", [1, 3])
@pytest.mark.parametrize("expanding", [False, True])
def test_scores_match_a_loop(spark, horizon, expanding):
    y, train, most = walk(25, 3), 10, 6
    got = {(r.split, r.method): r for r in backtest.scored_splits(
        daily(spark, y), ("last_value", "moving_average"), train, horizon, most, expanding).collect()}
    assert len(got) == 2 * most
    for k in range(most):
        i = train + k
        past, actual = y[0 if expanding else i - train:i], y[i:i + horizon]
        for method, value in (("last_value", past[-1]), ("moving_average", np.mean(past[-7:]))):
            r = got[k + 1, method]
            assert np.isclose(r.mae, np.mean(np.abs(np.array(actual) - value)))
            assert np.isclose(r.smape, reference_smape(actual, [value] * horizon))
            assert np.allclose(r.predictions, [value] * horizon) and np.allclose(r.actuals, actual)


def test_short_window_limits_the_average(spark):
    r = backtest.backtest_scores(daily(spark, [1, 2, 3, 10]), ("moving_average",), window=3).first()
    assert r.predicted == 2.0


def test_missing_prices(spark):
    y = [1, 2, 3, None, 5, 6, 7]
    got = {(r.date.day, r.method): r.predicted for r in backtest.backtest_scores(
        daily(spark, y), ("last_value", "moving_average"), window=3).collect()}
    # day 4 has no actual; on day 5 the last value is missing but the mean skips it
    assert got == {(5, "moving_average"): 2.5, (6, "last_value"): 5.0, (6, "moving_average"): 4.0,
                   (7, "last_value"): 6.0, (7, "moving_average"): 5.5}


def test_ets_scores(spark):
    y = [float(3 * i) for i in range(15)]
    out = backtest.backtest_scores(daily(spark, y), ("ets",), window=12).collect()
    assert len(out) == 3 and all(abs(r.mae) < 1e-6 for r in out)
    assert backtest.backtest_scores(daily(spark, y), ("ets",), window=8).count() == 0
    gap = y[:5] + [None] + y[6:]
    assert backtest.backtest_scores(daily(spark, gap), ("ets",), window=12).count() == 0


def test_ets_expanding_uses_all_history(spark):
    y = [float(2 * i + 1) for i in range(18)]
    out = backtest.scored_splits(daily(spark, y), ("ets",), 12, 2, 5, expanding=True).collect()
    assert len(out) == 5 and all(r.mae < 1e-6 and len(r.predictions) == 2 for r in out)


def test_ets_is_not_worse_than_last_value_on_a_trend(spark):
    rng = np.random.default_rng(2)
    y = list(10 + 2.0 * np.arange(45) + rng.normal(0, 0.5, 45))
    summary = {r.method: r.mean_mae for r in metrics.method_summary(backtest.backtest_scores(daily(spark, y))).collect()}
    assert summary["ets"] < summary["last_value"] and summary["ets"] < summary["moving_average"]


def test_all_methods_share_one_shuffle(spark):
    flat = plan(backtest.backtest_scores(daily(spark, walk()), ("last_value", "moving_average"), window=10))
    assert flat.count("Exchange hashpartitioning") == 1
    fitted = plan(backtest.backtest_scores(daily(spark, walk()), window=10))
    assert fitted.count("Exchange hashpartitioning") == 2 and fitted.count("Sort [") == flat.count("Sort [")


def test_item_result(spark):
    y = [1, 2, None, 4, 6, 9]
    r = backtest.backtest_item_result(daily(spark, y), ("last_value",), min_train=2, max_splits=10, with_predictions=True).first()
    # origins on days 3..6: day 3 has no actual, day 4 no last value
    assert (r.n_splits, r.n_predictions, r.mae, r.mae_std) == (4, 2, 2.5, 0.5)
    assert r.predictions == [4.0, 6.0] and r.actuals == [6.0, 9.0]


def test_suite_counts_failed_items(spark):
    series = daily(spark, walk(20), 1).unionByName(daily(spark, walk(5), 2))
    items = spark.createDataFrame([(1,), (2,), (3,), (4,)], "item_id long")
    out = {r.method: r.success_rate for r in backtest.benchmark_suite(series, items, ("last_value", "moving_average")).collect()}
    assert out == {"last_value": 0.25, "moving_average": 0.25}


def test_metrics_on_triples(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, None), (300.0, 310.0)], "y double, p double")
    r = df.agg(metrics.mae("y", "p").alias("a"), metrics.smape("y", "p").alias("s")).first()
    assert r.a == 10.0 and np.isclose(r.s, reference_smape([100, 300], [110, 310]))
    same = df.agg(metrics.smape("y", "y").alias("s")).first()
    assert same.s == 0.0
    zero = spark.createDataFrame([(0.0, 0.0), (1.0, -1.0)], "y double, p double").agg(metrics.smape("y", "p").alias("s")).first()
    assert zero.s == 100.0


def test_run_summary_uses_population_deviation(spark):
    rows_ = [(1, "m", 1.0, 10.0), (1, "m", 3.0, 30.0), (1, "m", float("nan"), float("nan"))]
    r = metrics.run_summary(spark.createDataFrame(rows_, "item_id long, method string, mae double, smape double")).first()
    assert (r.n_forecasts, r.mean_mae, r.median_mae, r.std_mae, r.std_smape) == (3, 2.0, 2.0, 1.0, 10.0)


def test_unknown_arguments(spark):
    with pytest.raises(ValueError):
        backtest.splits(daily(spark, walk()), methods=("oracle",))
    with pytest.raises(ValueError):
        backtest.splits(daily(spark, walk()), keep="some")
