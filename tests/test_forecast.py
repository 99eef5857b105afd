"""The fitted smoother against brute force, closed forms and the SQL form."""

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest

from barloom.functions import forecast as fc
from barloom.operators import backtest
from helpers import daily, rows


def simulate(y, alpha, beta, l0, b0):
    level, slope, sse = l0, b0, 0.0
    for v in y:
        e = v - level - slope
        sse += e * e
        level, slope = level + slope + alpha * e, slope + alpha * beta * e
    return sse, level, slope


def brute_force(y, trend=True):
    """Fine parameter grid, start state by least squares on simulated responses."""
    best = (np.inf, None)
    grid = np.linspace(0, 1, 41)
    for alpha, beta in itertools.product(grid, grid if trend else [0.0]):
        if beta > alpha:
            continue

        def errors(l0, b0):
            out, level, slope = [], l0, b0
            for v in y:
                e = v - level - slope
                out.append(e)
                level, slope = level + slope + alpha * e, slope + alpha * beta * e
            return np.array(out)

        base = errors(0.0, 0.0)
        cols = [errors(1.0, 0.0) - base] + ([errors(0.0, 1.0) - base] if trend else [])
        x, *_ = np.linalg.lstsq(np.stack(cols, 1), -base, rcond=None)
        sse, level, slope = simulate(y, alpha, beta, x[0], x[1] if trend else 0.0)
        if sse < best[0]:
            best = (sse, level + slope)
    return best


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("trend", [True, False])
def test_not_worse_than_brute_force(seed, trend):
    rng = np.random.default_rng(seed)
    y = 100 + np.cumsum(rng.normal(0, 2, 28))
    forecast, sse = fc.fit_windows(y[None, :], 1, trend)
    expect, _ = brute_force(y, trend)
    assert sse[0] <= expect * (1 + 1e-6)


def test_linear_series_continues():
    y = 5.0 + 3.0 * np.arange(20)
    forecast, sse = fc.fit_windows(y[None, :], 4)
    assert np.allclose(forecast[0], 5 + 3 * np.arange(20, 24)) and sse[0] < 1e-12


def test_flat_series_stays():
    forecast, sse = fc.fit_windows(np.full((2, 12), 7.0), 2)
    assert np.allclose(forecast, 7.0) and np.allclose(sse, 0.0)


def test_equivariant_to_scale_and_shift():
    y = np.random.default_rng(5).normal(0, 1, (3, 15)).cumsum(axis=1)
    a, _ = fc.fit_windows(y, 2)
    b, _ = fc.fit_windows(1e6 + 250 * y, 2)
    assert np.allclose(b, 1e6 + 250 * a, rtol=1e-9)


def test_refinement_never_hurts(monkeypatch):
    y = np.random.default_rng(1).normal(50, 5, (6, 20))
    _, refined = fc.fit_windows(y, 1)
    monkeypatch.setattr(fc, "REFINE_ROUNDS", 0)
    _, grid = fc.fit_windows(y, 1)
    assert (refined <= grid + 1e-9).all()


def test_short_missing_and_mixed_lengths():
    train = pd.Series([np.arange(5.0), None, np.arange(12.0), np.r_[np.arange(9.0), np.nan, 1.0, 2.0], np.arange(10.0)])
    out = fc.forecast_rows(train, 1)
    assert out[0] is None and out[1] is None and out[3] is None
    assert np.allclose(out[2], [12.0]) and np.allclose(out[4], [10.0])


def test_kernel_agrees_with_sql_form(spark):
    y = [10.0, 12.0, 11.0, 15.0, 14.0, 18.0]
    got = rows(backtest.holt_forecast(daily(spark, y), 0.4, 0.2), "n_obs", "level", "trend", "forecast")[0]
    _, level, slope = simulate(y[1:], 0.4, 0.2, 10.0, 2.0)
    assert got[0] == 6 and np.allclose(got[1:], [level, slope, level + slope])


def test_sql_form_needs_two_points(spark):
    assert backtest.holt_forecast(daily(spark, [1.0]), 0.4, 0.2).count() == 0


@pytest.mark.parametrize("trend", [True, False])
def test_every_origin_gets_the_refined_fit_of_its_own_window(trend, monkeypatch):
    monkeypatch.setattr(fc, "_CHUNK", 7)
    y = np.random.default_rng(7).normal(0, 1, 40).cumsum() + 40
    found = fc.fit_origins(y, 10, 3, trend)
    each = np.stack([fc.fit_windows(y[None, :n], 3, trend)[0][0] for n in range(10, 41)])
    assert found.shape == (31, 3) and np.allclose(found, each)
    assert fc.fit_origins(y[:5], 10, 3).shape == (0, 3)


def test_expanding_backtest_fits_all_origins(spark):
    y = list(np.random.default_rng(8).normal(0, 1, 30).cumsum() + 40)
    out = rows(backtest.expanding_splits(daily(spark, y), min_train=12, methods=("ets",)).orderBy("split"), "split", "ets")
    want = fc.fit_origins(np.array(y), 12, 1)
    assert len(out) == 18 and np.allclose([r[1][0] for r in out], want[:18, 0])


def test_form_names():
    with pytest.raises(ValueError):
        fc.ets_forecast(None, 1, "linear")


@pytest.mark.parametrize("trend", [True, False])
@pytest.mark.parametrize("n", [12, 28, 70])
def test_fit_is_the_best_of_the_grid_or_better(trend, n):
    y = np.random.default_rng(n).normal(50, 5, (5, n))
    forecast, sse = fc.fit_windows(y, 1, trend)
    for row, found in zip(y, sse):
        assert found <= brute_force(row, trend)[0] * (1 + 1e-6)


def test_origins_share_passes(monkeypatch):
    y, seen = np.random.default_rng(3).normal(50, 5, 400), []
    real = fc._errors
    monkeypatch.setattr(fc, "_errors", lambda d, p, q: seen.append(p.size * len(d)) or real(d, p, q))
    fc.fit_origins(y, 14, 1)
    # passes of its own for every origin and neighbour would add up all lengths
    assert sum(seen) < 0.2 * 6 * 9 * sum(range(14, 401))


def test_series_abreast_equal_their_windows(monkeypatch):
    rng = np.random.default_rng(3)
    ys = [rng.normal(0, 1, n).cumsum() + 40 for n in (40, 9, 10, 75, 40)]
    found = fc.fit_series(ys, 10, 2)
    for y, f in zip(ys, found):
        assert np.allclose(f, np.array([fc.fit_windows(y[None, :n], 2)[0][0] for n in range(10, len(y) + 1)]).reshape(-1, 2))
    monkeypatch.setattr(fc, "_CELLS", 500)
    monkeypatch.setattr(fc, "_SERIES", 2)
    assert all(np.allclose(a, b) for a, b in zip(found, fc.fit_series(ys, 10, 2)))


def test_items_that_cross_batches_and_gaps(spark):
    rng = np.random.default_rng(5)
    paths = {k: [None if (k, t) in ((3, 17), (4, 0), (5, 11)) else float(v) for t, v in enumerate(rng.normal(0, 1, n).cumsum() + 40)]
             for k, n in enumerate((30, 5, 12, 25, 20, 12, 13))}
    series = None
    for k, path in paths.items():
        one = daily(spark, path, item=k)
        series = one if series is None else series.unionByName(one)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {(r.item_id, r.date.toordinal()): r._ets for r in backtest.expanding_ets(series, 12, 2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    first = dt.date(2024, 1, 1).toordinal()
    want = {(k, first + t): fc.fit_windows(np.array(path[:t])[None, :], 2)[0][0]
            for k, path in paths.items() for t in range(12, len(path)) if None not in path[:t]}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
