"""The refresh in runs: equal to one full load, resumed where it stopped, idempotent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import gold, moments, silver
from barloom.plans import features, incremental, pipeline
from barloom.plans.ledger import FINISHED, Ledger, rows_of
from barloom.schema import SelectionConfig
from barloom.sources import testbed
from helpers import at, raw_rows, rows

CONFIG = pipeline.RefreshConfig(
    as_of="2024-01-31", selection=SelectionConfig(min_days=20, min_volume=100, lookback_days=30, top_n=3, include_ids=(4,)),
    window=10, methods=("last_value", "moving_average"))


def same(a, b):
    """Both tables hold the same rows, doubles to 9 places."""
    assert sorted(a.columns) == sorted(b.columns)

    def key(df):
        out = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()]
        return sorted(out, key=repr)

    assert key(a) == key(b)


def loaded_before(raw, day):
    return raw.where(F.col("ingested_at") < F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz"))


def test_runs_equal_one_full_load_also_when_one_stops(spark, sf_dir, tmp_path, monkeypatch):
    raw, items = testbed.prices_raw(spark, sf_dir).where("item_id % 3 = 0"), testbed.items_raw(spark, sf_dir)
    full = pipeline.refresh(spark, raw, items, str(tmp_path / "full"), CONFIG)
    root = str(tmp_path / "runs")
    incremental.refresh(spark, loaded_before(raw, 12), items, root, CONFIG)

    real = incremental.Refresh.gold_daily_features
    written = []

    def stopping(self, run):
        real(self, run)  # stored, but not yet in the ledger
        raise KeyboardInterrupt

    monkeypatch.setattr(incremental.Refresh, "gold_daily_features", stopping)
    with pytest.raises(KeyboardInterrupt):
        incremental.refresh(spark, loaded_before(raw, 24), items, root, CONFIG)
    ledger = Ledger(spark, f"{root}/runs")
    stopped = ledger.last()
    assert stopped.number == 2 and "daily_bars" in stopped.done and "gold_daily_features" not in stopped.done

    monkeypatch.setattr(incremental.Refresh, "gold_daily_features", lambda self, run: (written.append(run), real(self, run)))
    monkeypatch.setattr(incremental.Refresh, "daily_bars", lambda self, run, f=incremental.Refresh.daily_bars: (
        written.append("bars"), f(self, run)))
    incremental.refresh(spark, raw, items, root, CONFIG)  # ends the second run, whatever was landed meanwhile
    assert [w if w == "bars" else w.number for w in written] == [2] and ledger.last().high == stopped.high
    out = incremental.refresh(spark, raw, items, root, CONFIG)
    assert [w if w == "bars" else w.number for w in written] == [2, "bars", 3] and ledger.last().finished
    for name, table in full.items():
        same(table, out[name])

    before = ledger.entries().count()
    incremental.refresh(spark, raw, items, root, CONFIG)  # nothing new
    assert ledger.entries().count() == before and len(written) == 3


def test_second_run_scores_the_origins_it_touches_only(spark, tmp_path, monkeypatch):
    raw = raw_rows(spark, [(at(d, h), 100 + d * item, 90 + d, 500, 1, item, at(d, 23)) for d in range(1, 26) for h in (1, 2) for item in (1, 2)])
    seen, real = [], incremental.backtest.origin_scores
    monkeypatch.setattr(incremental.Refresh, "LAYERS", ("silver_timeseries", "gold_daily_features", "backtest_origins"))

    def scores(*args, **named):
        out = real(*args, **named)
        seen.append(out.collect())  # now: later runs replace what it reads
        return out

    monkeypatch.setattr(incremental.backtest, "origin_scores", scores)
    late = raw.unionByName(raw_rows(spark, [(at(5, 3), 999, 90, 500, 1, 1, at(27))]))
    for part in (loaded_before(raw, 24), raw, late):
        out = incremental.refresh(spark, part, None, str(tmp_path), CONFIG)["gold_backtest_metrics"]
    assert len(seen[0]) == 2 * 2 * 13
    assert sorted({r.date for r in seen[1]}) == [dt.date(2024, 1, 24), dt.date(2024, 1, 25)]
    assert {(r.item_id, r.date) for r in seen[2]} == {(1, dt.date(2024, 1, d)) for d in range(11, 16)}  # trained on the 5th
    series = gold.scan_item_series(gold.gold_daily_features(silver.silver_timeseries(late)), "latest_price", "date")
    same(out, incremental.backtest.backtest_scores(series, CONFIG.methods, CONFIG.window))


def test_ledger_ranges_meet_without_gap_or_overlap(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, i, at(i)) for i in (1, 2, 3)] + [(at(1), 1, 1, 1, 1, 9, None)])
    assert ledger.last() is None and ledger.begin(raw.where("false")) is None
    first = ledger.begin(raw.where("item_id < 3 OR item_id = 9"))
    assert sorted(rows(rows_of(raw, first), "item_id")) == [(1,), (2,), (9,)]
    again = ledger.begin(raw)
    assert (again.number, again.high) == (1, first.high)
    ledger.commit(first, FINISHED)
    second = ledger.begin(raw)
    assert second.number == 2 and rows(rows_of(raw, second), "item_id") == [(3,)]


def days(spark, prices, item=1, first=1):
    data = [(item, dt.date(2024, 1, 1) + dt.timedelta(days=first - 1 + i), p, p, 1, 1, p, p) for i, p in enumerate(prices)]
    return spark.createDataFrame(data, (
        "item_id long, date date, min_price long, max_price long, total_volume long, observation_count long, "
        "latest_price_high long, latest_price_low long"))


def test_flags_of_old_days_turn_with_the_threshold(spark, tmp_path):
    table = str(tmp_path / "t")
    calm = [100, 101, 100, 101, 100, 101, 100, 101, 100, 101, 100, 140]
    wild = [[60, 180], [50, 200, 40, 220]]
    features.update_features(days(spark, calm), table)
    flag = lambda: {r.date.day: r.is_outlier for r in spark.read.parquet(table).collect()}
    assert flag()[12]
    for part in wild:
        features.update_features(days(spark, part, first=len(calm) + 1), table)
        calm = calm + part
        want = gold.with_outlier_flag(gold.price_features(days(spark, calm)))
        assert flag() == {r.date.day: r.is_outlier for r in want.collect()}
    assert not flag()[12]


def test_calm_days_read_no_history(spark, tmp_path, monkeypatch):
    table, prices = str(tmp_path / "t"), [100 + i % 5 for i in range(20)]
    features.update_features(days(spark, prices).unionByName(days(spark, prices, item=2)), table)
    state = spark.read.parquet(features.states_path(table))
    assert state.where("item_id = 1").first().n == 19
    more = days(spark, [102, 101], first=21)
    new, states = moments.advance(more, state, spark.read.parquet(table).where("false"))  # a history would be missed
    want = gold.with_outlier_flag(gold.price_features(days(spark, prices + [102, 101]))).where("day(date) > 20")
    same(new, want.select(*gold.GOLD_DAILY_COLUMNS))
    one = states.first()
    whole = moments.item_states(gold.price_features(days(spark, prices + [102, 101]))).first()
    assert [d.date.day for d in one.recent] == [d.date.day for d in whole.recent] == [22, 21, 20, 19, 18, 17]
    for c in ("n", "mean", "m2", "in_low", "in_high"):
        assert one[c] == pytest.approx(whole[c])


def test_repeated_batches_count_once(spark, tmp_path):
    for frozen in (False, True):
        table = str(tmp_path / f"t{frozen}")
        for part in ([100, 110, 99], [120, 80]):
            batch = days(spark, part, first=1 if len(part) == 3 else 4)
            for _ in range(2):
                features.update_features(batch, table, frozen)
        assert spark.read.parquet(features.states_path(table)).first().n == 4
        want = gold.with_outlier_flag(gold.price_features(days(spark, [100, 110, 99, 120, 80])))
        same(spark.read.parquet(table), want.select(*gold.GOLD_DAILY_COLUMNS))


def test_cleaned_rows_equal_raw_ones_after_landing(spark, sf_dir):
    from barloom.operators import bronze

    raw = testbed.prices_raw(spark, sf_dir)
    same(silver.silver_timeseries(bronze.landed_names(bronze.bronze_timeseries(raw))), silver.silver_timeseries(raw))
