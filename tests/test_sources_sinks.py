import contextlib
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barloom.operators import incremental, quality, silver
from barloom.operators import metrics as errors
from barloom.plans import pipeline
from barloom.schema import SELECTION_FALLBACK_IDS, SelectionConfig
from barloom.sinks import tables
from barloom.sources import landing, testbed
from helpers import at, plan, raw_rows, rows

ARRAY = {"data": [{"timestamp": 1704067200, "avgHighPrice": 10, "avgLowPrice": None, "highPriceVolume": 3, "lowPriceVolume": 4},
                  {"avgHighPrice": 11}]}
MAP = {"data": {"1704070800": {"avgHighPrice": 20, "avgLowPrice": 19}, "soon": {"avgHighPrice": 1}}}


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "timeseries_4151_1h.json").write_text(json.dumps(ARRAY, indent=2))
    (tmp_path / "timeseries_561_1h.json").write_text(json.dumps(MAP, indent=2))
    (tmp_path / "timeseries_2_1h.json").write_text("{broken")
    (tmp_path / "timeseries_3_1h.json").write_text('{"data": []}')
    (tmp_path / "timeseries_561_5m.json").write_text(json.dumps(ARRAY))
    return str(tmp_path)


def test_landed_files(spark, landed):
    got = sorted(rows(landing.read_timeseries_files(spark, landed), "item_id", "timestamp", "avgHighPrice", "avgLowPrice", "highPriceVolume", "lowPriceVolume"), key=str)
    assert got == [
        (4151, dt.datetime(1970, 1, 1), 11, None, None, None),
        (4151, dt.datetime(2024, 1, 1), 10, None, 3, 4),
        (561, dt.datetime(2024, 1, 1, 1), 20, 19, None, None),
    ]


def test_what_landed_files_leave_out_is_named(spark, landed):
    from pathlib import Path

    (Path(landed) / "timeseries_7_1h.json").write_text(json.dumps({"data": [{"timestamp": "x"}, 5, None, {"timestamp": None}]}))
    (Path(landed) / "timeseries_8_1h.json").write_text(json.dumps({"data": {"1": 3, "2": {"avgLowPrice": 4}}}))
    (Path(landed) / "timeseries_9_1h.json").write_text(json.dumps({"other": []}))
    docs = landing.timeseries_documents(spark, landed)
    assert sorted(rows(landing.rejected(docs)), key=str) == sorted([
        (561, "key", "soon"), (2, "document", None), (7, "entry", "0"), (7, "entry", "1"), (7, "entry", "2"), (8, "entry", "1"),
        (9, "document", None)], key=str)
    kept = landing.parse_documents(docs)
    assert sorted(rows(kept.where("item_id IN (7, 8)"), "item_id", "avgLowPrice"), key=str) == [(7, None), (8, 4)]
    assert plan(kept).count("parseJson") == 1


def test_bucketed_append_leaves_the_store_in_place(spark, tmp_path):
    name, path, keys = f"bucketed_{tmp_path.name}".replace("-", "_"), str(tmp_path / "b"), ["timestamp", "item_id"]
    first = raw_rows(spark, [(at(1), 1, 1, 1, 1, i % 5, at(1)) for i in range(10)])
    tables.append_new_bucketed(first, name, keys, 4, path)
    more = raw_rows(spark, [(at(1), 2, 2, 2, 2, 4, at(2)), (at(2), 3, 3, 3, 3, 4, at(2)), (None, 4, 4, 4, 4, 4, at(2))])
    out = tables.append_new(spark.table(name), more, keys)
    with _conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), _conf(spark, "spark.sql.adaptive.enabled", "false"):
        text = plan(tables.append_new(spark.table(name), more, keys))
    assert text.count("Exchange") == 1 and "Bucketed: true" in text  # the incoming rows only
    assert out.count() == 2
    tables.append_new_bucketed(more, name, keys, 4, path)
    assert spark.table(name).count() == 12
    spark.sql(f"DROP TABLE {name}")


@contextlib.contextmanager
def _conf(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_failing_rows_are_stored_once_with_all_they_fail(spark, tmp_path):
    spec = quality.TableChecks(required=("a",), key=("k",), amounts=("v",), accepted={"s": ("x",)})
    df = spark.createDataFrame([(1, None, -1, "y"), (1, "q", 2, "x"), (2, "q", 3, None), (None, "q", 3, "x"), (None, "q", 3, "x"), (3, "q", 3, "z")],
                               "k long, a string, v long, s string")
    path = str(tmp_path / "f")
    counts = quality.check_table(df, spec, path)
    assert counts == {"not_null_a": 1, "non_negative_v": 1, "accepted_values_s": 2, "unique_k": 1}
    assert counts == quality.check_table(df, spec)
    kept = sorted((r.k, r.failed_checks) for r in spark.read.parquet(path).collect())
    assert kept == [(1, ["not_null_a", "non_negative_v", "accepted_values_s", "unique_k"]), (1, ["unique_k"]), (3, ["accepted_values_s"])]
    assert plan(quality.failing_rows(spark.read.parquet(path), spec)).count("FileScan") == 1


def test_checks_are_counted_by_the_write(spark, tmp_path):
    spec = quality.TableChecks(required=("a",), amounts=("v",))
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "q", i - 10) for i in range(100)], "k long, a string, v long").repartition(7)
    counts = tables.replace_table(df, str(tmp_path / "t"), cluster_by=("k",), checks=spec)
    assert counts == {"rows": 100, "not_null_a": 25, "non_negative_v": 10}
    assert tables.replace_table(df, str(tmp_path / "u")) == {}


def test_runs_are_known_by_what_they_are(spark, tmp_path):
    path, mark = str(tmp_path / "runs"), at(3)
    one = errors.run_identity(mark, window=10, methods=("a",))
    assert one == errors.run_identity(mark, methods=["a"], window=10) and len(one) == 16
    assert len({one, errors.run_identity(at(4), window=10, methods=("a",)), errors.run_identity(mark, window=11, methods=("a",))}) == 3
    for run in (one, "r000000000000001", one):
        tables.store_run(spark.createDataFrame([(1, 2.0)], "item_id long, mae double"), path, run)
    assert sorted(rows(tables.read_runs(spark, path), "run_id")) == sorted([(one,), ("r000000000000001",)])


def test_item_list(spark, tmp_path):
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps([{"id": 1, "name": "A", "limit": 5, "icon": "x"}, {"id": 2, "name": "B", "members": True}]))
    assert rows(landing.read_item_mapping(spark, str(path)).orderBy("id"), "id", "name", "limit", "members") == [(1, "A", 5, None), (2, "B", None, True)]


def selection_rows(spark):
    return spark.createDataFrame([(7, "A", 1.5, "auto_selected"), (3, "B", 2.5, "manual_include")], "id long, name string, ranking_score double, selection_reason string")


def test_selection_round_trip(spark, tmp_path):
    path = str(tmp_path / "sel")
    tables.write_selection(selection_rows(spark), path)
    assert rows(landing.load_selection(spark, path).orderBy("pos")) == [(0, 3), (1, 7)]
    meta = landing.read_selection(spark, path).select("metadata.*").first()
    assert (meta.total_items, meta.version, meta.selection_criteria) == (2, "1.0", "median_daily_volume + coverage_pct")


@pytest.mark.parametrize("content", [None, "", "{broken", '{"items": []}', '{"other": 1}'])
def test_selection_fallback(spark, tmp_path, content):
    path = tmp_path / "sel.json"
    if content is not None:
        path.write_text(content)
    assert rows(landing.load_selection(spark, str(path)).orderBy("pos"), "item_id") == [(i,) for i in SELECTION_FALLBACK_IDS]


def test_append_keeps_repeats_inside_a_batch(spark, tmp_path):
    path, keys = str(tmp_path / "raw"), ["timestamp", "item_id"]
    tables.append_new_rows(raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1)), (at(1), 2, 1, 1, 1, 1, at(1))]), path, keys)
    tables.append_new_rows(raw_rows(spark, [(at(1), 9, 1, 1, 1, 1, at(2)), (at(2), 3, 1, 1, 1, 1, at(2)), (at(2), 4, 1, 1, 1, 1, at(2))]), path, keys, "timestamp")
    assert sorted(rows(spark.read.parquet(path), "avgHighPrice")) == [(1,), (2,), (3,), (4,)]


def test_append_scans_the_batch_range_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1))]).write.parquet(path)
    new = incremental.append_new(spark.read.parquet(path), raw_rows(spark, [(at(2), 1, 1, 1, 1, 1, at(2))]), ["timestamp", "item_id"], "timestamp")
    assert "Subquery" in plan(new) and new.count() == 1


def test_schema_change_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "1 AS d").write.parquet(path)
    with pytest.raises(tables.SchemaChanged):
        tables.append_new_rows(spark.range(3).selectExpr("id", "'x' AS d"), path, ["id"])
    with pytest.raises(tables.SchemaChanged):
        tables.upsert_table(spark.range(3).selectExpr("id", "1 AS d", "2 AS e"), path, ["id"], "d")


def keyed(spark, data):
    return spark.createDataFrame(data, "item_id long, ts timestamp_ntz, v long, load_ts timestamp_ntz, ts_date date")


def test_upsert_rewrites_touched_days_only(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["item_id", "ts"]
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    tables.upsert_table(keyed(spark, [(1, at(1), 10, at(1), d1), (1, at(2), 20, at(2), d2), (2, at(2), 21, at(2), d2)]), path, keys, "ts_date")
    untouched = sorted(p.name for p in (tmp_path / "t" / "ts_date=2024-01-01").iterdir())
    batch = keyed(spark, [(1, at(2), 99, at(5), d2), (3, at(3), 30, at(5), d3)])
    for _ in range(2):  # replaying the batch changes nothing
        tables.upsert_table(batch, path, keys, "ts_date")
        assert sorted(rows(spark.read.parquet(path), "item_id", "v")) == [(1, 10), (1, 99), (2, 21), (3, 30)]
    assert sorted(p.name for p in (tmp_path / "t" / "ts_date=2024-01-01").iterdir()) == untouched


def test_upsert_by_newest_ignores_older_loads(spark, tmp_path):
    path, keys, d1 = str(tmp_path / "t"), ["item_id", "ts"], dt.date(2024, 1, 1)
    tables.upsert_table(keyed(spark, [(1, at(1), 10, at(5), d1)]), path, keys, "ts_date", newest="load_ts")
    tables.upsert_table(keyed(spark, [(1, at(1), 77, at(3), d1), (2, at(1), 5, at(3), d1)]), path, keys, "ts_date", newest="load_ts")
    assert sorted(rows(spark.read.parquet(path), "item_id", "v")) == [(1, 10), (2, 5)]


def test_upsert_keeps_rows_without_a_day_and_one_row_per_key(spark, tmp_path):
    path, keys, d1 = str(tmp_path / "t"), ["item_id", "ts"], dt.date(2024, 1, 1)
    tables.upsert_table(keyed(spark, [(1, None, 10, at(1), None), (5, at(1), 1, at(1), d1)]), path, keys, "ts_date")
    batch = keyed(spark, [(2, None, 20, at(1), None), (1, None, 11, at(2), None), (3, at(1), 7, at(1), d1), (3, at(1), 8, at(1), d1)])
    for _ in range(2):
        tables.upsert_table(batch, path, keys, "ts_date")
        assert sorted(rows(spark.read.parquet(path), "item_id", "v")) == [(1, 11), (2, 20), (3, 8), (5, 1)]


def test_upsert_that_stops_before_the_move_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path, keys, d1 = str(tmp_path / "t"), ["item_id", "ts"], dt.date(2024, 1, 1)
    tables.upsert_table(keyed(spark, [(1, at(1), 10, at(1), d1)]), path, keys, "ts_date")
    real, calls = tables.recover, []

    def stopping(*args):
        calls.append(args)
        if len(calls) == 2:
            # the worst moment: the old day is gone, the new one is not there yet
            for f in (tmp_path / "t" / "ts_date=2024-01-01").iterdir():
                f.unlink()
            raise KeyboardInterrupt
        real(*args)

    monkeypatch.setattr(tables, "recover", stopping)
    with pytest.raises(KeyboardInterrupt):
        tables.upsert_table(keyed(spark, [(2, at(1), 20, at(1), d1)]), path, keys, "ts_date")
    monkeypatch.setattr(tables, "recover", real)
    tables.upsert_table(keyed(spark, [(3, at(1), 30, at(1), d1)]), path, keys, "ts_date")
    assert sorted(rows(spark.read.parquet(path), "item_id", "v")) == [(1, 10), (2, 20), (3, 30)]
    assert not (tmp_path / "t.staged").exists()


def test_upsert_writes_a_day_once_and_moves_its_folder(spark, tmp_path, monkeypatch):
    path, keys, d1, d2 = str(tmp_path / "t"), ["item_id", "ts"], dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    moved, real = [], tables.move_folders

    def move(spark, source, target, prefix):
        moved.append({f.relative_to(source): f.stat().st_ino for f in tmp_path.glob("t.staged/*/*.parquet")})
        real(spark, source, target, prefix)

    monkeypatch.setattr(tables, "move_folders", move)
    tables.upsert_table(keyed(spark, [(1, at(1), 10, at(1), d1), (1, at(2), 11, at(2), d2), (9, at(9), 9, at(9), None)]), path, keys, "ts_date")
    tables.upsert_table(keyed(spark, [(2, at(1), 20, at(1), d1), (9, at(9), 7, at(9), None)]), path, keys, "ts_date")
    kept = {f.relative_to(tmp_path / "t"): f.stat().st_ino for f in (tmp_path / "t").glob("*/*.parquet")}
    assert len(moved) == 2 and moved[1].items() <= kept.items()  # the very files of the staging folder
    assert {f: i for f, i in moved[0].items() if "01-02" in str(f)}.items() <= kept.items()  # an untouched day
    assert sorted(rows(spark.read.parquet(path), "item_id", "v")) == [(1, 10), (1, 11), (2, 20), (9, 7)]


def test_a_move_that_stops_halfway_is_finished(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["item_id", "ts"]
    days = [(1, at(d), d, at(d), dt.date(2024, 1, d)) for d in (1, 2, 3)]
    tables.upsert_table(keyed(spark, days), path, keys, "ts_date")
    staged = tmp_path / "t.staged"
    staged.mkdir()
    (tmp_path / "t" / "ts_date=2024-01-02").rename(staged / "ts_date=2024-01-02")  # not moved yet, its old folder gone
    (staged / "_SUCCESS").touch()
    tables.recover(spark, path, "ts_date")
    assert sorted(rows(spark.read.parquet(path), "v")) == [(1,), (2,), (3,)] and not staged.exists()


def test_backtest_upsert_always_leaves_one_row_per_key(spark):
    schema = "item_id long, date date, method string, mae double, window_size int, horizon int"
    day = dt.date(2024, 1, 1)
    old = spark.createDataFrame([(1, day, "ets", 1.0, 10, 1)], schema)
    new = spark.createDataFrame([(1, day, "ets", 5.0, 10, 1), (1, day, "ets", 6.0, 10, 1)], schema)
    assert rows(incremental.upsert_backtest(old, new), "item_id", "mae") == [(1, 6.0)]


def test_backtest_upsert_last_repeat_wins(spark):
    schema = "item_id long, date date, method string, mae double, window_size int, horizon int, seq long"
    day = dt.date(2024, 1, 1)
    old = spark.createDataFrame([(1, day, "ets", 1.0, 10, 1, 0), (2, day, "ets", 2.0, 10, 1, 0)], schema)
    new = spark.createDataFrame([(1, day, "ets", 5.0, 10, 1, 1), (1, day, "ets", 6.0, 10, 1, 2)], schema)
    assert sorted(rows(incremental.upsert_backtest(old, new, "seq"), "item_id", "mae")) == [(1, 6.0), (2, 2.0)]


def test_incremental_silver_from_nothing_is_a_full_load(spark):
    raw = raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1)), (at(2), 1, 1, 1, 1, 1, at(2))])
    empty = silver.silver_timeseries(raw).where("false")
    assert incremental.incremental_silver(raw, empty).count() == 2


def test_incremental_gold_modes(spark):
    from barloom.operators import gold

    raw = raw_rows(spark, [(at(d), 100 + d, 100 + d, 1, 1, 1, at(d)) for d in range(1, 13)])
    observations = silver.silver_timeseries(raw)
    full = gold.gold_daily_features(observations)
    stored = full.where("date <= date'2024-01-08'")
    context = incremental.incremental_gold(observations, stored)
    assert sorted(rows(context)) == sorted(rows(full.where("date > date'2024-01-08'")))
    restart = incremental.incremental_gold(observations, stored, "reference").orderBy("date")
    assert rows(restart, "daily_return")[0] == (None,) and rows(restart, "price_7d_ma")[0] == (109.0,)
    # a late row of a stored day is not taken up
    late = raw_rows(spark, [(at(3, 5), 999, 999, 1, 1, 1, at(20))])
    assert incremental.incremental_gold(silver.silver_timeseries(raw.unionByName(late)), full).count() == 0


def test_validated_items(spark):
    good = spark.createDataFrame([("1", "A", "true", "5", None, "7")], "id string, name string, members string, lowalch string, highalch string, limit string")
    r = quality.validated_items(good).first()
    assert (r.id, r.members, r.lowalch, r.highalch) == (1, True, 5, None)
    for bad in ([("0", "A", None, None, None, None)], [("1", None, None, None, None, None)], [("1", "A", None, "-5", None, None)], [("x", "A", None, None, None, None)]):
        with pytest.raises(ValueError):
            quality.validated_items(spark.createDataFrame(bad, good.schema))


def test_checks_count_and_store(spark, tmp_path):
    df = spark.createDataFrame([(1, "f", 5), (1, "f", -5), (None, "g", 5), (None, "f", None)], "k long, source string, amount long")
    spec = quality.TableChecks(required=("k",), key=("k",), amounts=("amount",), accepted={"source": ("f",)})
    counts = quality.check_table(df, spec, str(tmp_path / "fail"))
    assert counts == {"not_null_k": 2, "non_negative_amount": 1, "accepted_values_source": 1, "unique_k": 1}
    kept = spark.read.parquet(str(tmp_path / "fail"))
    assert rows(kept.where(F.array_contains("failed_checks", "unique_k")), "k") == [(1,), (1,)] and kept.count() == 4


def test_row_preservation_passes_on_equal_counts(spark):
    assert quality.row_preservation(spark.range(5), spark.range(5)).count() == 0
    assert rows(quality.row_preservation(spark.range(5), spark.range(0))) == [(5, 0, 5)]


def test_refresh_stores_every_layer(spark, sf_dir, tmp_path):
    config = pipeline.RefreshConfig(
        as_of="2024-01-31", selection=SelectionConfig(min_days=20, min_volume=100, lookback_days=30, top_n=3, include_ids=(4,)),
        window=10, methods=("last_value",), selected_only=True)
    out = pipeline.refresh(spark, testbed.prices_raw(spark, sf_dir), testbed.items_raw(spark, sf_dir), str(tmp_path), config)
    counts = {name: df.count() for name, df in out.items()}
    assert all(counts.values()), counts
    assert counts["silver_timeseries"] == 1000 and 3 <= counts["items_selected"] <= 4
    chosen = {r[0] for r in rows(out["items_selected"], "id")}
    assert {r[0] for r in rows(out["gold_backtest_metrics"].select("item_id").distinct())} <= chosen
    checks = pipeline.check(out, str(tmp_path))
    assert checks["silver_timeseries"]["unique_item_id_ts"] == 0
    assert all(n == 0 for n in checks["gold_daily_features"].values())


def test_upsert_reads_touched_days_only(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "t"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.upsert_table(keyed(spark, [(1, at(1), 10, at(1), d1), (1, at(2), 20, at(2), d2)]), path, ["item_id", "ts"], "ts_date")
    pruned = spark.read.parquet(path).where("ts_date IN (date'2024-01-02')")
    assert "PartitionFilters: [isnotnull(ts_date" in plan(pruned)
