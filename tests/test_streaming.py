import datetime as dt

from barloom.operators import silver
from barloom.streaming import jobs
from helpers import RAW, at, raw_rows, rows


def land(spark, folder, *batches):
    for batch in batches:
        raw_rows(spark, batch).coalesce(1).write.mode("append").parquet(folder)


def test_silver_stream_over_several_batches(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "silver")
    schema = spark.createDataFrame([], RAW).schema
    batches = [
        [(at(1), 100, 90, 1, 1, 1, at(1, 1)), (at(2), 200, 90, 1, 1, 1, at(2, 1))],
        [(at(1), 107, 90, 1, 1, 1, at(3)), (at(3), 300, 90, 1, 1, 2, at(3))],   # late correction
        [(at(1), 50, 90, 1, 1, 1, at(1))],                                       # older load: ignored
    ]
    for batch in batches:
        land(spark, src, batch)
        stream = jobs.read_stream(spark, src, schema, files_per_batch=1)
        jobs.silver_upserts(stream, table, str(tmp_path / "offsets")).awaitTermination()
    got = sorted(rows(spark.read.parquet(table).drop("ts_date")))
    full = raw_rows(spark, [r for b in batches for r in b])
    assert got == sorted(rows(silver.silver_timeseries(full)))


def test_daily_bars_emit_closed_days_once(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = spark.createDataFrame([], RAW).schema
    land(spark, src, [(at(1, h), 100 + h, 90, 1, 1, 1, at(1)) for h in (1, 5)] + [(at(3, 1), 300, 290, 1, 1, 1, at(3))])

    def run():
        stream = jobs.read_stream(spark, src, schema)
        jobs.run_to_table(jobs.closed_daily_bars(stream), str(tmp_path / "bars"), str(tmp_path / "offsets"))
        return sorted(rows(spark.read.parquet(str(tmp_path / "bars")), "price_date", "open_price", "close_price", "data_points"))

    assert run() == [(dt.date(2024, 1, 1), 101, 105, 2)]
    # a row for the emitted day comes too late; day 3 closes
    land(spark, src, [(at(1, 9), 999, 90, 1, 1, 1, at(6)), (at(6), 600, 590, 1, 1, 1, at(6))])
    assert run() == [(dt.date(2024, 1, 1), 101, 105, 2), (dt.date(2024, 1, 3), 300, 300, 1)]


def test_first_arrivals_drop_repeats(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = spark.createDataFrame([], RAW).schema
    land(spark, src, [(at(1), 1, 1, 1, 1, 1, at(1)), (at(1), 2, 1, 1, 1, 1, at(1)), (at(1), 3, 1, 1, 1, 2, at(1))])
    stream = jobs.read_stream(spark, src, schema)
    assert sorted(rows(jobs.drain(spark, jobs.first_arrivals(stream), "keys"), "item_id", "timestamp")) == [(1, at(1)), (2, at(1))]


def test_single_file_and_folder_are_both_sources(spark, tmp_path):
    raw_rows(spark, [(at(1), 1, 1, 1, 1, 1, at(1))]).coalesce(1).write.parquet(str(tmp_path / "d"))
    schema = spark.createDataFrame([], RAW).schema
    part = next((tmp_path / "d").glob("*.parquet"))
    for path in (str(tmp_path / "d"), str(part)):
        assert jobs.drain(spark, jobs.read_stream(spark, path, schema), "copy").count() == 1


def test_gold_upserts_equal_a_rebuild_however_the_rows_arrive(spark, tmp_path):
    from barloom.operators import gold

    schema = spark.createDataFrame([], RAW).schema
    data = [(at(d, h), 100 + d * h, 90 + d, 1, 1, item, at(d)) for d in range(1, 13) for h in (1, 2) for item in (1, 2)]
    full = gold.gold_daily_features(silver.silver_timeseries(raw_rows(spark, data)))
    src, table = str(tmp_path / "src"), str(tmp_path / "gold")
    for part in range(3):  # days and items torn apart
        land(spark, src, data[part::3])
        jobs.gold_upserts(jobs.read_stream(spark, src, schema), table, str(tmp_path / "offsets")).awaitTermination()
    key = lambda r: (r[0], r[1])
    assert sorted(rows(spark.read.parquet(table).select(full.columns)), key=key) == sorted(rows(full), key=key)


def test_frozen_days_are_those_of_the_item(spark, tmp_path):
    schema = spark.createDataFrame([], RAW).schema
    src, table = str(tmp_path / "src"), str(tmp_path / "gold")
    for batch in ([(at(5, 1), 100, 90, 1, 1, 1, at(5))],
                  [(at(5, 2), 300, 90, 1, 1, 1, at(5)), (at(3, 1), 50, 40, 1, 1, 2, at(5))]):
        land(spark, src, batch)
        stream = jobs.read_stream(spark, src, schema)
        jobs.gold_upserts(stream, table, str(tmp_path / "offsets"), mode="frozen").awaitTermination()
    assert sorted(rows(spark.read.parquet(table), "item_id", "latest_price_high")) == [(1, 100), (2, 50)]
