"""Structured Streaming forms of the incremental steps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.functions import scalar as S
from barloom.operators import gold, silver
from barloom.plans.features import rows_of_days, update_features
from barloom.session import scratch_path, settled
from barloom.sinks.tables import upsert_table
from barloom.streaming.late import after_closed_days
from barloom.streaming.state import use_rocksdb

SILVER_KEYS = ["ts", "item_id"]
SILVER_TIES = ["price_avg_high", "price_avg_low", "volume"]


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Stream the Parquet files of a folder, or a single Parquet file.

    File sources take folders; a lone file is addressed as a pattern with its own name.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, name = os.path.split(path.rstrip("/"))
    return reader.parquet(f"{folder}/{{{name}}}")


def silver_upserts(raw_stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Keep a silver table, partitioned by day, up to date with a raw stream.

    Late rows are accepted: each batch is cleaned, reduced to one row per key and merged
    into the days it touches, the newest load winning. Replaying a batch changes nothing.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = silver.clean_observations(batch).withColumn("ts_date", F.to_date("ts"))
        fresh = silver.keep_latest(rows, SILVER_KEYS, "load_ts", SILVER_TIES)
        upsert_table(fresh, table, SILVER_KEYS, "ts_date", newest="load_ts", ties=SILVER_TIES)

    return (
        raw_stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def gold_upserts(raw_stream: DataFrame, table: str, checkpoint: str, mode: str = "exact") -> StreamingQuery:
    """Keep the daily features, partitioned by date, up to date with a raw stream.

    ``exact``: cleaned rows are kept in ``<table>.silver``. A batch reads there the days it touches, and in
    ``<table>.items`` one row per item; histories are read of those items only whose old days change (see
    :mod:`barloom.operators.moments`). However the rows are batched, the result is that of one run over all of them.
    ``frozen``: a row for a day not after the newest day its item had in earlier batches is ignored, windows see the
    earlier days, and old flags stay. The stored features are not read at all.
    """
    if mode not in ("exact", "frozen"):
        raise ValueError(f"unknown mode {mode!r}")
    observations = f"{table.rstrip('/')}.silver"

    def exact(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        rows = silver.clean_observations(batch).withColumn("ts_date", F.to_date("ts"))
        fresh = settled(silver.keep_latest(rows, SILVER_KEYS, "load_ts", SILVER_TIES), "fresh-rows")
        if fresh.isEmpty():
            return
        upsert_table(fresh, observations, SILVER_KEYS, "ts_date", newest="load_ts", ties=SILVER_TIES)
        touched = fresh.select("item_id", "ts_date").distinct()
        known = rows_of_days(spark.read.schema(fresh.schema).parquet(observations), touched, "ts_date")
        update_features(gold.daily_observations(known), table)

    def frozen(batch: DataFrame, _batch_id: int) -> None:
        update_features(gold.daily_observations(silver.dedup_latest(batch.drop("ts_date"))), table, frozen=True)

    stream = raw_stream
    if mode == "frozen":
        stream = after_closed_days(silver.clean_observations(raw_stream).withColumn("ts_date", F.to_date("ts")), "ts_date")
    return (
        stream.writeStream.foreachBatch(exact if mode == "exact" else frozen)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_daily_bars(raw_stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily bars, emitted once per day when the watermark has passed its end.

    Rows later than ``delay`` are ignored, as are all rows of a day already emitted.
    """
    both = F.col("avgHighPrice").isNotNull() & F.col("avgLowPrice").isNotNull()
    timed = (
        raw_stream.where(F.col("avgHighPrice").isNotNull())
        .withColumn("event_time", F.col("timestamp").cast("timestamp"))
        .withWatermark("event_time", delay)
    )
    bars = timed.groupBy("item_id", F.window("event_time", "1 day").alias("day")).agg(
        F.max(F.when(both, F.col("avgHighPrice"))).alias("high_price"),
        F.min(F.when(both, F.col("avgLowPrice"))).alias("low_price"),
        F.sum(F.when(both, S.gross_volume("highPriceVolume", "lowPriceVolume"))).alias("total_volume"),
        F.count_if(both).alias("data_points"),
        F.min(S.time_value_key("timestamp", "avgHighPrice")).alias("_open"),
        F.max(S.time_value_key("timestamp", "avgHighPrice")).alias("_close"),
    )
    return bars.where("data_points > 0").select(
        "item_id",
        F.to_date("day.start").alias("price_date"),
        "high_price",
        "low_price",
        "total_volume",
        "data_points",
        S.key_value("_open").alias("open_price"),
        S.key_value("_close").alias("close_price"),
    )


def first_arrivals(raw_stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """The first row per (item_id, timestamp); repeats within the delay are dropped."""
    timed = raw_stream.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(["item_id", "timestamp"]).drop("event_time")


def run_to_table(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Drain what is available into a Parquet table (append mode, exactly once)."""
    use_rocksdb(stream.sparkSession)
    query = (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is available and return the resulting table."""
    table = scratch_path(spark, name)
    run_to_table(stream, table, scratch_path(spark, f"{name}-offsets"))
    return spark.read.schema(stream.schema).parquet(table)
