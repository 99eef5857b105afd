"""Silver layer: item attributes, cleaned observations and daily bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import scalar as S
from barloom.schema import CATEGORY_DEFAULT, CATEGORY_LADDER

PRICE_SOURCE = "price_api"


def silver_items(
    items: DataFrame,
    ladder: Sequence[tuple[str, Sequence[str]]] = CATEGORY_LADDER,
    default: str = CATEGORY_DEFAULT,
) -> DataFrame:
    """Item attributes with membership label, alchemy margin and a name-based category."""
    return items.select(
        F.col("id").alias("item_id"),
        "name",
        "examine",
        "members",
        F.col("lowalch").alias("low_alch_value"),
        F.col("highalch").alias("high_alch_value"),
        F.col("limit").alias("trade_limit"),
        F.when(F.col("members"), "Members").otherwise("Free-to-Play").alias("membership_type"),
        F.when(F.col("highalch") > 0, F.col("highalch") - F.col("lowalch")).alias("alch_profit_potential"),
        S.label_ladder("name", ladder, default).alias("item_category"),
    )


def _observed(raw: DataFrame) -> DataFrame:
    """Negative prices become NULL and both volumes add up."""
    return raw.select(
        "item_id",
        F.col("timestamp").alias("ts"),
        S.non_negative("avgHighPrice").alias("price_avg_high"),
        S.non_negative("avgLowPrice").alias("price_avg_low"),
        S.traded_volume("highPriceVolume", "lowPriceVolume").alias("volume"),
        F.col("ingested_at").alias("load_ts"),
    )


def _named(observed: DataFrame, source: str) -> DataFrame:
    """The stored layout: the feed reports averages only, which stand in for high and low."""
    return observed.select(
        "item_id",
        "ts",
        F.col("price_avg_high").alias("price_high"),
        F.col("price_avg_low").alias("price_low"),
        "price_avg_high",
        "price_avg_low",
        "volume",
        F.lit(source).alias("source"),
        "load_ts",
    )


def clean_observations(raw: DataFrame, source: str = PRICE_SOURCE) -> DataFrame:
    """Sanitised observations in the stored layout, repeats included."""
    return _named(_observed(raw), source)


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest, ties settled by the highest remaining columns.

    ``row_number() = 1`` lets Spark put a group limit on both sides of the shuffle, so a
    key with very many copies leaves each map task as a single row.
    """
    order = [F.desc_nulls_last(newest), *[F.desc_nulls_last(c) for c in ties]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def silver_timeseries(raw: DataFrame, source: str = PRICE_SOURCE) -> DataFrame:
    """Cleaned observations, one per (item_id, ts): the most recently loaded.

    The repeated and constant columns are added after the shuffle.
    """
    return _named(dedup_latest(_observed(raw)), source)


def dedup_latest(clean: DataFrame) -> DataFrame:
    # the instant first: it tells rows of one hot item apart in the leading sort key
    return keep_latest(clean, ["ts", "item_id"], "load_ts", ["price_avg_high", "price_avg_low", "volume"])


def daily_bars(raw: DataFrame) -> DataFrame:
    """One row per item and day: range, volume, count and open/close.

    Range, mean, volume and count use rows that have both prices; open and close use
    every row with a high price. A day needs at least one row with both prices. All of it
    is one aggregate over one scan, partially combined before the shuffle, so a day or
    item holding much of the data reaches the reducer as one row per map task.
    """
    both = F.col("avgHighPrice").isNotNull() & F.col("avgLowPrice").isNotNull()

    def paired(c: str):
        return F.when(both, F.col(c))

    narrow = raw.where(F.col("avgHighPrice").isNotNull()).select(
        F.to_date("timestamp").alias("price_date"),
        "item_id",
        F.when(both, F.lit(1)).alias("paired"),
        paired("avgHighPrice").alias("high"),
        paired("avgLowPrice").alias("low"),
        F.when(both, S.gross_volume("highPriceVolume", "lowPriceVolume")).alias("vol"),
        paired("timestamp").alias("paired_ts"),
        S.time_value_key("timestamp", "avgHighPrice").alias("tick"),
    )
    return (
        narrow.groupBy("item_id", "price_date")
        .agg(
            F.max("high").alias("high_price"),
            F.min("low").alias("low_price"),
            F.avg("high").alias("avg_price"),
            F.sum("vol").alias("total_volume"),
            F.count("paired").alias("data_points"),
            F.min("paired_ts").alias("first_timestamp"),
            F.max("paired_ts").alias("last_timestamp"),
            F.min("tick").alias("_open"),
            F.max("tick").alias("_close"),
        )
        .where("data_points > 0")
        .withColumn("open_price", S.key_value("_open"))
        .withColumn("close_price", S.key_value("_close"))
        .drop("_open", "_close")
    )


def series_window(date_col: str):
    """Rows of one item in date order. After daily aggregation an item has at most one
    row per calendar day, so the partition is bounded however many raw rows it had."""
    return Window.partitionBy("item_id").orderBy(date_col)


def with_price_change(bars: DataFrame, price: str = "close_price", date_col: str = "price_date") -> DataFrame:
    w = series_window(date_col)
    return bars.withColumn("price_change", F.col(price) - F.lag(price, 1).over(w))


def with_moving_average(df: DataFrame, value: str, days: int, out: str, date_col: str = "price_date") -> DataFrame:
    """Mean of the last ``days`` rows; early rows average what there is."""
    w = series_window(date_col).rowsBetween(-(days - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))


def with_rolling_volatility(df: DataFrame, value: str, days: int, out: str, date_col: str = "price_date") -> DataFrame:
    """Sample standard deviation of the last ``days`` rows, NULL for a single row."""
    w = series_window(date_col).rowsBetween(-(days - 1), 0)
    return df.withColumn(out, F.stddev_samp(value).over(w))


DAILY_PRICE_COLUMNS = [
    "price_date", "item_id", "high_price", "low_price", "avg_price", "total_volume", "data_points",
    "first_timestamp", "last_timestamp", "open_price", "close_price", "price_change", "ma_7d", "volatility_7d",
]


def with_indicators(bars: DataFrame) -> DataFrame:
    """Change, 7-day mean and 7-day volatility of the close."""
    out = with_price_change(bars)
    out = with_moving_average(out, "close_price", 7, "ma_7d")
    return with_rolling_volatility(out, "close_price", 7, "volatility_7d")


def silver_prices_daily(raw: DataFrame) -> DataFrame:
    """Daily bars with their indicators."""
    return with_indicators(daily_bars(raw)).select(*DAILY_PRICE_COLUMNS)
