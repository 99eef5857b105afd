"""Gold layer: daily features with outlier flags, item metrics, model features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import scalar as S
from barloom.operators.silver import series_window, with_moving_average

OUTLIER_ZSCORE = 2.5
OUTLIER_SPREAD = 0.5


def as_date(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def daily_observations(silver: DataFrame) -> DataFrame:
    """Per item and day: aggregates plus the prices of the day's last observation.

    The last observation keeps its NULLs. ``silver`` holds one row per (item_id, ts), so
    the instant alone orders a day and every buffer is fixed-width: one HashAggregate,
    combined before the shuffle.
    """
    return silver.groupBy("item_id", F.to_date("ts").alias("date")).agg(
        F.avg("price_avg_high").alias("avg_price_high"),
        F.avg("price_avg_low").alias("avg_price_low"),
        F.min("price_avg_low").alias("min_price"),
        F.max("price_avg_high").alias("max_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("observation_count"),
        F.max_by("price_avg_high", "ts").alias("latest_price_high"),
        F.max_by("price_avg_low", "ts").alias("latest_price_low"),
    )


def daily_latest(silver: DataFrame) -> DataFrame:
    return daily_observations(silver).select("item_id", "date", "latest_price_high", "latest_price_low")


def with_daily_return(daily: DataFrame) -> DataFrame:
    """Price over the previous row's price, minus one; NULL after a zero price."""
    previous = F.lag("latest_price", 1).over(series_window("date"))
    return daily.withColumn("daily_return", F.try_divide(F.col("latest_price"), previous) - F.lit(1.0))


def with_return_zscore(daily: DataFrame) -> DataFrame:
    """Distance of a return from the item's mean return, in sample deviations."""
    item = Window.partitionBy("item_id")
    r = F.col("daily_return")
    z = F.abs(F.try_divide(r - F.avg("daily_return").over(item), F.stddev_samp("daily_return").over(item)))
    return daily.withColumn("return_zscore", z)


def with_outlier_flag(daily: DataFrame, zscore: float = OUTLIER_ZSCORE, spread: float = OUTLIER_SPREAD) -> DataFrame:
    hit = (F.col("return_zscore") > zscore) | (F.col("volatility_proxy") > spread)
    return daily.withColumn("is_outlier", F.coalesce(hit, F.lit(False)))


def price_paths(daily: DataFrame) -> DataFrame:
    """Midpoint price, spread, 7-day mean and return over daily rows."""
    out = daily.withColumn("latest_price", S.midpoint("latest_price_high", "latest_price_low"))
    out = out.withColumn("volatility_proxy", S.relative_spread("latest_price_high", "latest_price_low"))
    out = with_moving_average(out, "latest_price", 7, "price_7d_ma", "date")
    return with_daily_return(out)


def price_features(daily: DataFrame) -> DataFrame:
    """:func:`price_paths` and the z-score of the return.

    All windows partition by item, so one shuffle and one sort serve them all.
    """
    return with_return_zscore(price_paths(daily))


GOLD_DAILY_COLUMNS = [
    "item_id", "date", "latest_price", "latest_price_high", "latest_price_low", "price_7d_ma", "daily_return",
    "volatility_proxy", "is_outlier", "total_volume", "observation_count", "min_price", "max_price",
]


def gold_daily_features(silver: DataFrame, zscore: float = OUTLIER_ZSCORE, spread: float = OUTLIER_SPREAD) -> DataFrame:
    scored = price_features(daily_observations(silver))
    return with_outlier_flag(scored, zscore, spread).select(*GOLD_DAILY_COLUMNS)


def gold_item_metrics(
    bars: DataFrame, items: DataFrame, as_of: dt.date | str | None = None, days: int = 30
) -> DataFrame:
    """Statistics of each item's last ``days`` days, with name and quality labels.

    Aggregates first and joins the item attributes to the one-row-per-item result, so the
    join moves item rows, not price rows. ``items`` must be unique on ``item_id``.
    """
    recent = bars.where(F.col("price_date") >= F.date_sub(as_date(as_of), days))
    stats = recent.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("trading_days_30d"),
        F.avg("close_price").alias("avg_price_30d"),
        F.stddev_samp("close_price").alias("price_volatility_30d"),
        F.min("close_price").alias("min_price_30d"),
        F.max("close_price").alias("max_price_30d"),
        F.avg("total_volume").alias("avg_volume_30d"),
        F.sum("total_volume").alias("total_volume_30d"),
        F.max_by("close_price", "price_date").alias("latest_price"),
        F.max("price_date").alias("latest_date"),
        F.min_by("close_price", "price_date").alias("_first"),
    )
    change = (F.col("latest_price") - F.col("_first")) / F.nullif(F.col("_first"), F.lit(0)) * F.lit(100)
    quality = S.band(F.col("trading_days_30d"), [(20, "High"), (10, "Medium")], "Low")
    suitable = (F.col("trading_days_30d") >= 15) & (F.col("avg_volume_30d") > 100)
    return join_items(stats, items, ["name", "item_category", "membership_type"]).select(
        "item_id", "name", "item_category", "membership_type", "trading_days_30d", "avg_price_30d",
        "price_volatility_30d", "min_price_30d", "max_price_30d", "avg_volume_30d", "total_volume_30d",
        "latest_price", "latest_date",
        change.alias("price_change_pct_30d"),
        quality.alias("data_quality"),
        F.coalesce(suitable, F.lit(False)).alias("suitable_for_forecasting"),
    )


def join_items(facts: DataFrame, items: DataFrame, attributes: list[str], item_key: str = "item_id") -> DataFrame:
    """Inner join on the item key.

    No broadcast hint: Spark broadcasts the item table while it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, with AQE
    splitting skewed keys.
    """
    dim = items.select(F.col(item_key).alias("item_id"), *attributes)
    return facts.join(dim, "item_id")


def gold_price_features(bars: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lags, moving averages, ratios, calendar angles and the next day's price.

    Keeps rows that have a previous and a next day, and the further columns named in ``keep``.
    """
    w = series_window("price_date")
    last7, last14 = w.rowsBetween(-6, 0), w.rowsBetween(-13, 0)
    close = F.col("close_price")
    lags = {f"price_lag_{n}d": F.lag("close_price", n).over(w) for n in (1, 2, 3, 7)}
    seen = bars.select(
        "price_date", "item_id", "close_price", "ma_7d", "total_volume", "volatility_7d", *keep,
        *[c.alias(name) for name, c in lags.items()],
        F.lead("close_price", 1).over(w).alias("target_price_1d"),
        F.lag("total_volume", 1).over(w).alias("volume_lag_1d"),
        F.avg("close_price").over(last14).alias("ma_14d"),
        F.avg("total_volume").over(last7).alias("volume_ma_7d"),
    ).where("price_lag_1d IS NOT NULL AND target_price_1d IS NOT NULL")
    lag3 = F.col("price_lag_3d")
    ratio = close / F.nullif(F.col("ma_7d"), F.lit(0))
    angle = S.weekday_angle("price_date")
    return seen.select(
        "price_date", "item_id", "close_price", "target_price_1d",
        *lags, "ma_7d", "ma_14d",
        ratio.alias("price_to_ma7_ratio"),
        "total_volume", "volume_lag_1d", "volume_ma_7d", "volatility_7d",
        (F.lit(100.0) * F.col("volatility_7d") / F.nullif(close, F.lit(0))).alias("volatility_pct"),
        ((close - lag3) / F.nullif(lag3, F.lit(0))).alias("momentum_3d"),
        F.sin(angle).alias("day_of_week_sin"),
        F.cos(angle).alias("day_of_week_cos"),
        (F.col("price_lag_1d").cast("double") * F.col("volume_lag_1d")).alias("price_volume_interaction"),
        S.trend_signal(close, F.col("ma_7d")).alias("trend_signal"),
        *keep,
    )


def scan_item_series(
    table: DataFrame, price: str, date_col: str = "price_date", item_ids: list[int] | None = None
) -> DataFrame:
    """(item_id, date, price) of the named items, or of all. The id predicate reaches the scan."""
    if item_ids is not None:
        table = table.where(F.col("item_id").isin(list(item_ids)))
    return table.select("item_id", F.col(date_col).alias("date"), F.col(price).cast("double").alias("price"))


def price_series(daily_features: DataFrame, bars: DataFrame) -> DataFrame:
    """Backtest input: midpoint prices, or closes for items without any feature row.

    Both sources are stacked and each item keeps its preferred one. The window uses the
    item partitioning that every later series window needs anyway, which saves the
    distinct and the anti join of the two-step form.
    """
    stacked = scan_item_series(daily_features, "latest_price", "date").withColumn("_rank", F.lit(0)).unionByName(
        scan_item_series(bars, "close_price").withColumn("_rank", F.lit(1))
    )
    best = F.min("_rank").over(Window.partitionBy("item_id"))
    return stacked.withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")
