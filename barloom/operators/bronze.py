"""Bronze layer: renames and key checks over landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_items(items: DataFrame) -> DataFrame:
    return items.select("id", "name", "examine", "members", "lowalch", "highalch", "limit")


def bronze_timeseries(raw: DataFrame) -> DataFrame:
    """Rows with both key parts present, in snake case."""
    return raw.where(F.col("timestamp").isNotNull() & F.col("item_id").isNotNull()).select(
        "timestamp",
        "item_id",
        F.col("avgHighPrice").alias("avg_high_price"),
        F.col("avgLowPrice").alias("avg_low_price"),
        F.col("highPriceVolume").alias("high_price_volume"),
        F.col("lowPriceVolume").alias("low_price_volume"),
        "ingested_at",
    )


def landed_names(bronze: DataFrame) -> DataFrame:
    """Stored rows under the names they were landed with; further columns stay."""
    return bronze.withColumnsRenamed({
        "avg_high_price": "avgHighPrice", "avg_low_price": "avgLowPrice", "high_price_volume": "highPriceVolume",
        "low_price_volume": "lowPriceVolume"})


def stamped(df: DataFrame, column: str = "dbt_updated_at") -> DataFrame:
    """Add the wall-clock load stamp that stored layers carry."""
    return df.withColumn(column, F.current_timestamp())
