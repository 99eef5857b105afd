"""Raw market tables derived from the star-schema and event tables of a data directory.

Each function reads whole tables and is narrow (no shuffle), so the derived data grows
with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is inferred once per path, since inference is a Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def prices_from_events(events: DataFrame) -> DataFrame:
    """Observations with one-sided, missing, zero and negative values and late copies.

    Every 20th event also arrives a day later with a corrected price; the second copy
    comes from an explode, so the events are scanned once.
    """
    return events.selectExpr(
        "event_id",
        "ts AS timestamp",
        "user_id + 1 AS item_id",
        """CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 211 = 0 THEN 0L
                ELSE CAST(floor(value * 100) AS BIGINT) + 1000 END AS high""",
        """CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 211 = 0 THEN 0L
                WHEN event_id % 97 = 0 THEN -1L ELSE CAST(floor(value * 95) AS BIGINT) + 900 END AS avgLowPrice""",
        """CASE WHEN event_type <> 'view' THEN try_cast(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END
           AS highPriceVolume""",
        "CASE WHEN event_type NOT IN ('view', 'click') THEN event_id % 40 END AS lowPriceVolume",
        "ts + INTERVAL '1' HOUR * CAST(event_id % 5 AS INT) AS ingested",
        "explode(IF(event_id % 20 = 0, array(0, 1), array(0))) AS copy",
    ).selectExpr(
        "event_id", "timestamp", "high + 7 * copy AS avgHighPrice", "avgLowPrice", "highPriceVolume",
        "lowPriceVolume", "item_id", "ingested + INTERVAL '1' DAY * copy AS ingested_at",
    )


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices_from_events(table(spark, sf_dir, "events"))


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey + 1 AS id",
        "concat(p_name, ' ', p_partkey) AS name",
        "p_type AS examine",
        "p_size % 2 = 0 AS members",
        "CASE WHEN p_size % 7 <> 0 THEN CAST(floor(p_retailprice * 0.4D) AS BIGINT) END AS lowalch",
        "CASE WHEN p_size % 11 = 0 THEN 0L ELSE CAST(floor(p_retailprice * 0.6D) AS BIGINT) END AS highalch",
        "CAST(p_size AS BIGINT) * 500 AS `limit`",
    )


def named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item mapping with the repeated plain part names, for ambiguous lookups."""
    return table(spark, sf_dir, "part").select((F.col("p_partkey") + 1).alias("id"), F.col("p_name").alias("name"))


def supplier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average unit price per supplier and ship day: a long daily history.

    Amounts are summed in cents, which is exact in any order.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy(F.col("l_suppkey").alias("item_id"), F.to_date("l_shipdate").alias("date")).agg(
        (F.sum(cents).cast("double") / (F.sum("l_quantity") * F.lit(100.0))).alias("price")
    )
