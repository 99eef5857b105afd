"""Item id lists, name resolution and trade-limit discovery."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def id_frame(spark: SparkSession, ids: Iterable[int]) -> DataFrame:
    """Ids with their list position: (pos, item_id).

    An Arrow table becomes a local relation of known size, so Spark can tell a short
    list from a long one when it picks a join.
    """
    values = [int(v) for v in ids]
    return spark.createDataFrame(
        pa.table({"pos": pa.array(range(len(values)), pa.int64()), "item_id": pa.array(values, pa.int64())})
    )


def name_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    values = list(names)
    return spark.createDataFrame(
        pa.table({"pos": pa.array(range(len(values)), pa.int64()), "name": pa.array(values, pa.string())})
    )


def only_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose item is in ``ids``. Join strategy is left to the measured sizes."""
    return df.join(ids.select("item_id"), "item_id", "left_semi")


def without_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("item_id"), "item_id", "left_anti")


def _mapping_by_name(mapping: DataFrame) -> DataFrame:
    """One row per lower-cased name: how many items bear it and the smallest id.

    Aggregated before the join, so a name shared by very many items is one row there.
    """
    return mapping.groupBy(F.lower("name").alias("_key")).agg(
        F.count(F.lit(1)).alias("n_matches"), F.min("id").alias("item_id")
    )


def resolve_names(names: DataFrame, mapping: DataFrame, ambiguous: str = "skip") -> DataFrame:
    """Case-insensitive exact lookup of ``names(name, ...)`` in ``mapping(id, name)``.

    ``ambiguous='skip'`` trims the wanted name and drops names with several matches;
    ``'first'`` does not trim and takes the smallest id. Unknown names are dropped.
    """
    if ambiguous not in ("skip", "first"):
        raise ValueError(f"unknown mode {ambiguous!r}")
    key = F.lower(F.trim("name") if ambiguous == "skip" else F.col("name"))
    hits = names.withColumn("_key", key).join(_mapping_by_name(mapping), "_key")
    if ambiguous == "skip":
        hits = hits.where("n_matches = 1")
    return hits.drop("_key", "n_matches")


def resolve_name_list(
    names: Iterable[str], mapping: DataFrame, ambiguous: str = "skip"
) -> DataFrame:
    """:func:`resolve_names` for a configured list: the item table is cut down to the
    listed names by a broadcast semi join before it is aggregated."""
    wanted = name_frame(mapping.sparkSession, names)
    keys = wanted.select(F.lower(F.trim("name") if ambiguous == "skip" else F.col("name")).alias("_wanted"))
    near = mapping.join(keys, F.lower(mapping["name"]) == keys["_wanted"], "left_semi")
    return resolve_names(wanted, near, ambiguous)


def unresolved_names(names: DataFrame, mapping: DataFrame, ambiguous: str = "skip") -> DataFrame:
    """The names :func:`resolve_names` drops, with the reason."""
    key = F.lower(F.trim("name") if ambiguous == "skip" else F.col("name"))
    seen = names.withColumn("_key", key).join(_mapping_by_name(mapping), "_key", "left")
    reason = F.when(F.col("n_matches").isNull(), "unknown")
    if ambiguous == "skip":
        reason = reason.when(F.col("n_matches") > 1, "ambiguous")
    return seen.withColumn("reason", reason).where("reason IS NOT NULL").select(*names.columns, "reason")


def auto_discover(
    mapping: DataFrame, min_limit: int, members_only: bool | None = None, top_k: int = 10
) -> DataFrame:
    """The ``top_k`` items with the highest trade limit: (item_id, limit), best first."""
    hits = mapping.where(F.col("limit") >= min_limit)
    if members_only is not None:
        hits = hits.where(F.col("members") == members_only)
    return (
        hits.select(F.col("id").alias("item_id"), "limit")
        .orderBy(F.desc("limit"), "item_id")
        .limit(top_k)
    )
