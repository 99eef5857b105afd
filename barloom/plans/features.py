"""Daily features kept up to date in a stored table, day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import moments
from barloom.sinks.tables import recover, stored, upsert_table


def states_path(table: str) -> str:
    return f"{table.rstrip('/')}.items"


def rows_of_days(table: DataFrame, touched: DataFrame, day: str) -> DataFrame:
    """Rows of ``table`` for the (item_id, ``day``) pairs in ``touched``. Folders of other days are not read: the list of
    days, bounded by the calendar, is part of the scan's filter."""
    days = [r[0] for r in touched.select(day).distinct().collect()]
    return table.where(F.col(day).isin([d for d in days if d is not None])).join(touched, ["item_id", day], "left_semi")


def update_features(changed: DataFrame, table: str, frozen: bool = False) -> None:
    """Bring the features at ``table``, partitioned by date, up to date with the daily observations ``changed``.

    Features first, states last: a run that stops in between finds old states and writes the same features again. A
    run that is repeated after both finds its days stored and computes its items from their stored days, with the same result.
    """
    spark: SparkSession = changed.sparkSession
    recover(spark, table, "date")
    recover(spark, states_path(table), "bucket")
    rows, states = moments.advance(changed, stored(spark, states_path(table)), stored(spark, table), frozen)
    # the states hang on tables of their own only, not on the features that are replaced first
    upsert_table(rows, table, ["item_id", "date"], "date")
    upsert_table(states, states_path(table), ["item_id"], "bucket")
