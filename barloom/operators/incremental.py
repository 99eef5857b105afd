"""Incremental steps: high-water marks, append-new, upsert, and gold with history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators import gold, silver

DAILY_COLUMNS = [
    "item_id", "date", "min_price", "max_price", "total_volume", "observation_count",
    "latest_price_high", "latest_price_low",
]


def after_mark(value: Column, target: DataFrame, target_column: str) -> Column:
    """``value`` lies beyond the target's maximum. An empty target lets everything pass.

    The maximum is a scalar subquery, evaluated once and compared inside the scan.
    """
    mark = target.agg(F.max(target_column).alias("mark")).scalar()
    return mark.isNull() | (value > mark)


def incremental_silver(raw: DataFrame, target: DataFrame) -> DataFrame:
    """Silver rows from observations ingested after everything in ``target``.

    Late rows count: the mark is the ingest time, not the event time.
    """
    return silver.silver_timeseries(raw.where(after_mark(F.col("ingested_at"), target, "load_ts")))


def incremental_gold(silver_rows: DataFrame, target: DataFrame, mode: str = "context") -> DataFrame:
    """Gold rows for days after the target's last day; later rows of stored days are ignored.

    ``context`` computes windows over the stored days too, so a run equals a full
    rebuild for the new days. ``reference`` sees the new days only: their first return is
    NULL and the averages restart.
    """
    if mode not in ("context", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    day = F.to_date("ts")
    fresh = silver_rows.where(after_mark(day, target, "date"))
    if mode == "reference":
        return gold.gold_daily_features(fresh)
    return with_history(fresh, target)


def with_history(fresh: DataFrame, target: DataFrame) -> DataFrame:
    """Daily features of ``fresh`` rows, with the stored days of their items in the windows."""
    daily = gold.daily_observations(fresh).select(*DAILY_COLUMNS)
    active = daily.select("item_id").distinct()
    history = target.select(*DAILY_COLUMNS).join(active, "item_id", "left_semi")
    stacked = history.withColumn("_new", F.lit(False)).unionByName(daily.withColumn("_new", F.lit(True)))
    scored = gold.with_outlier_flag(gold.price_features(stacked))
    return scored.where("_new").select(*gold.GOLD_DAILY_COLUMNS)


def append_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], range_col: str | None = None
) -> DataFrame:
    """Incoming rows whose key is not stored yet. Repeats inside the batch are kept.

    Stored keys are made distinct before the join, so many copies of one key reach it as
    one row per map task. ``range_col`` names a key column (usually the time) whose range
    in the batch limits how much of the stored table is scanned.
    """
    if range_col is not None:
        span = incoming.agg(F.min(range_col).alias("lo"), F.max(range_col).alias("hi"))
        known = existing.where(
            (F.col(range_col) >= span.select("lo").scalar()) & (F.col(range_col) <= span.select("hi").scalar())
        )
    else:
        known = existing
    return incoming.join(known.select(*keys).distinct(), list(keys), "left_anti").select(*incoming.columns)


def one_per_key(df: DataFrame, keys: Sequence[str], newest: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: of repeats the one with the highest ``newest``, then ``ties``; without ``newest`` the highest
    in the order of the other columns. NULL keys are equal to each other."""
    if newest is None:
        rest = [c for c in df.columns if c not in keys]
        if not rest:
            return df.distinct()
        newest, ties = rest[0], rest[1:]
    return silver.keep_latest(df, keys, newest, ties)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows with the incoming ones in place of equal keys, NULLs being equal; one incoming row per key."""
    fresh = one_per_key(incoming, keys)
    return without_keys(existing, fresh, keys).select(*incoming.columns).unionByName(fresh)


def without_keys(existing: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``fresh``, NULLs being equal."""
    replaced = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return existing.join(replaced, same, "left_anti")


def upsert_backtest(existing: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Replace backtest rows by (item_id, date, method).

    Of repeats in the incoming batch the one with the highest ``order`` value wins, by
    default the one of the highest other values.
    """
    keys = ["item_id", "date", "method"]
    if order is not None:
        incoming = silver.keep_latest(incoming, keys, order, ["window_size", "horizon"])
    return upsert(existing, incoming, keys)
