"""Item statistics, ranked selection and the ingestion target list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import scalar as S
from barloom.operators import lookup
from barloom.operators.gold import join_items
from barloom.schema import IngestConfig, SelectionConfig

SEED_SOURCE = 9


def as_instant(as_of: dt.datetime | str | None) -> Column:
    """``as_of`` as a zone-free UTC timestamp, the current time when not given."""
    return F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")


def days_before(as_of: dt.datetime | str | None, days: int) -> Column:
    return as_instant(as_of) - F.make_dt_interval(F.lit(days))


def item_statistics(
    silver: DataFrame,
    items: DataFrame,
    lookback_days: int = 365,
    as_of: dt.datetime | str | None = None,
    min_active_days: int = 5,
) -> DataFrame:
    """Liquidity, coverage and price statistics per item over the look-back period.

    Only observations with a positive volume count. The time filter reaches the scan; the
    first aggregate shrinks rows to item-days, the second sees at most ``lookback_days``
    values per item, which bounds the exact medians.
    """
    recent = silver.where((F.col("ts") >= days_before(as_of, lookback_days)) & (F.col("volume") > 0))
    return _statistics(item_days(recent), items, lookback_days, min_active_days)


def item_days(silver: DataFrame) -> DataFrame:
    """Traded units, observations and mean price per item and day, of observations with a positive volume.

    A day without any has NULLs and the count 0: in a stored roll-up it replaces what the day had before.
    """
    traded = F.col("volume") > 0
    return silver.groupBy("item_id", F.to_date("ts").alias("trade_date")).agg(
        F.sum(F.when(traded, F.col("volume").cast("double"))).alias("units"),
        F.count_if(traded).alias("observations"),
        F.avg(F.when(traded, S.midpoint("price_avg_high", "price_avg_low"))).alias("price"),
    )


def statistics_of_days(
    days: DataFrame,
    items: DataFrame,
    lookback_days: int = 365,
    as_of: dt.datetime | str | None = None,
    min_active_days: int = 5,
) -> DataFrame:
    """:func:`item_statistics` from a roll-up of :func:`item_days`. ``as_of`` counts as the beginning of its day."""
    first = F.to_date(days_before(as_of, lookback_days))
    return _statistics(days.where((F.col("trade_date") >= first) & (F.col("observations") > 0)), items, lookback_days, min_active_days)


def _statistics(daily: DataFrame, items: DataFrame, lookback_days: int, min_active_days: int) -> DataFrame:
    per_item = (
        daily.groupBy("item_id")
        .agg(
            F.median("units").alias("median_units_per_day"),
            F.avg("units").alias("avg_units_per_day"),
            F.sum("units").alias("total_units"),
            F.median("price").alias("median_price"),
            F.count(F.lit(1)).alias("days_with_data"),
            F.avg("price").alias("avg_price"),
            F.stddev_samp("price").alias("price_volatility"),
            F.avg("observations").alias("avg_obs_per_day"),
            F.max("trade_date").alias("last_trade_date"),
        )
        .where(F.col("days_with_data") >= min_active_days)
    )
    coverage = F.col("days_with_data") * F.lit(100.0) / F.lit(float(lookback_days))
    return join_items(per_item, items, ["name"], item_key="id").select(
        "item_id", "name", "median_units_per_day", "avg_units_per_day", "total_units", "median_price",
        "days_with_data", F.lit(lookback_days).alias("total_possible_days"), coverage.alias("coverage_pct"),
        "avg_price", "price_volatility", "avg_obs_per_day", "last_trade_date",
        (F.col("median_units_per_day") * F.col("median_price")).alias("median_turnover_gp"),
        (F.log10(F.col("median_units_per_day") + 1) * coverage / F.lit(100.0)).alias("ranking_score"),
    )


def _override_ids(stats: DataFrame, mapping: DataFrame, ids: tuple[int, ...], names: tuple[str, ...]) -> DataFrame:
    spark = stats.sparkSession
    out = lookup.id_frame(spark, ids).select("item_id")
    if names:
        named = lookup.resolve_name_list(names, mapping.select("id", "name"), "skip")
        out = out.unionByName(named.select("item_id"))
    return out.distinct()


def select_items(
    stats: DataFrame,
    mapping: DataFrame,
    config: SelectionConfig,
    mode: str = "auto",
    force_include: bool = False,
) -> DataFrame:
    """Selected items with the reason, to be ordered by ``ranking_score``.

    * ``auto``: best ``top_n`` items past the day, coverage and volume gates.
    * ``hybrid``: those plus the manual includes past the same gates; ``force_include``
      waives the volume gate for them.
    * ``manual``: the manual includes past the day and coverage gates.

    Excluded items never appear. A manual include is labelled so in every mode, also when
    the ranking picked it.
    """
    if mode not in ("auto", "hybrid", "manual"):
        raise ValueError(f"unknown mode {mode!r}")
    manual = _override_ids(stats, mapping, config.include_ids, config.include_names)
    excluded = _override_ids(stats, mapping, config.exclude_ids, config.exclude_names)
    base = lookup.without_ids(stats, excluded).where(
        (F.col("days_with_data") >= config.min_days) & (F.col("coverage_pct") >= config.min_coverage_pct)
    )
    flagged = base.join(manual.withColumn("_manual", F.lit(True)), "item_id", "left")
    by_hand = F.coalesce(F.col("_manual"), F.lit(False))
    liquid = F.col("median_units_per_day") >= config.min_volume
    best_first = [F.desc("ranking_score"), F.asc("item_id")]
    if mode == "manual":
        chosen = flagged.where(by_hand)
    elif mode == "auto":
        chosen = flagged.where(liquid).orderBy(*best_first).limit(config.top_n)
    else:
        # One pass over the statistics: every manual include and the best of the rest are
        # at most n_manual + top_n rows; the ranking is then settled among those few.
        n_manual = len(config.include_ids) + len(config.include_names)
        pool = flagged.where(liquid | by_hand if force_include else liquid)
        short = pool.orderBy(by_hand.desc(), *best_first).limit(config.top_n + n_manual)
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(liquid.desc(), *best_first))
        chosen = short.withColumn("_place", place).where(by_hand | (liquid & (F.col("_place") <= config.top_n)))
    return chosen.select(
        F.col("item_id").alias("id"),
        "name",
        "median_units_per_day",
        "median_price",
        "median_turnover_gp",
        F.col("coverage_pct").alias("coverage"),
        "days_with_data",
        "avg_price",
        "ranking_score",
        "last_trade_date",
        F.when(F.col("_manual"), "manual_include").otherwise("auto_selected").alias("selection_reason"),
    )


def ranked(selection: DataFrame) -> DataFrame:
    return selection.orderBy(F.desc("ranking_score"), "id")


def selection_summary(selection: DataFrame) -> DataFrame:
    reason = F.col("selection_reason")
    return selection.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(reason == "auto_selected").alias("auto_selected"),
        F.count_if(reason == "manual_include").alias("manual_include"),
        F.min("median_units_per_day").alias("min_units"),
        F.max("median_units_per_day").alias("max_units"),
        F.min("median_turnover_gp").alias("min_turnover"),
        F.max("median_turnover_gp").alias("max_turnover"),
        F.min("coverage").alias("min_coverage"),
        F.max("coverage").alias("max_coverage"),
    )


def ingest_targets(mapping: DataFrame, config: IngestConfig, selected: DataFrame | None = None) -> DataFrame:
    """Items to ingest, in order: (rank_source, rank_pos, item_id). ``selected`` is (item_id, pos).

    Sources by priority: the current selection (in its own order), listed ids, listed
    names (first match), discovered items. An item keeps its best place; excludes are
    removed; a given ``max_items`` cuts the rest. When nothing remains the seed list is used.
    """
    spark = mapping.sparkSession
    names = mapping.select("id", "name")

    def placed(df: DataFrame, source: int, pos: Column) -> DataFrame:
        return df.select(F.lit(source).alias("rank_source"), pos.cast("double").alias("rank_pos"), "item_id")

    def by_name(wanted: tuple[str, ...]) -> DataFrame:
        return lookup.resolve_name_list(wanted, names, "first")

    parts = [placed(lookup.id_frame(spark, config.include_ids), 1, F.col("pos"))]
    if selected is not None:
        parts.append(placed(selected, 0, F.col("pos")))
    if config.include_names:
        parts.append(placed(by_name(config.include_names), 2, F.col("pos")))
    if config.discover.enabled:
        d = config.discover
        found = lookup.auto_discover(mapping, d.min_limit, d.members_only, d.top_k)
        parts.append(placed(found, 3, -F.col("limit")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    excluded = lookup.id_frame(spark, config.exclude_ids).select("item_id")
    if config.exclude_names:
        excluded = excluded.unionByName(by_name(config.exclude_names).select("item_id"))
    seeds = placed(lookup.id_frame(spark, config.seed_ids), SEED_SOURCE, F.col("pos"))
    kept = (
        lookup.without_ids(union, excluded)
        .groupBy("item_id")
        .agg(F.min(F.struct("rank_source", "rank_pos")).alias("place"))
        .select("place.rank_source", "place.rank_pos", "item_id")
    )
    if config.max_items is not None:
        kept = kept.orderBy("rank_source", "rank_pos", "item_id").limit(config.max_items)
    # the seeds count only where nothing else is left
    left = kept.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kept.unionByName(seeds.where(left == 0).select("rank_source", "rank_pos", "item_id"))


def selected_positions(selection: DataFrame) -> DataFrame:
    """A selection as (item_id, pos) for :func:`ingest_targets`, best score first."""
    return selection.select(F.col("id").alias("item_id"), (-F.col("ranking_score")).alias("pos"))
