"""The whole refresh: raw tables to stored layers, selection, backtest and leaderboard.

Every layer is written once and read back, so later steps scan stored columns instead of
recomputing the raw data, and a lost executor costs one layer at most.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import backtest, bronze, gold, quality, selection, serving, silver
from barloom.schema import CATEGORY_LADDER, SelectionConfig
from barloom.sinks.tables import replace_table, write_selection


@dataclass(frozen=True)
class RefreshConfig:
    """Parameters of a refresh run: all items, origins and methods unless fewer are asked for. ``stamp`` adds the wall-clock load time to the layers."""

    as_of: dt.date | str
    selection: SelectionConfig = SelectionConfig()
    selection_mode: str = "hybrid"
    force_include: bool = True
    methods: Sequence[str] = backtest.METHODS
    window: int = 28
    horizon: int = 1
    max_splits: int | None = None
    keep: str = "latest"
    selected_only: bool = False
    stamp: bool = False
    ladder: Sequence[tuple[str, Sequence[str]]] = CATEGORY_LADDER


#: How each stored layer is clustered. Ranges over (item, time) split a hot item, and
#: item-days that lie together collapse in the map-side aggregates of the next layer.
#: Bronze keeps the landing layout: nothing downstream reads it by item, so a shuffle of
#: the raw rows would buy nothing.
CLUSTERING = {
    "silver_timeseries": ("item_id", "ts"),
    "silver_prices_daily": ("item_id", "price_date"),
    "gold_daily_features": ("item_id", "date"),
    "gold_price_features": ("item_id", "price_date"),
    "gold_backtest_metrics": ("item_id", "date"),
}


#: Tables whose checks are declared under another name.
CHECKED = {"bronze_item_mapping": "item_mapping"}


def refresh(
    spark: SparkSession, raw: DataFrame, items: DataFrame, warehouse: str, config: RefreshConfig,
    report: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Build every layer below ``warehouse`` and return the stored tables by name.

    The row checks of a layer are counted by the job that writes it; ``report`` takes the counts by table.
    """
    root = warehouse.rstrip("/")
    tables: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        if config.stamp and name.startswith(("bronze_", "silver_", "gold_")):
            df = bronze.stamped(df, "timestamp" if name == "gold_backtest_metrics" else "dbt_updated_at")
        counts = replace_table(df, path, CLUSTERING.get(name, ()), checks=quality.LAYER_CHECKS.get(CHECKED.get(name, name)))
        if counts and report is not None:
            report[name] = counts
        tables[name] = spark.read.parquet(path)
        return tables[name]

    as_of_ts = f"{config.as_of} 00:00:00"
    item_table = store("bronze_item_mapping", bronze.bronze_items(quality.validated_items(items)))
    store("bronze_timeseries", bronze.bronze_timeseries(raw))
    attrs = store("silver_items", silver.silver_items(item_table, config.ladder))
    observations = store("silver_timeseries", silver.silver_timeseries(raw))
    bars = store("silver_prices_daily", silver.silver_prices_daily(raw))
    features = store("gold_daily_features", gold.gold_daily_features(observations))
    metrics = store("gold_item_metrics", gold.gold_item_metrics(bars, attrs, config.as_of))
    store("gold_price_features", gold.gold_price_features(bars))

    stats = store(
        "item_statistics",
        selection.item_statistics(observations, item_table, config.selection.lookback_days, as_of_ts),
    )
    chosen = store(
        "items_selected",
        selection.select_items(stats, item_table, config.selection, config.selection_mode, config.force_include),
    )
    write_selection(chosen, f"{root}/items_selected_json")

    series = gold.price_series(features, bars)
    if config.selected_only:
        series = series.join(chosen.select(F.col("id").alias("item_id")), "item_id", "left_semi")
    scores = store(
        "gold_backtest_metrics",
        backtest.backtest_scores(
            series, config.methods, config.window, config.horizon, config.max_splits, config.keep
        ),
    )
    store("leaderboard", serving.leaderboard(scores, item_table, "30d", as_of_ts))
    store("predictions", serving.predict_batch(features, metrics))
    return tables


def check(tables: dict[str, DataFrame], warehouse: str) -> dict[str, dict[str, int]]:
    """Run the declared checks on the stored tables and keep the failing rows."""
    known = dict(tables)
    if "bronze_item_mapping" in known:
        known["item_mapping"] = known["bronze_item_mapping"]
    return quality.check_layers(known, f"{warehouse.rstrip('/')}/check_failures")
