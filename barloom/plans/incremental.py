"""The refresh in runs: each covers what was loaded since the last one, and every layer follows what the run touched.

Landed rows are stored by run and day. A run reads again the days it touches, not the others; layers with windows are
computed for the touched items from tables of one row per item and day, and only rows whose window holds a touched
day are written; backtests score the origins whose training or test days are touched. The result equals one full load,
however the rows are spread over the runs.

The ledger names the rows of a run before anything is written and each layer once it is stored. Every layer may be written
twice: folders of a run are replaced, tables are upserted by key. So a run that stops is finished by the next call, a
call without new rows does nothing but read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.operators import backtest, bronze, gold, quality, selection, serving, silver
from barloom.plans.features import rows_of_days, update_features
from barloom.plans.ledger import FINISHED, Ledger, Run, rows_of
from barloom.plans.pipeline import RefreshConfig
from barloom.session import settled
from barloom.sinks.tables import recover, replace_table, stored, upsert_table, write_selection

#: Tables kept by upserts: their keys, and the day they are stored by.
KEPT = {
    "silver_timeseries": (["ts", "item_id"], "ts_date"),
    "daily_bars": (["item_id", "price_date"], "price_date"),
    "silver_prices_daily": (["item_id", "price_date"], "price_date"),
    "gold_price_features": (["item_id", "price_date"], "price_date"),
    "item_days": (["item_id", "trade_date"], "trade_date"),
    "backtest_origins": (["item_id", "date", "method"], "date"),
}
#: Rows before and after a touched day that see it in their windows.
INDICATORS, MODEL_FEATURES = (6, 0), (13, 1)


def near_touched(day: str, before: int, after: int):
    """Whether a row's window of ``before`` and ``after`` rows of its item holds a touched day."""
    w = Window.partitionBy("item_id").orderBy(day).rowsBetween(-before, after)
    return F.max("_touched").over(w)


class Refresh:
    """One run over the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, config: RefreshConfig, items: DataFrame):
        if config.selected_only or config.max_splits is not None or config.stamp:
            raise ValueError("runs score all items and origins and carry no wall-clock stamps; use pipeline.refresh")
        self.spark, self.root, self.config, self.items = spark, root.rstrip("/"), config, items
        self.as_of = f"{config.as_of} 00:00:00"
        self._touched: DataFrame | None = None

    # ---- tables ----

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def upsert(self, name: str, rows: DataFrame, **order) -> None:
        keys, day = KEPT[name]
        upsert_table(rows, self.path(name), keys, day, **order)

    def replace(self, name: str, rows: DataFrame) -> None:
        replace_table(rows, self.path(name))

    def landed(self) -> DataFrame:
        """Stored raw rows of all runs."""
        return bronze.landed_names(self.read("bronze_timeseries"))

    def touched(self, run: Run) -> DataFrame:
        """(item_id, ts_date) with rows in this run."""
        if self._touched is None:
            rows = self.read("bronze_timeseries").where(F.col("run") == run.number)
            self._touched = settled(rows.select("item_id", "ts_date").distinct(), "touched")
        return self._touched

    def touched_items(self, run: Run, table: DataFrame, day: str) -> DataFrame:
        """All rows of the touched items, ``_touched`` where the run touched the day."""
        days = self.touched(run).select("item_id", F.col("ts_date").alias(day), F.lit(True).alias("_touched"))
        items = days.select("item_id").distinct()
        return table.join(items, "item_id", "left_semi").join(days, ["item_id", day], "left").withColumn(
            "_touched", F.coalesce("_touched", F.lit(False)))

    def observations(self, run: Run) -> DataFrame:
        """Stored cleaned rows of the touched days."""
        return rows_of_days(self.read("silver_timeseries"), self.touched(run), "ts_date").drop("ts_date")

    # ---- layers, in order ----

    def bronze_timeseries(self, run: Run, raw: DataFrame) -> None:
        rows = bronze.bronze_timeseries(rows_of(raw, run)).withColumn("ts_date", F.to_date("timestamp"))
        rows.hint("rebalance", "ts_date").write.mode("overwrite").partitionBy("ts_date").parquet(
            f"{self.path('bronze_timeseries')}/run={run.number}")

    def items_tables(self, run: Run) -> None:
        self.replace("bronze_item_mapping", bronze.bronze_items(quality.validated_items(self.items)))
        self.replace("silver_items", silver.silver_items(self.read("bronze_item_mapping"), self.config.ladder))

    def silver_timeseries(self, run: Run) -> None:
        fresh = silver.silver_timeseries(self.landed().where(F.col("run") == run.number))
        self.upsert("silver_timeseries", fresh.withColumn("ts_date", F.to_date("ts")), newest="load_ts",
                    ties=["price_avg_high", "price_avg_low", "volume"])

    def daily_bars(self, run: Run) -> None:
        self.upsert("daily_bars", silver.daily_bars(rows_of_days(self.landed(), self.touched(run), "ts_date")))

    def silver_prices_daily(self, run: Run) -> None:
        bars = self.touched_items(run, self.read("daily_bars"), "price_date")
        rows = silver.with_indicators(bars).withColumn("_near", near_touched("price_date", *INDICATORS))
        self.upsert("silver_prices_daily", rows.where("_near").select(*silver.DAILY_PRICE_COLUMNS))

    def gold_price_features(self, run: Run) -> None:
        bars = self.touched_items(run, self.read("silver_prices_daily"), "price_date")
        marked = bars.withColumn("_near", near_touched("price_date", *MODEL_FEATURES))
        rows = gold.gold_price_features(marked, keep=("_near",)).where("_near").drop("_near")
        self.upsert("gold_price_features", rows)

    def gold_daily_features(self, run: Run) -> None:
        update_features(gold.daily_observations(self.observations(run)), self.path("gold_daily_features"))

    def gold_item_metrics(self, run: Run) -> None:
        self.replace("gold_item_metrics", gold.gold_item_metrics(
            self.read("silver_prices_daily"), self.read("silver_items"), self.config.as_of))

    def item_days(self, run: Run) -> None:
        self.upsert("item_days", selection.item_days(self.observations(run)))

    def item_statistics(self, run: Run) -> None:
        self.replace("item_statistics", selection.statistics_of_days(
            self.read("item_days"), self.read("bronze_item_mapping"), self.config.selection.lookback_days, self.as_of))

    def items_selected(self, run: Run) -> None:
        self.replace("items_selected", selection.select_items(
            self.read("item_statistics"), self.read("bronze_item_mapping"), self.config.selection,
            self.config.selection_mode, self.config.force_include))
        write_selection(self.read("items_selected"), self.path("items_selected_json"))

    def backtest_origins(self, run: Run) -> None:
        """Scores of origins whose training or test days the run touched; those without a score carry NULL, so that
        one that lost its price is replaced too."""
        c = self.config
        series = gold.scan_item_series(self.read("gold_daily_features"), "latest_price", "date")
        marked = self.touched_items(run, series, "date")
        self.upsert("backtest_origins", backtest.origin_scores(
            marked, c.methods, c.window, c.horizon, touched="_touched"))

    def leaderboard(self, run: Run) -> None:
        self.replace("leaderboard", serving.leaderboard(
            self.scores(), self.read("bronze_item_mapping"), "30d", self.as_of))

    def predictions(self, run: Run) -> None:
        self.replace("predictions", serving.predict_batch(self.read("gold_daily_features"), self.read("gold_item_metrics")))

    def scores(self) -> DataFrame:
        return self.read("backtest_origins").where("mae IS NOT NULL")

    LAYERS: tuple[str, ...] = (
        "items_tables", "silver_timeseries", "daily_bars", "silver_prices_daily", "gold_daily_features",
        "gold_item_metrics", "gold_price_features", "item_days", "item_statistics", "items_selected", "backtest_origins",
        "leaderboard", "predictions")

    def run(self, raw: DataFrame, ledger: Ledger) -> Run | None:
        run = ledger.begin(raw)
        if run is None:
            return None
        for name, (_, day) in KEPT.items():
            recover(self.spark, self.path(name), day)
        steps: list[tuple[str, Callable[[], None]]] = [("bronze_timeseries", lambda: self.bronze_timeseries(run, raw))]
        steps += [(name, lambda step=getattr(self, name): step(run)) for name in self.LAYERS]
        for name, step in steps:
            if name not in run.done:
                step()
                ledger.commit(run, name)
        ledger.commit(run, FINISHED)
        return run

    def tables(self) -> dict[str, DataFrame]:
        """The stored tables, by the names of :func:`barloom.plans.pipeline.refresh`."""
        names = ("bronze_item_mapping", "bronze_timeseries", "silver_items", "silver_timeseries", "silver_prices_daily",
                 "gold_daily_features", "gold_item_metrics", "gold_price_features", "item_statistics", "items_selected",
                 "leaderboard", "predictions")
        out = {name: self.read(name) for name in names if stored(self.spark, self.path(name)) is not None}
        out = {name: df.drop("run", "ts_date") for name, df in out.items()}
        if stored(self.spark, self.path("backtest_origins")) is not None:
            out["gold_backtest_metrics"] = self.scores()
        return out


def refresh(spark: SparkSession, raw: DataFrame, items: DataFrame, warehouse: str, config: RefreshConfig) -> dict[str, DataFrame]:
    """Bring all layers below ``warehouse`` up to date with ``raw``; the stored tables by name."""
    plan = Refresh(spark, warehouse, config, items)
    plan.run(raw, Ledger(spark, plan.path("runs")))
    return plan.tables()
