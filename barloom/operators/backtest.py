"""Walk-forward evaluation of forecasters over all items in one plan.

Input is a daily series ``(item_id, date, price)`` with one row per item and day. Splits
are never materialised: a split is a row, its training data a window frame that ends at
the row before. All methods share one shuffle and one sort by (item_id, date); only the
fitted smoother adds a shuffle, to spread its windows over all cores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.forecast import MIN_OBSERVATIONS, ets_forecast, fit_series, holt_fixed
from barloom.operators.metrics import smape_term

METHODS = ("last_value", "moving_average", "ets")
MOVING_AVERAGE_DAYS = 7


def splits(
    series: DataFrame,
    train: int = 28,
    horizon: int = 1,
    max_splits: int | None = None,
    expanding: bool = False,
    keep: str = "earliest",
    methods: Sequence[str] = (),
    trend: str | None = "add",
    touched: str | None = None,
) -> DataFrame:
    """One row per walk-forward split, forecast origin at ``date``.

    Rolling splits train on the ``train`` rows before the origin; expanding splits on all
    rows before it, at least ``train``. Items shorter than ``train + horizon`` have none.
    Every origin counts; a given ``max_splits`` keeps the first ones, or with
    ``keep='latest'`` the last ones. ``trend`` chooses the form of the fitted smoother. ``touched``
    names a boolean column of ``series``: only splits with such a row among their training or test days
    are made, and only they are fitted.

    Columns: item_id, split, date, train_start, train_end, train_size, test_end, actuals,
    and one array column of forecasts per requested method.
    """
    if keep not in ("earliest", "latest"):
        raise ValueError(f"unknown keep {keep!r}")
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}")
    w = Window.partitionBy("item_id").orderBy("date")
    before = w.rowsBetween(Window.unboundedPreceding if expanding else -train, -1)
    rows = series.withColumn("_rn", F.row_number().over(w))
    if max_splits is None:
        keep = "earliest"
    elif keep == "earliest":
        # later rows take part in no split
        rows = rows.where(F.col("_rn") <= train + max_splits + horizon - 1)
    else:
        rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("item_id")))

    first_day = F.first("date").over(w.rowsBetween(Window.unboundedPreceding, 0))
    framed = rows.select(
        "*",
        F.array(*[F.lead("price", j).over(w) if j else F.col("price") for j in range(horizon)]).alias("actuals"),
        (F.lead("date", horizon - 1).over(w) if horizon > 1 else F.col("date")).alias("test_end"),
        F.lag("date", 1).over(w).alias("train_end"),
        (first_day if expanding else F.lag("date", train).over(w)).alias("train_start"),
        *[_training_column(m, w, before, train, expanding) for m in methods if not (expanding and m == "ets")],
        *([F.max(touched).over(w.rowsBetween(Window.unboundedPreceding if expanding else -train, horizon - 1)).alias("_near")]
          if touched else []),
    ).where((F.col("_rn") > train) & F.col("test_end").isNotNull())
    if touched:
        framed = framed.where("_near")
    if keep == "earliest":
        framed = framed.withColumn("split", F.col("_rn") - train)
    else:
        framed = framed.withColumn("split", F.col("_rn") - F.greatest(F.col("_n") - horizon + 1 - max_splits, F.lit(train)))
        framed = framed.where("split > 0")
    if "ets" in methods and expanding:
        fitted = expanding_ets(series, train, horizon, trend)
        framed = framed.join(fitted, ["item_id", "date"], "left")
    elif "ets" in methods:
        framed = spread(framed, "item_id", "split")
    size = F.col("_rn") - 1 if expanding else F.lit(train)
    forecasts = [_forecast_column(m, horizon, size, trend, expanding).alias(m) for m in methods]
    return framed.select(
        "item_id", F.col("split").cast("int").alias("split"), "date", "train_start", "train_end",
        size.cast("int").alias("train_size"), "test_end", "actuals", *forecasts,
    )


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even out rows before per-row work that costs far more than moving them.

    The series shuffle is small, so AQE would merge it into a few tasks by size; fitting
    is bound by CPU and wants all cores. A fixed count is exempt from merging.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def _training_column(method: str, w, before, train: int, expanding: bool) -> Column:
    """What a forecaster needs from the rows before the origin."""
    if method == "last_value":
        out = F.lag("price", 1).over(w)
    elif method == "moving_average":
        reach = MOVING_AVERAGE_DAYS if expanding else min(MOVING_AVERAGE_DAYS, train)
        out = F.avg("price").over(w.rowsBetween(-reach, -1))
    else:
        out = F.collect_list("price").over(before)
    return out.alias(f"_{method}")


def expanding_ets(series: DataFrame, train: int, horizon: int, trend: str | None = "add") -> DataFrame:
    """(item_id, date, _ets): the smoother's forecast from every origin with ``train`` rows before it.

    An item's history, one value per calendar day, is read once for all its origins, and items that come in one batch
    are fitted abreast. Rows before the first missing price count, as a window with a gap has no fit.
    """
    first = max(train, MIN_OBSERVATIONS)

    def fitted(days: pa.Table) -> pa.RecordBatch:
        """The origins of whole items, sorted by item and date."""
        price = days.column("price").to_numpy().astype(float)
        ends = pc.run_end_encode(days.column("item_id").combine_chunks()).run_ends.to_numpy()
        begins = np.append(0, ends[:-1])
        gaps = np.flatnonzero(~np.isfinite(price))
        known = np.minimum(ends, np.append(gaps, len(price))[np.searchsorted(gaps, begins)])
        found = fit_series([price[a:b] for a, b in zip(begins, known)], first, horizon, trend == "add")
        # an item's last value has no row after it, whose forecast it would serve
        counts = np.maximum(np.minimum(known + 1, ends) - begins - first, 0)
        rows = np.concatenate([np.arange(a + first, a + first + n) for a, n in zip(begins, counts)])
        values = np.concatenate([f[:n] for f, n in zip(found, counts)])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * horizon), pa.array(values.ravel()))
        kept = days.select(["item_id", "date"]).take(pa.array(rows.astype(np.int64))).combine_chunks()
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in kept.columns), lists], ["item_id", "date", "_ets"])

    def fit(batches):
        open_rows = None  # of the last item, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            days = pa.Table.from_batches([batch])
            days = days if open_rows is None else pa.concat_tables([open_rows, days])
            ends = pc.run_end_encode(days.column("item_id").combine_chunks()).run_ends
            whole = ends[-2].as_py() if len(ends) > 1 else 0
            if whole:
                yield fitted(days.slice(0, whole))
            open_rows = days.slice(whole)
        if open_rows is not None:
            yield fitted(open_rows)

    kinds = dict(series.dtypes)
    days = series.select("item_id", "date", F.col("price").cast("double").alias("price"))
    return spread(days, "item_id").sortWithinPartitions("item_id", "date").mapInArrow(
        fit, f"item_id {kinds['item_id']}, date {kinds['date']}, _ets array<double>")


def _forecast_column(method: str, horizon: int, size: Column, trend: str | None, expanding: bool) -> Column:
    known = F.col(f"_{method}")
    if method == "ets" and expanding:
        return known
    if method == "ets":
        # collect_list drops NULLs, so a short array means an incomplete window
        return ets_forecast(F.when(F.size(known) == size, known), horizon, trend)
    return F.array_repeat(known, horizon)


def rolling_splits(series: DataFrame, window: int = 28, horizon: int = 1, max_splits: int | None = None, **kw) -> DataFrame:
    return splits(series, window, horizon, max_splits, **kw).drop("actuals")


def expanding_splits(series: DataFrame, min_train: int = 14, test_size: int = 1, max_splits: int | None = None, **kw) -> DataFrame:
    return splits(series, min_train, test_size, max_splits, expanding=True, **kw).drop("actuals")


def scored_splits(
    series: DataFrame,
    methods: Sequence[str] = METHODS,
    train: int = 28,
    horizon: int = 1,
    max_splits: int | None = None,
    expanding: bool = False,
    keep: str = "earliest",
    **form: str | None,
) -> DataFrame:
    """One row per split and method with mae and smape, NULL where data is missing."""
    cut = splits(series, train, horizon, max_splits, expanding, keep, methods, **form)
    forecasts = F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("predictions")) for m in methods])
    long = cut.select("item_id", "split", "date", "actuals", F.inline(forecasts))
    pairs = [(F.get("actuals", F.lit(j)), F.get("predictions", F.lit(j))) for j in range(horizon)]
    mae = sum((F.abs(y - p) for y, p in pairs), F.lit(0.0)) / F.lit(float(horizon))
    smape = sum((smape_term(y, p) for y, p in pairs), F.lit(0.0)) / F.lit(float(horizon)) * F.lit(100.0)
    return long.select("item_id", "split", "date", "method", mae.alias("mae"), smape.alias("smape"), "actuals", "predictions")


def backtest_scores(
    series: DataFrame,
    methods: Sequence[str] = METHODS,
    window: int = 28,
    horizon: int = 1,
    max_splits: int | None = None,
    keep: str = "earliest",
    **form: str | None,
) -> DataFrame:
    """The backtest metrics table: one row per item, origin date and method.

    Splits with a missing price or forecast are left out. ``trend`` may be given for the
    fitted smoother.
    """
    return origin_scores(series, methods, window, horizon, max_splits, keep, **form).where("mae IS NOT NULL")


def origin_scores(
    series: DataFrame,
    methods: Sequence[str] = METHODS,
    window: int = 28,
    horizon: int = 1,
    max_splits: int | None = None,
    keep: str = "earliest",
    **form: str | None,
) -> DataFrame:
    """:func:`backtest_scores` with the origins that have no score, of NULL errors. With ``touched`` (see
    :func:`splits`) only the origins that touched days take part in."""
    scored = scored_splits(series, methods, window, horizon, max_splits, keep=keep, **form)
    return scored.select(
        "item_id",
        "date",
        "method",
        "mae",
        "smape",
        F.get("actuals", F.lit(0)).alias("actual"),
        F.get("predictions", F.lit(0)).alias("predicted"),
        F.lit(horizon).alias("horizon"),
        F.lit(window).alias("window_size"),
    )


def backtest_item_result(
    series: DataFrame,
    methods: Sequence[str] = METHODS,
    min_train: int = 14,
    test_size: int = 1,
    max_splits: int | None = None,
    with_predictions: bool = False,
) -> DataFrame:
    """Per item and method over expanding splits: counts, overall errors, their spread.

    With ``with_predictions`` the forecasts and actuals come along as arrays in date
    order, at most one per calendar day.
    """
    scored = scored_splits(series, methods, min_train, test_size, max_splits, expanding=True)
    ok = F.col("mae").isNotNull()
    aggs = [
        F.count(F.lit(1)).alias("n_splits"),
        (F.count("mae") * test_size).alias("n_predictions"),
        F.avg("mae").alias("mae"),
        F.avg("smape").alias("smape"),
        F.stddev_pop("mae").alias("mae_std"),
        F.stddev_pop("smape").alias("smape_std"),
    ]
    if with_predictions:
        pair = F.when(ok, F.struct("date", "actuals", "predictions"))
        aggs.append(F.sort_array(F.collect_list(pair)).alias("_path"))
    out = scored.groupBy("item_id", "method").agg(*aggs).where("n_predictions > 0")
    if with_predictions:
        out = out.withColumn("predictions", F.flatten("_path.predictions")).withColumn(
            "actuals", F.flatten("_path.actuals")
        ).drop("_path")
    return out


def suitable_items(metrics: DataFrame, limit: int | None = None) -> DataFrame:
    """Items fit for forecasting; with a ``limit`` the lowest ids."""
    out = metrics.where("suitable_for_forecasting").select("item_id").distinct()
    return out if limit is None else out.orderBy("item_id").limit(limit)


def benchmark_suite(
    series: DataFrame, items: DataFrame, methods: Sequence[str] = METHODS, **kw
) -> DataFrame:
    """Per method over the given items: mean errors and the share of items evaluated."""
    wanted = items.select("item_id").distinct()
    results = backtest_item_result(series.join(wanted, "item_id", "left_semi"), methods, **kw)
    names = F.explode(F.array(*[F.lit(m) for m in methods])).alias("method")
    return (
        wanted.select("item_id", names)
        .join(results, ["item_id", "method"], "left")
        .groupBy("method")
        .agg(
            F.avg("mae").alias("avg_mae"),
            F.avg("smape").alias("avg_smape"),
            (F.count("mae") / F.count(F.lit(1))).alias("success_rate"),
        )
    )


def holt_forecast(series: DataFrame, alpha: float, beta: float, horizon: int = 1) -> DataFrame:
    """Holt's linear method with given parameters over each item's daily history.

    The history is gathered per item; one value per calendar day bounds it.
    """
    path = F.transform(F.sort_array(F.collect_list(F.struct("date", "price"))), lambda p: p["price"])
    state = series.where("price IS NOT NULL").groupBy("item_id").agg(path.alias("path"))
    state = state.withColumn("state", holt_fixed("path", alpha, beta)).where("state IS NOT NULL")
    return state.select(
        "item_id",
        F.size("path").cast("bigint").alias("n_obs"),
        F.col("state.level").alias("level"),
        F.col("state.trend").alias("trend"),
        (F.col("state.level") + F.lit(float(horizon)) * F.col("state.trend")).alias("forecast"),
    )
