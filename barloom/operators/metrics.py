"""Forecast error measures and their summaries."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: denominator used when actual and forecast are both zero
SMAPE_FLOOR = 1e-8


def absolute_error(y: Column, yhat: Column) -> Column:
    return F.abs(y - yhat)


def smape_term(y: Column, yhat: Column) -> Column:
    """One pair's part of sMAPE, 0 to 2; NULL when either side is missing."""
    scale = (F.abs(y) + F.abs(yhat)) / F.lit(2.0)
    return F.abs(y - yhat) / F.when(scale == 0, F.lit(SMAPE_FLOOR)).otherwise(scale)


def mae(y: str, yhat: str) -> Column:
    """Mean absolute error; pairs with a missing side do not count."""
    return F.avg(absolute_error(F.col(y), F.col(yhat)))


def smape(y: str, yhat: str) -> Column:
    """Symmetric mean absolute percentage error, 0 to 200; masked like :func:`mae`."""
    return F.avg(smape_term(F.col(y), F.col(yhat))) * F.lit(100.0)


def _present(c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c))


def run_summary(scores: DataFrame) -> DataFrame:
    """Per item and method: count, mean, median and population deviation of the errors.

    A group holds at most one row per backtest split, which bounds the exact medians.
    """
    clean = scores.select("item_id", "method", _present("mae").alias("mae"), _present("smape").alias("smape"))
    return clean.groupBy("item_id", "method").agg(
        F.count(F.lit(1)).alias("n_forecasts"),
        F.avg("mae").alias("mean_mae"),
        F.median("mae").alias("median_mae"),
        F.stddev_pop("mae").alias("std_mae"),
        F.avg("smape").alias("mean_smape"),
        F.median("smape").alias("median_smape"),
        F.stddev_pop("smape").alias("std_smape"),
    )


def method_summary(scores: DataFrame) -> DataFrame:
    """Per method: mean and population deviation of the errors. Partial aggregates only,
    so three methods over any number of rows stay cheap."""
    clean = scores.select("method", _present("mae").alias("mae"), _present("smape").alias("smape"))
    return clean.groupBy("method").agg(
        F.count(F.lit(1)).alias("n_forecasts"),
        F.avg("mae").alias("mean_mae"),
        F.stddev_pop("mae").alias("std_mae"),
        F.avg("smape").alias("mean_smape"),
        F.stddev_pop("smape").alias("std_smape"),
    )


RUN_METRICS = ["mean_mae", "median_mae", "std_mae", "mean_smape", "median_smape", "std_smape"]


def run_metrics_long(summary: DataFrame) -> DataFrame:
    """One row per run and metric: the experiment log's metric table."""
    return summary.select("item_id", "method", *RUN_METRICS).unpivot(
        ["item_id", "method"], RUN_METRICS, "metric", "value"
    ).where("value IS NOT NULL")


def run_params_long(summary: DataFrame, window_size: int, horizon: int) -> DataFrame:
    """One row per run and parameter: the experiment log's parameter table."""
    return (
        summary.select(
            "item_id",
            "method",
            F.col("n_forecasts").cast("string").alias("n_forecasts"),
            F.lit(str(window_size)).alias("window_size"),
            F.lit(str(horizon)).alias("horizon"),
        )
        .unpivot(["item_id", "method"], ["n_forecasts", "window_size", "horizon"], "param", "value")
    )


def run_identity(mark: object, **params: object) -> str:
    """What a run is known by: a digest of its parameters and of the data it saw, by its newest load time.

    Equal runs have equal names, on any machine. A name begins with a letter: as the name of a folder it stays text.
    """
    known = json.dumps(params, sort_keys=True, separators=(",", ":"), default=str) + "|" + str(mark)
    return "r" + hashlib.sha256(known.encode()).hexdigest()[:15]
