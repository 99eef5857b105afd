"""Read-side datasets: item pages, batch forecasts, recent metrics, leaderboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import scalar as S
from barloom.operators.gold import as_date, join_items
from barloom.operators.lookup import only_ids
from barloom.operators.selection import days_before
from barloom.session import settled

MOVING_AVERAGE_DAYS = 7
HISTORY_DAYS = 14
# fixed value: the label of the served model
MODEL_LABEL = "7-day moving average"


def _place(name: str = "name", item: str = "item_id") -> Column:
    """Where an item stands in the list; structs compare with NULL first, as the order by name does."""
    return F.struct(F.col(name).alias("name"), F.col(item).alias("item_id"))


def page_index(listed: DataFrame, page_size: int = 50) -> DataFrame:
    """The first item of every page: page, name, item_id, total_count, total_pages.

    The items are sorted once by ranges. A row's rank is its place in its range plus the sizes of the ranges before,
    which are few, so that no task sees more than its range. Store the result to serve pages from it.
    """
    if not 1 <= page_size <= 1000:
        raise ValueError("page_size must be between 1 and 1000")
    ordered = listed.select("name", "item_id").repartitionByRange("name", "item_id").sortWithinPartitions("name", "item_id")
    ranges = F.shiftright(F.monotonically_increasing_id(), 33)
    ordered = settled(ordered.select(
        "name", "item_id", ranges.alias("_range"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")), "ranked")
    sizes = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    every = Window.orderBy("_range")  # one row per range
    before = F.sum("_size").over(every.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_size").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"), total.alias("total_count"))
    rank = F.col("_before") + F.col("_at")
    first = ordered.join(F.broadcast(starts), "_range").where(rank % page_size == 0)
    return first.select(
        (rank / page_size).cast("int").alias("_page"), "name", "item_id", "total_count",
        F.ceil(F.col("total_count") / page_size).cast("bigint").alias("total_pages"),
    ).select((F.col("_page") + 1).alias("page"), "name", "item_id", "total_count", "total_pages")


def items_page(
    metrics: DataFrame, page: int = 1, page_size: int = 50, curated: DataFrame | None = None, index: DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """One page of items by name, with the total on every row.

    ``index`` is a stored :func:`page_index` of the same items and page size, made here if it is not given. The page is
    what lies between its first item and that of the next page: nothing is skipped by counting. A page past the end
    raises, which the index alone tells, or is empty unless ``strict``; an empty list has an empty first page.
    """
    if page < 1 or not 1 <= page_size <= 1000:
        raise ValueError("page must be positive and page_size between 1 and 1000")
    listed = metrics if curated is None else only_ids(metrics, curated)
    index = page_index(listed, page_size) if index is None else index
    marks = {r.page: r for r in index.where(F.col("page").isin(1, page, page + 1)).collect()}
    if strict and page not in marks and (marks or page > 1):
        raise ValueError(f"there are {marks[1].total_pages if marks else 0} pages, page {page} is past the last")

    def mark(at) -> Column:
        kinds = dict(listed.dtypes)
        return F.struct(F.lit(at.name).cast(kinds["name"]).alias("name"), F.lit(at.item_id).cast(kinds["item_id"]).alias("item_id"))

    rows = listed.select("item_id", "name")
    rows = rows.where(_place() >= mark(marks[page])) if page in marks else rows.where(F.lit(False))
    if page + 1 in marks:
        rows = rows.where(_place() < mark(marks[page + 1]))
    total, pages = (marks[1].total_count, marks[1].total_pages) if marks else (0, 0)
    return rows.orderBy("name", "item_id").select(
        "item_id",
        "name",
        F.lit(total).cast("bigint").alias("total_count"),
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.lit(pages).cast("bigint").alias("total_pages"),
    )


def last_n_per_item(df: DataFrame, n: int, date_col: str = "date") -> DataFrame:
    """The newest ``n`` rows of every item, ``recency`` 1 being the newest."""
    w = Window.partitionBy("item_id").orderBy(F.desc(date_col))
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)


def predict_batch(daily_features: DataFrame, metrics: DataFrame, horizon: int = 1) -> DataFrame:
    """7-day moving-average forecast for every listed item.

    Items with fewer than 7 of the last 14 feature rows keep a row with status
    ``insufficient_data`` and no forecast; without any price in the last 7 rows the
    forecast steps are NULL.
    """
    if not 1 <= horizon <= 7:
        raise ValueError("horizon must be between 1 and 7")
    recent = last_n_per_item(daily_features.select("item_id", "date", "latest_price"), HISTORY_DAYS)
    mean = recent.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(F.when(F.col("recency") <= MOVING_AVERAGE_DAYS, F.col("latest_price"))).alias("mean_price"),
    )
    enough = F.coalesce(F.col("days"), F.lit(0)) >= MOVING_AVERAGE_DAYS
    flat = F.when(enough, F.array_repeat("mean_price", horizon))
    no_bound = F.array_repeat(F.lit(None).cast("double"), horizon)
    return (
        metrics.select("item_id", F.col("name").alias("item_name"), F.col("latest_price").alias("_current"))
        .join(mean, "item_id", "left")
        .select(
            "item_id",
            "item_name",
            F.coalesce(F.col("_current").cast("double"), F.lit(0.0)).alias("current_price"),
            flat.alias("forecast"),
            no_bound.alias("lower"),
            no_bound.alias("upper"),
            F.lit(horizon).alias("horizon"),
            F.lit(MODEL_LABEL).alias("model_used"),
            F.when(enough, "ok").otherwise("insufficient_data").alias("status"),
        )
    )


def item_metrics_recent(
    scores: DataFrame, metrics: DataFrame, last: str = "30d", as_of: dt.date | str | None = None
) -> DataFrame:
    """Per item: the most evaluated method of the period and its mean errors."""
    days = S.parse_period(last, strict=True)
    per_method = (
        scores.where(F.col("date") >= F.date_sub(as_date(as_of), days))
        .groupBy("item_id", "method")
        .agg(F.avg("mae").alias("mae"), F.avg("smape").alias("smape"), F.count(F.lit(1)).alias("n_predictions"))
    )
    w = Window.partitionBy("item_id").orderBy(F.desc("n_predictions"), "method")
    top = per_method.withColumn("_rn", F.row_number().over(w)).where("_rn = 1 AND mae IS NOT NULL")
    return join_items(top, metrics, ["name"]).select(
        "item_id",
        F.col("name").alias("item_name"),
        F.col("method").alias("model_name"),
        "mae",
        "smape",
        F.lit(last).alias("evaluation_period"),
        "n_predictions",
    )


def leaderboard(
    scores: DataFrame, items: DataFrame, last: str = "30d", as_of: dt.datetime | str | None = None
) -> DataFrame:
    """Best method per item by smape, then mae. Unreadable periods mean 30 days."""
    days = S.parse_period(last, strict=False)
    per_method = (
        scores.where(F.col("date").cast("timestamp_ntz") >= days_before(as_of, days))
        .groupBy("item_id", "method")
        .agg(F.avg("smape").alias("smape"), F.avg("mae").alias("mae"), F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("item_id").orderBy(*S.asc_total("smape", "mae", "method"))
    best = per_method.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return join_items(best, items, ["name"], item_key="id").select("item_id", "name", "method", "smape", "mae", "n")


def leaderboard_top(board: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of the leaderboard in display form."""
    return (
        board.orderBy(*S.asc_total("smape", "mae", "item_id"))
        .limit(n)
        .select(
            "item_id",
            "name",
            F.replace("method", F.lit("_"), F.lit(" ")).alias("method"),
            F.format_string("%.2f%%", "smape").alias("smape_text"),
            S.humanise("mae").alias("mae_text"),
        )
    )


def selection_listing(selection: DataFrame) -> DataFrame:
    return selection.select(
        "id", "name", "median_units_per_day", "median_turnover_gp", "coverage", "days_with_data", "selection_reason"
    )
