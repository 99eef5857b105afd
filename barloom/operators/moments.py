"""Daily features kept up to date from per-item moments instead of per-item histories.

A day's outlier flag depends on the mean and deviation of all returns of its item, so a new day may turn the flags of
old days. The state of an item is one narrow row: count, mean and squared deviations of its returns, its last priced days, and the
returns next to the threshold on either side (of days whose spread does not decide anyway). New days at the end of a
series need nothing else: their windows see the last days, the moments are merged, and the four returns tell whether any
old flag turns. Only items whose flags do turn, or that got rows for days already stored, are computed again
from their stored days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import gold
from barloom.operators.incremental import DAILY_COLUMNS
from barloom.session import settled

#: Days before a new one that its windows reach.
RECENT_DAYS = 6
#: The state is stored in so many folders.
BUCKETS = 8
DAY = "struct<date:date,latest_price_high:bigint,latest_price_low:bigint>"
STATE_COLUMNS = ["item_id", "last_date", "n", "mean", "m2", "recent", "in_low", "in_high", "out_low", "out_high", "bucket"]


def bucket(item: str = "item_id") -> Column:
    return F.pmod(F.xxhash64(item), F.lit(BUCKETS)).cast("int").alias("bucket")


def deviation(n: str = "n", m2: str = "m2") -> Column:
    """Sample deviation; NULL below two returns."""
    return F.when(F.col(n) > 1, F.sqrt(F.greatest(F.col(m2), F.lit(0.0)) / (F.col(n) - 1)))


def beyond(value: Column, mean: Column, sd: Column, zscore: float) -> Column:
    return F.coalesce(F.abs(F.try_divide(value - mean, sd)) > zscore, F.lit(False))


def _wide(spread: float) -> Column:
    return F.coalesce(F.col("volatility_proxy") > spread, F.lit(False))


def _edges(mean: Column, hit: Column, spread: float) -> list[Column]:
    """Aggregates: the returns next to the threshold, inside and outside."""
    r, narrow = F.col("daily_return"), ~_wide(spread)
    return [
        F.min(F.when(narrow & ~hit, r)).alias("in_low"), F.max(F.when(narrow & ~hit, r)).alias("in_high"),
        F.max(F.when(narrow & hit & (r < mean), r)).alias("out_low"), F.min(F.when(narrow & hit & (r >= mean), r)).alias("out_high"),
    ]


def _days() -> Column:
    return F.collect_list(F.struct("date", F.col("latest_price_high").cast("bigint").alias("latest_price_high"),
                                   F.col("latest_price_low").cast("bigint").alias("latest_price_low")))


def _newest(days: Column) -> Column:
    return F.slice(F.sort_array(days, asc=False), 1, RECENT_DAYS)


def item_states(scored: DataFrame, zscore: float = gold.OUTLIER_ZSCORE, spread: float = gold.OUTLIER_SPREAD) -> DataFrame:
    """The state of every item from all its days, as :func:`gold.price_features` returns them."""
    mean = F.avg("daily_return").over(Window.partitionBy("item_id"))
    rows = scored.withColumn("_mean", mean).withColumn("_hit", F.coalesce(F.col("return_zscore") > zscore, F.lit(False)))
    return rows.groupBy("item_id").agg(
        F.max("date").alias("last_date"), F.count("daily_return").alias("n"),
        F.coalesce(F.avg("daily_return"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("daily_return") * F.count("daily_return"), F.lit(0.0)).alias("m2"),
        _newest(_days()).alias("recent"), *_edges(F.col("_mean"), F.col("_hit"), spread),
    ).select("*", bucket()).select(STATE_COLUMNS)


def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """States ``old`` (left join: may be NULL) with the moments of the new days (item_id, nb, mb, m2b, days, newest)."""
    na, nb = F.coalesce("n", F.lit(0)), F.coalesce("nb", F.lit(0))
    ma, mb = F.coalesce("mean", F.lit(0.0)), F.coalesce("mb", F.lit(0.0))
    total, delta = na + nb, mb - ma
    share = F.coalesce(F.try_divide(nb.cast("double"), total.cast("double")), F.lit(0.0))
    return new.join(old.drop("bucket"), "item_id", "left").select(
        "item_id", F.col("newest").alias("last_date"), total.alias("n"), (ma + delta * share).alias("mean"),
        (F.coalesce("m2", F.lit(0.0)) + F.coalesce("m2b", F.lit(0.0)) + delta * delta * share * na).alias("m2"),
        _newest(F.concat(F.coalesce("recent", F.array().cast(f"array<{DAY}>")), "days")).alias("recent"),
        "in_low", "in_high", "out_low", "out_high")


def _turns(zscore: float) -> Column:
    """Whether a flag of an old day turns under the merged moments."""
    mean, sd = F.col("mean"), deviation()

    def out(c: str) -> Column:
        return beyond(F.col(c), mean, sd, zscore)

    left = (F.col("out_low").isNotNull() & (~out("out_low") | (F.col("out_low") >= mean))) | (
        F.col("out_high").isNotNull() & (~out("out_high") | (F.col("out_high") < mean)))
    return F.coalesce(out("in_low") | out("in_high") | left, F.lit(False))


def advance(
    changed: DataFrame, state: DataFrame | None, target: DataFrame | None, frozen: bool = False,
    zscore: float = gold.OUTLIER_ZSCORE, spread: float = gold.OUTLIER_SPREAD,
) -> tuple[DataFrame, DataFrame]:
    """Feature rows to upsert, and the states of the items in ``changed``.

    ``changed`` holds the daily observations, complete, of the days that got new rows; ``state`` and ``target`` are the
    stored states and features (None at first). With ``frozen`` days not later than all stored days of their items
    are ignored, and old flags stay as they are.
    """
    changed = settled(changed.select(*DAILY_COLUMNS), "changed-days")
    spans = changed.groupBy("item_id").agg(F.min("date").alias("_first"))
    if state is None:
        state = changed.sparkSession.createDataFrame([], (
            f"item_id {dict(changed.dtypes)['item_id']}, last_date date, n long, mean double, m2 double, recent array<{DAY}>, in_low double, "
            "in_high double, out_low double, out_high double, bucket int"))
    if frozen:  # a day that is counted already, when a batch is repeated, is not counted again
        ends = state.select("item_id", F.col("last_date").alias("_end"))
        changed = changed.join(ends, "item_id", "left").where("_end IS NULL OR date > _end").drop("_end")
    known = spans.join(state.select(STATE_COLUMNS), "item_id", "left")
    if not frozen:
        known = known.where(F.col("_first") > F.col("last_date"))
    known = settled(known.drop("_first"), "known-items")
    before = known.select("item_id", F.inline("recent")).withColumn("_new", F.lit(False))
    fresh = changed.join(known.select("item_id"), "item_id", "left_semi").withColumn("_new", F.lit(True))
    onward = settled(gold.price_paths(fresh.unionByName(before, allowMissingColumns=True)).where("_new"), "onward-days")
    new = onward.groupBy("item_id").agg(
        F.count("daily_return").alias("nb"), F.avg("daily_return").alias("mb"),
        (F.var_pop("daily_return") * F.count("daily_return")).alias("m2b"), _days().alias("days"), F.max("date").alias("newest"))
    merged = _merged(known, new)
    if not frozen:
        merged = merged.where(~_turns(zscore))
    merged = settled(merged.withColumn("_sd", deviation()), "merged-items")

    scores = onward.join(merged.select("item_id", F.col("mean").alias("_mean"), "_sd"), "item_id")
    hit = beyond(F.col("daily_return"), F.col("_mean"), F.col("_sd"), zscore)
    scores = scores.withColumn("_hit", hit).withColumn("is_outlier", hit | _wide(spread))
    edges = scores.groupBy("item_id").agg(*_edges(F.col("_mean"), F.col("_hit"), spread))
    names = ("in_low", "in_high", "out_low", "out_high")
    edges = edges.select("item_id", *[F.col(c).alias(f"_{c}") for c in names])
    nearest = {"in_low": F.least, "in_high": F.greatest, "out_low": F.greatest, "out_high": F.least}
    states = merged.join(edges, "item_id").withColumns({c: pick(c, f"_{c}") for c, pick in nearest.items()})
    rows, states = scores.select(*gold.GOLD_DAILY_COLUMNS), states.select("*", bucket()).select(STATE_COLUMNS)
    if frozen:
        return rows, states

    again = spans.join(merged.select("item_id"), "item_id", "left_anti").select("item_id")
    history = changed.join(again, "item_id", "left_semi")
    if target is not None:
        kept = target.select(*gold.GOLD_DAILY_COLUMNS).join(again, "item_id", "left_semi")
        history = history.unionByName(
            kept.select(*DAILY_COLUMNS).join(changed.select("item_id", "date"), ["item_id", "date"], "left_anti"))
    full = gold.price_features(history)
    whole = settled(gold.with_outlier_flag(full, zscore, spread), "items-whole")
    turned = whole.select(*gold.GOLD_DAILY_COLUMNS)
    if target is not None:  # of computed days only those that differ are written
        turned = turned.exceptAll(kept)
    return rows.unionByName(turned), states.unionByName(item_states(whole, zscore, spread))
