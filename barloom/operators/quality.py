"""Data checks. Every check returns the failing rows; none means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from barloom.operators.silver import PRICE_SOURCE


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their count. NULL keys do not count."""
    return not_null_keys(df, columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their count. NULL passes; :func:`not_null` finds it."""
    bad = ~F.col(column).isin(*values)
    return df.where(bad).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def _violations(rules: Mapping[str, Column]) -> Column:
    """Names of the broken rules; a rule that evaluates to NULL is not broken."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def _integral(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def _broken(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    out = df.withColumn("violations", _violations(rules)).where(F.size("violations") > 0)
    return out.withColumn("violations", F.concat_ws(",", "violations"))


def item_violations(items: DataFrame) -> DataFrame:
    """Items that break the mapping layout: id from 1, a name, no negative amounts."""
    rules = {
        "id": _integral("id").isNull() | (_integral("id") < 1),
        "name": F.col("name").isNull(),
    }
    for c in ("lowalch", "highalch", "limit"):
        rules[c] = F.col(c).isNotNull() & (_integral(c).isNull() | (_integral(c) < 0))
    return _broken(items, rules)


def validated_items(items: DataFrame) -> DataFrame:
    """Items cast to the mapping layout. Raises when any row breaks it."""
    bad = item_violations(items).limit(5).collect()
    if bad:
        raise ValueError(f"item mapping is invalid, for example: {[r.asDict() for r in bad]}")
    amounts = {c: _integral(c) for c in ("id", "lowalch", "highalch", "limit")}
    return items.withColumns({**amounts, "name": F.col("name").cast("string"), "members": F.col("members").try_cast("boolean")})


def timeseries_violations(raw: DataFrame) -> DataFrame:
    """Observations outside the layout. The rows stay in use; this is the warning table."""
    rules = {
        "timestamp": F.col("timestamp").isNull() | (F.col("timestamp") < F.lit("1970-01-01").cast("timestamp_ntz")),
        "item_id": F.col("item_id").isNull() | (F.col("item_id") < 1),
    }
    for c in ("avgHighPrice", "avgLowPrice", "high", "low"):
        if c in raw.columns:
            rules[c] = F.col(c) < 0
    return _broken(raw, rules)


def row_preservation(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with both counts when they differ. Counts meet in one aggregate, not a join."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    sides = before.select(one.alias("b"), zero.alias("s")).unionByName(after.select(zero.alias("b"), one.alias("s")))
    return (
        sides.agg(
            F.coalesce(F.sum("b"), zero).alias("bronze_rows"), F.coalesce(F.sum("s"), zero).alias("silver_rows")
        )
        .withColumn("row_difference", F.col("bronze_rows") - F.col("silver_rows"))
        .where("row_difference <> 0")
    )


@dataclass(frozen=True)
class TableChecks:
    """The declared checks of one table."""

    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    amounts: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


LAYER_CHECKS: dict[str, TableChecks] = {
    "item_mapping": TableChecks(required=("id", "name"), key=("id",)),
    "timeseries_raw": TableChecks(required=("timestamp", "item_id")),
    "silver_timeseries": TableChecks(
        required=("item_id", "ts", "source", "load_ts"),
        key=("item_id", "ts"),
        amounts=("price_high", "price_low", "price_avg_high", "price_avg_low", "volume"),
        accepted={"source": (PRICE_SOURCE,)},
    ),
    "gold_daily_features": TableChecks(
        required=("item_id", "date", "is_outlier", "observation_count"),
        key=("item_id", "date"),
        amounts=("latest_price", "latest_price_high", "latest_price_low", "price_7d_ma", "total_volume",
                 "observation_count", "min_price", "max_price"),
    ),
}


def _row_checks(spec: TableChecks) -> dict[str, Column]:
    out = {f"not_null_{c}": F.col(c).isNull() for c in spec.required}
    out.update({f"non_negative_{c}": F.col(c) < 0 for c in spec.amounts})
    for c, values in spec.accepted.items():
        out[f"accepted_values_{c}"] = ~F.col(c).isin(*values)
    return out


def check_report(df: DataFrame, table: str, spec: TableChecks) -> DataFrame:
    """(table, check, n_failures) of one table; row checks share one scan."""
    conds = _row_checks(spec)
    parts = []
    if conds:
        counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in conds.items()])
        parts.append(counts.unpivot([], list(conds), "check", "n_failures"))
    if spec.key:
        repeated = unique(df, *spec.key).agg(F.count(F.lit(1)).alias("n_failures"))
        parts.append(repeated.select(F.lit(f"unique_{'_'.join(spec.key)}").alias("check"), "n_failures"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(F.lit(table).alias("table"), "check", "n_failures")


def failing_rows(df: DataFrame, spec: TableChecks) -> DataFrame:
    """Every failing row once, ``failed_checks`` naming what it fails. A repeated key fails on each of its rows.

    One pass: the row checks are expressions, the key is counted by a window, whose sort spills.
    """
    rules = _row_checks(spec)
    if spec.key:
        known = F.lit(True)
        for c in spec.key:
            known = known & F.col(c).isNotNull()
        df = df.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(*spec.key)))
        rules[f"unique_{'_'.join(spec.key)}"] = known & (F.col("_times") > 1)
    out = df.withColumn("failed_checks", _violations(rules)).where(F.size("failed_checks") > 0)
    return out.drop("_times")


def check_names(spec: TableChecks) -> list[str]:
    return [*_row_checks(spec), *([f"unique_{'_'.join(spec.key)}"] if spec.key else [])]


def check_table(df: DataFrame, spec: TableChecks, failures_path: str | None = None) -> dict[str, int]:
    """Number of failing rows per check, of keys for the key check.

    With a path the failing rows are stored there, in one pass over the table, and counted from what was stored.
    Severity is a warning: nothing raises.
    """
    if not failures_path:
        return {r["check"]: r["n_failures"] for r in check_report(df, "", spec).collect()}
    failing_rows(df, spec).write.mode("overwrite").parquet(failures_path)
    kept = df.sparkSession.read.parquet(failures_path)
    counts = dict.fromkeys(check_names(spec), 0)
    named = kept.select(F.explode("failed_checks").alias("check"), *spec.key)
    key = F.struct(*spec.key) if spec.key else F.lit(None)
    for r in named.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys")).collect():
        counts[r["check"]] = r["keys"] if r["check"].startswith("unique_") else r["n"]
    return counts


def observed(df: DataFrame, spec: TableChecks) -> tuple[DataFrame, Observation]:
    """``df`` with its row checks counted by whatever job evaluates it, and where the counts arrive."""
    counts = Observation()
    return df.observe(counts, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(cond).alias(name) for name, cond in _row_checks(spec).items()]), counts


def check_layers(tables: Mapping[str, DataFrame], failures_path: str | None = None) -> dict[str, dict[str, int]]:
    """:func:`check_table` for every declared table that is present."""
    return {
        table: check_table(tables[table], spec, failures_path and f"{failures_path.rstrip('/')}/{table}")
        for table, spec in LAYER_CHECKS.items()
        if table in tables
    }
