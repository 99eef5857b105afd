"""Writers for the stored layers, the selection document and the run results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.incremental import append_new, one_per_key, without_keys
from barloom.operators.quality import TableChecks, observed
from barloom.operators.silver import keep_latest
from barloom.session import move_folders, path_exists, remove_path, scratch_path

# fixed values: metadata of the selection document
SELECTION_CRITERIA = "median_daily_volume + coverage_pct"
SELECTION_VERSION = "1.0"


class SchemaChanged(ValueError):
    """The rows to write do not have the layout of the stored table."""


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def require_same_schema(existing: DataFrame, incoming: DataFrame) -> None:
    """Names and types must agree; column order and nullability may differ."""
    before, after = dict(existing.dtypes), dict(incoming.dtypes)
    if before != after:
        gone, new = sorted(before.items() - after.items()), sorted(after.items() - before.items())
        raise SchemaChanged(f"stored columns {gone} became {new}")


def replace_table(
    df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (), checks: TableChecks | None = None
) -> dict[str, int]:
    """Create or replace. ``cluster_by`` range-partitions and sorts the files.

    A range over (item, time) also cuts a hot item into several files; a global sort is
    not needed for pruning. The row checks in ``checks`` are counted by the writing job itself and returned.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if checks is not None:  # above the shuffle: its sampling would count rows twice
        df, counts = observed(df, checks)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return dict(counts.get) if checks is not None else {}


def append_new_rows(incoming: DataFrame, path: str, keys: Sequence[str], range_col: str | None = None) -> None:
    """Append the rows whose key the table does not hold."""
    existing = stored(incoming.sparkSession, path)
    if existing is not None:
        require_same_schema(existing, incoming)
        incoming = append_new(existing, incoming, keys, range_col)
    incoming.write.mode("append").parquet(path)


def append_new_bucketed(
    incoming: DataFrame, table: str, keys: Sequence[str], buckets: int = 64, path: str | None = None
) -> None:
    """Append the rows whose key the catalog table does not hold; the table is made if it is missing.

    The table is bucketed by the keys, so the anti join and the distinct keys under it find stored rows in place: only
    the incoming rows are shuffled, however long the table has grown. ``path`` is where a new table's files go.
    """
    spark = incoming.sparkSession
    if spark.catalog.tableExists(table):
        existing = spark.table(table)
        require_same_schema(existing, incoming)
        incoming = append_new(existing, incoming, keys)
    writer = incoming.repartition(buckets, *keys).write.mode("append").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def upsert_table(
    incoming: DataFrame, path: str, keys: Sequence[str], partition_col: str, newest: str | None = None,
    ties: Sequence[str] = (),
) -> None:
    """Upsert into a Parquet table partitioned by ``partition_col``, a day; one row per key, NULLs being equal.

    The day must follow from the key. Only days with incoming rows are read and rewritten, so the work follows the
    batch, not the table. The merged days are written once, to a folder beside the table, day by day as the table has
    them; then their folders are moved in. A run that stops in between has lost nothing: the next one finds the folder
    complete and moves in what is left of it before it does anything else, as does :func:`recover`; an incomplete one is
    written anew. Afterwards the folder is removed.
    With ``newest`` the highest value of that column wins per key, otherwise the incoming row does.
    """
    spark = incoming.sparkSession
    recover(spark, path, partition_col)
    existing = stored(spark, path)
    if existing is not None:
        require_same_schema(existing, incoming)
    merged, batch = one_per_key(incoming, keys, newest, ties), None
    if existing is not None:
        batch = scratch_path(spark, "upsert-batch")
        merged.write.parquet(batch)  # evaluated once, read several times below
        fresh = spark.read.schema(incoming.schema).parquet(batch)
        affected = _days_of(existing, fresh, partition_col).select(*incoming.columns)
        if newest is None:
            merged = without_keys(affected, fresh, keys).unionByName(fresh)
        else:
            merged = keep_latest(affected.unionByName(fresh), keys, newest, ties)
    # rebalance: a big day is cut into several files, small ones are not scattered
    merged.hint("rebalance", partition_col).write.partitionBy(partition_col).mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(_staged(path))
    recover(spark, path, partition_col)
    if batch:
        remove_path(spark, batch)


def _days_of(existing: DataFrame, fresh: DataFrame, day: str) -> DataFrame:
    """Rows of ``existing`` on the days of ``fresh``: a semi join prunes the folders, the NULL folder goes apart."""
    days = fresh.select(day).distinct()
    found = existing.join(days.where(F.col(day).isNotNull()), day, "left_semi")
    if days.where(F.col(day).isNull()).isEmpty():
        return found
    return found.unionByName(existing.where(F.col(day).isNull()))


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}.staged"


def recover(spark: SparkSession, path: str, partition_col: str) -> None:
    """Move the days of an unfinished :func:`upsert_table` into the table, if there are any and they are complete."""
    staged = _staged(path)
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        return
    move_folders(spark, staged, path, f"{partition_col}=")
    remove_path(spark, staged)


def store_run(rows: DataFrame, path: str, run_id: str) -> None:
    """The rows of a run in a table of runs, one folder per run. A run that is stored again replaces its own folder."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All stored runs."""
    return spark.read.option("basePath", path).parquet(path)


def write_selection(selection: DataFrame, path: str) -> None:
    """The selection as one JSON document: metadata and the ranked items.

    A selection is at most the configured top-n plus the configured manual ids, so one
    row holds it.
    """
    item = F.struct((-F.col("ranking_score")).alias("_order"), F.struct(*selection.columns).alias("item"))
    document = selection.agg(F.sort_array(F.collect_list(item)).alias("_items")).select(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
            F.size("_items").alias("total_items"),
            F.lit(SELECTION_CRITERIA).alias("selection_criteria"),
            F.lit(SELECTION_VERSION).alias("version"),
        ).alias("metadata"),
        F.col("_items.item").alias("items"),
    )
    document.write.mode("overwrite").json(path)


def write_results_csv(scores: DataFrame, path: str) -> None:
    """Detailed backtest rows, one folder per method."""
    scores.write.mode("overwrite").option("header", True).partitionBy("method").csv(path)
