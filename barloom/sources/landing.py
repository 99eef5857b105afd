"""Landed JSON: time-series documents, the item mapping, the selection document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.scalar import parse_item_list
from barloom.operators.lookup import id_frame
from barloom.schema import ITEM_MAPPING, SELECTION_FALLBACK_IDS

def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a zone-free UTC timestamp."""
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


PRICES = ("avgHighPrice", "avgLowPrice", "high", "low")
VOLUMES = ("highPriceVolume", "lowPriceVolume")


def _field(value: Column, name: str, kind: str = "bigint") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def parsed_documents(docs: DataFrame, doc: str = "doc", item_id: str = "item_id") -> DataFrame:
    """(item_id, readable, in_list, entries): the documents, parsed once.

    A document is ``{"data": [{...}]}`` or ``{"data": {"<epoch>": {...}}}``. An entry holds its key (its place in a list), its
    value, and its epoch: of a list the timestamp, 0 if there is none, else the key.
    """
    value = docs.select(F.col(item_id).alias("item_id"), F.try_parse_json(F.col(doc)).alias("_v"))
    value = value.select("item_id", _field(F.col("_v"), "data", "array<variant>").alias("_list"),
                         _field(F.col("_v"), "data", "map<string,variant>").alias("_map"))

    def listed(e: Column, at: Column) -> Column:
        given = _field(e, "timestamp", "variant")
        epoch = F.when(given.isNull() | F.is_variant_null(given), F.lit(0).cast("bigint")).otherwise(_field(e, "timestamp"))
        return F.struct(at.cast("string").alias("key"), e.alias("value"), F.when(_is_object(e), epoch).alias("epoch"))

    def mapped(e: Column) -> Column:
        return F.struct(e["key"].alias("key"), e["value"].alias("value"),
                        F.when(_is_object(e["value"]), e["key"].try_cast("bigint")).alias("epoch"))

    entries = F.coalesce(F.transform("_list", listed), F.transform(F.map_entries("_map"), mapped))
    return value.select("item_id", entries.isNotNull().alias("readable"), F.col("_list").isNotNull().alias("in_list"),
                        entries.alias("entries"))


def points_of(parsed: DataFrame) -> DataFrame:
    """One row per readable entry. Only lists carry volumes."""
    rows = parsed.select("item_id", "in_list", F.inline(F.filter("entries", lambda e: e["epoch"].isNotNull())))
    return rows.select(
        "item_id", epoch_to_timestamp(F.col("epoch")).alias("timestamp"), *[_field(F.col("value"), f).alias(f) for f in PRICES],
        *[F.when(F.col("in_list"), _field(F.col("value"), f)).alias(f) for f in VOLUMES])


def rejects_of(parsed: DataFrame) -> DataFrame:
    """(item_id, reason, place) of what :func:`points_of` leaves out: a ``document`` that is no JSON or has no data, an
    ``entry`` that is no object or whose timestamp is no integer, a ``key`` that is no integer."""
    reason = F.when(F.col("in_list"), "entry").otherwise(
        F.when(F.col("key").try_cast("bigint").isNull(), "key").otherwise("entry"))
    entries = parsed.select("item_id", "in_list", F.inline(F.filter("entries", lambda e: e["epoch"].isNull())))
    broken = parsed.where(~F.col("readable")).select(
        "item_id", F.lit("document").alias("reason"), F.lit(None).cast("string").alias("place"))
    return entries.select("item_id", reason.alias("reason"), F.col("key").alias("place")).unionByName(broken)


def parse_documents(docs: DataFrame, doc: str = "doc", item_id: str = "item_id") -> DataFrame:
    """One row per price point of documents in either form."""
    return points_of(parsed_documents(docs, doc, item_id))


def rejected(docs: DataFrame, doc: str = "doc", item_id: str = "item_id") -> DataFrame:
    """What :func:`parse_documents` leaves out, as :func:`rejects_of` names it."""
    return rejects_of(parsed_documents(docs, doc, item_id))


def timeseries_documents(spark: SparkSession, path: str, step: str = "1h") -> DataFrame:
    """(item_id, doc) of all ``timeseries_<item>_<step>.json`` files below ``path``; the item id is part of the name."""
    files = spark.read.option("pathGlobFilter", f"timeseries_*_{step}.json").text(path, wholetext=True)
    item = F.regexp_extract("_metadata.file_name", r"timeseries_(\d+)_", 1).cast("bigint")
    return files.select(item.alias("item_id"), F.col("value").alias("doc"))


def read_timeseries_files(spark: SparkSession, path: str, step: str = "1h") -> DataFrame:
    """The price points of all landed files; :func:`rejected` of the same documents has the rest."""
    return parse_documents(timeseries_documents(spark, path, step))


def read_item_mapping(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The item list: a JSON array per file, or one object per line with ``multiline=False``."""
    return spark.read.schema(ITEM_MAPPING).option("multiLine", multiline).json(path)


def read_selection(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw selection document, or None when the path is missing."""
    schema = "metadata struct<generated_at: string, total_items: bigint, selection_criteria: string, version: string>," \
             " items array<struct<id: bigint, name: string, ranking_score: double, selection_reason: string>>"
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_selection(spark: SparkSession, path: str, fallback: Sequence[int] = SELECTION_FALLBACK_IDS) -> DataFrame:
    """(pos, item_id) of the stored selection; the fallback list when the document is
    missing, unreadable or empty."""
    backup = id_frame(spark, fallback)
    document = read_selection(spark, path)
    if document is None:
        return backup
    ids = document.select(F.posexplode("items")).select(
        F.col("pos").cast("bigint").alias("pos"), F.col("col.id").alias("item_id")
    ).where("item_id IS NOT NULL")
    found = ids.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ids.unionByName(backup.where(found == 0))


def resolve_items(spark: SparkSession, text: str, fallback: Sequence[int] = SELECTION_FALLBACK_IDS) -> DataFrame:
    """(pos, item_id) for an items argument: '@selection-path', '1,2,3' or '7'."""
    parsed = parse_item_list(text, fallback)
    if isinstance(parsed, str):
        return load_selection(spark, parsed, fallback)
    return id_frame(spark, parsed)
