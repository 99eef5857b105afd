"""The registered queries of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import sqltext
from barloom.llm.common import table
from barloom.llm.op10_substring_dedup import substring_dedup
from barloom.llm.op11_vector_codes import vector_code_report
from barloom.llm.op12_prefix_trie import prefix_trie
from barloom.llm.op13_warc import archived
from barloom.llm.op1_decontaminate import contamination
from barloom.llm.op2_packing import pack
from barloom.llm.op3_passage_dedup import passages
from barloom.llm.op4_line_quality import line_quality
from barloom.llm.op5_language import language
from barloom.llm.op6_secret_scan import scan
from barloom.llm.op7_url_filter import url_filter
from barloom.llm.op8_license_scan import license_scan
from barloom.llm.op9_jaccard_join import jaccard_groups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return wrap


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark", "item_id", "text")


@register("op1_decontaminate", sqltext.DECONTAMINATE)
def op1(spark, sf_dir):
    return contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


@register("op9_jaccard_join", sqltext.JACCARD)
def op9(spark, sf_dir):
    return jaccard_groups(documents(spark, sf_dir))


@register("op5_language")
def op5(spark, sf_dir):
    return language(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@register("op6_secret_scan")
def op6(spark, sf_dir):
    return scan(documents(spark, sf_dir))


@register("op2_packing")
def op2(spark, sf_dir):
    return pack(documents(spark, sf_dir))


@register("op4_line_quality")
def op4(spark, sf_dir):
    return line_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "quality"))


@register("op7_url_filter")
def op7(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages", "page_id", "url"))


@register("op8_license_scan", sqltext.LICENSES)
def op8(spark, sf_dir):
    return license_scan(documents(spark, sf_dir))


@register("op10_substring_dedup")
def op10(spark, sf_dir):
    return substring_dedup(documents(spark, sf_dir))


@register("op3_passage_dedup")
def op3(spark, sf_dir):
    return passages(documents(spark, sf_dir))


@register("op11_vector_codes", sqltext.VECTOR_CODES)
def op11(spark, sf_dir):
    return vector_code_report(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@register("op12_prefix_trie", sqltext.PREFIX_TRIE)
def op12(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register("op13_warc", sqltext.WARC)
def op13(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages", "page_id", "url", "html"))
