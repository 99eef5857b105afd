"""URL filter: rules first, else a logistic regression on hashed character n-grams of host and path.

The regression is trained from a small labelled URL table, ``LABELLED`` rows at most. Callers may pass their own; without
one, a table made by rule from term lists is used. Rules are a short configured list; the longest that fits decides.

Defined cases: a null url, or one without ``://``, has an empty host and path and is left to the regression; among equally
long rules block wins; repeated rows come out once each.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.op1_decontaminate import LOWER, UPPER

# fixed values: the rules of the query
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))

# fixed values: terms of the labelled table
SPAM_TERMS = "casino poker bets win free cheap pills loan ads track clicks prize lottery replica dating payday spam farm".split()
PLAIN_TERMS = "news blog docs wiki library school garden music travel science museum weather recipes history sport " \
              "health garage market".split()
LABELLED = 5000
BUCKETS, LENGTHS = 1 << 14, (3, 4, 5)
THRESHOLD = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    def part(n):
        return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))

    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule (verdict, rule) that fits, as a struct; null if none does."""
    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    return F.coalesce(*[F.when(fits(rule), F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")))
                        for verdict, rule in ordered], F.lit(None).cast("struct<verdict:string,rule:string>"))


def buckets(host: str, path: str) -> np.ndarray:
    """Hash buckets of the distinct n-grams of ``host`` and ``path``, each told apart."""
    grams = {f"{kind}{padded[i : i + n]}" for kind, text in (("h", host), ("p", path)) for padded in (f"^{text}$",)
             for n in LENGTHS for i in range(max(1, len(padded) - n + 1))}
    return np.unique(np.fromiter((crc32(g.encode()) % BUCKETS for g in grams), np.int64))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(host, path, label): pairs of terms as hosts, of either kind; 1 is to be blocked."""
    rows = []
    for label, terms in ((1, SPAM_TERMS), (0, PLAIN_TERMS)):
        for k, (a, b) in enumerate(itertools.permutations(terms, 2)):
            front, end = ("", "www.", "m.", "blog.")[k % 4], ("com", "net", "org")[k % 3]
            path = f"/{('en', 'de', 'fr', 'es')[k // 3 % 4]}/{k * 37 % 9973}" + ("", "/", ".html")[k % 3]
            rows.append((f"{front}{a}{'-' if k % 2 else ''}{b}.example.{end}", path, label))
    # names without a term: syllables, all plain
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    for k, (a, b) in enumerate(itertools.permutations(syllables, 2)):
        rows.append((f"{('', 'www.', 'm.', 'blog.')[k % 4]}{a}{b}{a if k % 2 else ''}.example.{('com', 'net', 'org')[k % 3]}",
                     f"/{('en', 'de', 'fr', 'es')[k % 4]}/{k * 53 % 9973}", 0))
    return spark.createDataFrame(rows, "host string, path string, label int")


def train(labelled: DataFrame, rounds: int = 400, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the buckets, and last the bias, from (host, path, label)."""
    rows = labelled.where("label is not null").orderBy("host", "path", "label").limit(LABELLED).collect()
    w = np.zeros(BUCKETS + 1)
    if len({r.label for r in rows}) < 2:
        return w
    found = [buckets(r.host or "", r.path or "") for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    at = np.concatenate(found)
    value = np.concatenate([np.full(len(f), 1 / np.sqrt(len(f))) for f in found])
    y = np.array([float(r.label) for r in rows])
    weight = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    square = np.zeros_like(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[at] * value, len(y)) + w[-1])))
        error = weight * (p - y) / len(y)
        gradient = np.append(np.bincount(at, error[row] * value, BUCKETS), error.sum()) + ridge * w
        square += gradient**2
        w -= rate * gradient / (np.sqrt(square) + 1e-9)
    return w


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule (null if none fits), verdict (allow or block), score (of the regression)."""
    weights = train(labelled_urls(pages.sparkSession) if labelled is None else labelled)

    def scored(batches):
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            z = []
            for host, path in zip(hosts, paths):
                at = buckets(host, path)
                z.append(weights[at].sum() / np.sqrt(len(at)) + weights[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"),
                 pa.array(1 / (1 + np.exp(-np.array(z, float))))], ["page_id", "host", "path", "score"])

    host, path = host_and_path(F.col("url"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(
        scored, f"page_id {id_type}, host string, path string, score double")
    rule = rule_of(rules, F.col("host"), F.col("path"))
    return rows.withColumn("r", rule).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")).alias("verdict"),
        "score")
