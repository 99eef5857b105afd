"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts are folded (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. An item's windows are its runs of ``WINDOW``
words; a shorter item is one window. A window's fingerprint is the smallest hash of its k-grams, k being half of it, so
that every shared window has a shared fingerprint while neighbouring windows mostly share theirs. Documents that hold a
fingerprint of the benchmark are read again; there every window with such a fingerprint is compared word by word, and
overlapping occurrences extend each other to the words that are hit.

Defined cases: null and empty texts have no words; items without words have no windows; repeated items count by their
id; repeated rows of documents come out once each; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored

WINDOW = 10
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # without other letters lower() does the same and is much faster
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(folded, SEPARATOR), "")


def fingerprints(ws: Column, n: int) -> Column:
    """The fingerprint of every window of ``n`` words; none if the words are fewer."""
    k = max(1, n // 2)
    width = n - k + 1

    def lowest(grams: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(grams) - width), lambda i: F.least(
            *[F.get(grams, i + j) for j in range(width)]) if width > 1 else F.get(grams, i))

    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - k),
                           lambda i: F.xxhash64(F.lit(n), *[F.get(w, i + j) for j in range(k)]))

    return let(ws, lambda w: F.when(F.size(w) >= n, let(hashed(w), lowest)).otherwise(F.array().cast("array<bigint>")))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, n, span, print): the distinct windows of each item."""
    cut = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    cut = cut.withColumn("n", F.least(F.size("w"), F.lit(window)))
    runs = cut.select("item_id", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("run"))
    prints = F.coalesce(*[F.when(F.col("n") == n, fingerprints(F.col("run"), n)[0]) for n in range(1, window + 1)])
    return runs.select("item_id", "n", F.array_join("run", " ").alias("span"), prints.alias("print")).distinct()


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of an item's window), n_items (items with
    occurring windows), items_sha256 (of their ids, sorted as strings, comma-joined), contaminated (n_hit > 0)."""
    windows = stored(item_windows(items, item_col, item_text_col, window), "item-windows")
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most ``window`` numbers
    prints = bounded(stored(windows.select("print").distinct(), "item-prints"))

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    same = F.xxhash64("text").alias("same")  # tells rows apart that share an id
    none = F.array().cast("array<bigint>")
    cut = docs.select("doc_id", same, words(F.col("text")).alias("w"))
    found = F.array_distinct(F.concat(none, *[fingerprints(F.col("w"), n) for n in lengths]))
    base = stored(cut.select("doc_id", "same", F.size("w").cast("long").alias("n_words"), found.alias("prints")),
                  "prints")

    hit = (base.select("doc_id", "same", F.explode("prints").alias("print")).join(prints, "print")
           .groupBy("doc_id", "same").agg(F.collect_set("print").alias("shared")))
    hit = bounded(stored(hit, "suspects"), 500_000).select(
        F.col("doc_id").alias("id"), F.col("same").alias("text_hash"), "shared")
    suspects = docs.join(hit, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_hash")))

    def spans(n: int) -> Column:
        """The windows of ``n`` words whose fingerprint is shared."""
        at = F.filter(F.transform(fingerprints(F.col("w"), n), lambda p, i: F.struct(
            p.alias("p"), i.alias("i"))), lambda s: F.array_contains("shared", s.p))
        return F.transform(at, lambda s: F.struct(
            F.lit(n).alias("n"), s.i.alias("i"), F.array_join(F.slice("w", s.i + 1, n), " ").alias("span")))

    empty = F.array().cast("array<struct<n:int,i:int,span:string>>")
    there = (suspects.select("doc_id", F.col("text_hash").alias("same"), "shared", words(F.col("text")).alias("w"))
             .select("doc_id", "same", F.explode(F.concat(empty, *[spans(n) for n in lengths])).alias("s"))
             .select("doc_id", "same", "s.*").distinct())
    hits = stored(there.join(windows.select("item_id", "n", "span"), ["n", "span"])
                  .select("doc_id", "same", "i", "n", "item_id"), "hits")

    key = ["doc_id", "same"]
    runs = hits.groupBy(*key, "i").agg(F.max(F.col("i") + F.col("n")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    covered = (runs.withColumn("from", F.greatest("i", F.coalesce(before, "i")))
               .groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit")))
    named = (hits.select(*key, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*key)
             .agg(F.sort_array(F.collect_list("item")).alias("items")))
    found = covered.join(named, F.expr("true") & covered.doc_id.eqNullSafe(named.doc_id) & (covered.same == named.same))
    found = found.select(covered.doc_id.alias("id"), covered.same.alias("text_hash"), "n_hit", "items")
    rows = base.select(*key, "n_words").join(
        found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same").eqNullSafe(F.col("text_hash"))), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
