"""Secret scan with a random forest against false positives, in DataFrame functions only.

Candidates are runs of at least ``SHORTEST`` characters ``[A-Za-z0-9+/_=.~-]`` that hold a digit, in words of whole texts.
Each is described by its length, the changes between character classes, shares of digits and capitals, distinct
characters, the share covered by dictionary words, marks of paths and addresses around it, and the words beside it.
A random forest trained on labelled findings gives the share of trees that call it a secret.

The labelled findings are ``FINDINGS`` rows at most, made by rule: keys and tokens of public formats in assignments, and
digests, identifiers, addresses, paths, names and placeholders as false positives. Callers may pass their own.

Defined cases: null and empty texts have no candidates; every occurrence of a repeated value is a finding; repeated rows
come out once each; very long words are candidates like others.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored

SHORTEST = 12
VALUE = r"[A-Za-z0-9+/_=.~-]{%d,}" % SHORTEST
#: Rows of labelled findings at most.
FINDINGS = 4000
TREES, DEPTH, SEED = 30, 7, 7
THRESHOLD = 0.5
MASK = "[SECRET]"

# fixed values: words that speak for and against a secret, and words that fill names and placeholders
KEY_WORDS = "token|secret|passw(or)?d|passwd|pwd|api_?key|apikey|auth|bearer|access_?key|private_?key|credential"
PLAIN_WORDS = "commit|sha1|sha256|md5|hash|digest|checksum|uuid|guid|id|revision|version|build|isbn|etag|file|path|see"
DICTIONARY = (
    "example sample test dummy placeholder your here change this that the and for with from name value user admin "
    "default none null true false main index image photo page news article blog post home data file files path "
    "local public static build version release report document section chapter table figure mail server client "
    "config settings model train token secret key password"
).split()

FEATURES = ["length", "changes", "digits", "capitals", "symbols", "distinct", "covered", "slashes", "address",
            "assigned", "quoted", "key_word", "plain_word"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, same, at, word, before, after) of each word that holds a candidate; ``before`` has two words."""
    split = docs.select("doc_id", F.xxhash64("text").alias("same"),
                        F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+").alias("w"))
    fits = F.transform(F.col("w"), lambda w, i: F.when(
        (F.length(w) >= SHORTEST) & w.rlike(r"\d") & w.rlike(VALUE), i))
    around = F.transform(F.filter(fits, lambda i: i.isNotNull()), lambda i: F.struct(
        i.alias("at"), F.get("w", i).alias("word"),
        F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1)).alias("before"), F.get("w", i + 1).alias("after")))
    return split.select("doc_id", "same", F.explode(around).alias("c")).select("doc_id", "same", "c.*")


def with_values(words: DataFrame) -> DataFrame:
    """One row per candidate: the word cut at each run of value characters that holds a digit."""
    runs = F.filter(F.regexp_extract_all("word", F.lit(f"({VALUE})"), 1), lambda v: v.rlike(r"\d"))
    return (words.select("*", F.explode(F.transform(runs, lambda v: F.regexp_replace(v, r"^[=./]+|[=.]+$", "")))
                         .alias("raw"))
            # key=value in one word: the value is what follows
            .withColumn("value", F.regexp_extract("raw", r"([^=]+)$", 1)).where(F.length("value") >= SHORTEST))


def described(found: DataFrame) -> DataFrame:
    """``found`` (word, before, after, value) with the forest's features."""
    v, n = F.col("value"), F.length("value").cast("double")
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "+/_=.~-", "_______")
    words = F.array(*[F.lit(w) for w in DICTIONARY])
    pieces = F.filter(F.regexp_extract_all("value", F.lit("([A-Za-z]{3,})"), 1),
                      lambda p: F.array_contains(words, F.lower(p)))
    left = F.lower(F.concat_ws(" ", "before", F.expr("substring_index(word, value, 1)")))
    columns = {
        "length": n,
        "changes": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n,
        "digits": F.length(F.regexp_replace(v, "[^0-9]", "")) / n,
        "capitals": F.length(F.regexp_replace(v, "[^A-Z]", "")) / n,
        "symbols": F.length(F.regexp_replace(v, "[A-Za-z0-9]", "")) / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))).cast("double"),
        "covered": F.length(F.array_join(pieces, "")) / n,
        "slashes": F.length(F.regexp_replace("word", "[^/]", "")).cast("double"),
        "address": F.col("word").rlike(r"://|@|www\.|\.(com|org|net|html?|php|png|jpg|py|txt)\b"),
        "assigned": left.rlike(r"[=:]\W*$|bearer\W*$"),
        "quoted": F.col("word").rlike("[\"'`]"),
        "key_word": left.rlike(rf"(^|[^a-z])\w*({KEY_WORDS})\w*\W*$"),
        "plain_word": left.rlike(rf"(^|[^a-z])({PLAIN_WORDS})\W*$"),
    }
    return found.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(k) for k, c in columns.items()])


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """(before, word, after, value, label): values drawn by hash into public formats and into usual false alarms."""
    def text(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 512)

    def pick(salt: str, *options: str) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in options]),
                            (F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(options))) + 1).cast("int"))

    hexes = text("a")
    base64 = F.translate(F.base64(F.unhex(text("b"))), "\r\n", "")
    size = (20 + F.pmod(F.xxhash64(F.lit("n"), "id"), F.lit(45))).cast("int")
    key = pick("key", "token", "secret", "password", "api_key", "apikey", "auth_token", "access_key", "client_secret",
               "TOKEN", "private_key")
    plain = pick("plain", "commit", "sha1", "md5", "digest", "checksum", "uuid", "id", "revision", "build", "see",
                 "and", "the", "with", "of", "la", "die", "que")
    # fixed values: prefixes of public key formats
    secret = F.element_at(F.array(
        F.substr(hexes, F.lit(1), size), F.substr(hexes, F.lit(1), F.lit(40)), F.upper(F.substr(hexes, F.lit(1), size)),
        F.substr(base64, F.lit(1), size), F.concat(F.lit("AKIA"), F.upper(F.substr(hexes, F.lit(1), F.lit(16)))),
        F.concat(F.lit("ghp_"), F.substr(F.translate(base64, "+/=", "abc"), F.lit(1), F.lit(36))),
        F.concat(F.lit("sk-"), F.substr(F.translate(base64, "+/=", "abc"), F.lit(1), F.lit(44)))),
        (F.pmod(F.xxhash64(F.lit("kind"), "id"), F.lit(7)) + 1).cast("int"))
    uuid = F.regexp_replace(F.substr(hexes, F.lit(1), F.lit(32)), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    digits = F.translate(F.substr(hexes, F.lit(1), F.lit(16)), "abcdef", "123456")
    alarm = F.element_at(F.array(
        F.substr(hexes, F.lit(1), F.lit(40)), F.substr(hexes, F.lit(1), F.lit(32)), uuid, digits,
        F.concat(pick("u", "the", "an", "of"), F.lit("."), F.substr(digits, F.lit(1), F.lit(2)),
                 F.lit("@mail"), F.substr(digits, F.lit(3), F.lit(1)), F.lit(".example.com")),
        F.concat(F.lit("/static/images/photo-"), F.substr(digits, F.lit(1), F.lit(6)), F.lit(".jpg")),
        F.concat(F.lit("https://www.example.org/news/article-"), F.substr(digits, F.lit(1), F.lit(8))),
        F.concat(F.lit("release-version-"), F.substr(digits, F.lit(1), F.lit(4))),
        F.concat(F.lit("your_token_here_"), F.substr(digits, F.lit(1), F.lit(3))),
        F.concat_ws(".", F.substr(digits, F.lit(1), F.lit(3)), F.substr(digits, F.lit(4), F.lit(3)),
                    F.substr(digits, F.lit(7), F.lit(3)), F.substr(digits, F.lit(10), F.lit(3)))),
        (F.pmod(F.xxhash64(F.lit("kind"), "id"), F.lit(10)) + 1).cast("int"))
    true = F.pmod("id", F.lit(2)) == 0
    bare = F.pmod(F.xxhash64(F.lit("bare"), "id"), F.lit(8))
    named = alarm.rlike("^(https:|/static|release|the[.]|an[.]|of[.])")
    before = (F.when(true & secret.rlike("^(AKIA|ghp_|sk-)") & (bare == 5), F.concat_ws(" ", F.lit("the"), plain))
              .when(true & (bare < 6), F.concat(key, F.lit(" ="))).when(true & (bare == 6), F.concat(key, F.lit(":")))
              .when(true, F.lit("Authorization: Bearer"))
              # placeholders, addresses and paths also stand where secrets do
              .when(alarm.startswith("your_") | (named & (bare > 3)), F.concat(key, F.lit(" =")))
              .when(bare < 2, F.concat(plain, F.lit(":"))).otherwise(F.concat_ws(" ", F.lit("the"), plain)))
    value = F.when(true, secret).otherwise(alarm)
    quote = F.when(true & (bare < 5) | ~true & (alarm.startswith("your_") | (bare == 4)), F.lit('"')).otherwise(F.lit(""))
    return spark.range(0, rows, 1, 1).select(
        before.alias("before"), F.concat(quote, value, quote).alias("word"), F.lit("and").alias("after"),
        F.regexp_extract(value, f"({VALUE})", 1).alias("value"), true.cast("double").alias("label"))


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A forest of ``findings`` (before, word, after, value, label), a bounded table that is one partition."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        described(findings.where(F.length("value") >= SHORTEST)))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
                                  maxBins=64).fit(rows.select("features", "label"))


def findings(docs: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate of ``docs`` (doc_id, text): doc_id, same (hash of the text), at, value, score, secret."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described(with_values(candidates(docs))))
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "same", "at", "value", "score", (F.col("score") >= threshold).alias("secret"))


def scan(docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """Per document: doc_id, n_candidates, n_secrets, max_score (null without candidates), secrets_sha256 (of the
    distinct secrets, sorted, one a line)."""
    docs = docs.select("doc_id", "text")
    model = model or train(labelled_findings(docs.sparkSession))
    per = findings(docs, model).groupBy("doc_id", "same").agg(
        F.count("*").alias("c"), F.sum(F.col("secret").cast("long")).alias("s"), F.max("score").alias("max_score"),
        F.sort_array(F.collect_set(F.when(F.col("secret"), F.col("value")))).alias("values"))
    per = per.withColumnRenamed("doc_id", "id").withColumnRenamed("same", "text_hash")
    rows = docs.select("doc_id", F.xxhash64("text").alias("same"))
    return rows.join(
        per, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("text_hash")), "left"
    ).select(
        "doc_id", F.coalesce("c", F.lit(0)).cast("long").alias("n_candidates"),
        F.coalesce("s", F.lit(0)).cast("long").alias("n_secrets"), "max_score",
        F.sha2(F.coalesce(F.array_join("values", "\n"), F.lit("")), 256).alias("secrets_sha256"))


def redact(docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK``; all rows and columns stay."""
    model = model or train(labelled_findings(docs.sparkSession))
    per = findings(docs.select("doc_id", "text"), model).where("secret").groupBy("doc_id", "same").agg(
        F.reverse(F.array_sort(F.collect_set(F.struct(F.length("value").alias("n"), "value")))).alias("values"))
    per = bounded(stored(per, "secrets"), 500_000).select(
        F.col("doc_id").alias("_id"), F.col("same").alias("_same"), F.col("values.value").alias("_values"))
    joined = docs.join(
        per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_same")), "left")
    masked = F.aggregate("_values", F.col("text"), lambda t, v: F.replace(t, v, F.lit(MASK)))
    return joined.select(*[
        (F.when(F.col("_id").isNull() & F.col("_values").isNull(), F.col("text")).otherwise(masked).alias("text")
         if c == "text" else docs[c]) for c in docs.columns])
