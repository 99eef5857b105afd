"""Helpers shared by the operators: tables, stored intermediates, word hashes, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path

#: Texts beyond this many bytes are hashed slice by slice.
SLICE_BYTES = 1 << 21

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of an input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: evaluated once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Texts go to Python in Arrow batches of about so many bytes; a worker holds a few copies of one.
BATCH_BYTES = 4 << 20


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; where the session has Spark's own, much larger bound of an Arrow batch, it gets ``BATCH_BYTES`` from now on."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == f"{64 << 20}b":
        conf.set(name, f"{BATCH_BYTES}b")
    return docs


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base & (2**64 - 1), np.uint64)
        steps[0] = 1
        have = _POWERS[str(base)] = np.multiply.accumulate(steps)
    return have[:n]


def _slices(raw: bytes):
    at = 0
    while len(raw) - at > SLICE_BYTES:
        cut = max(raw.rfind(b" ", at, at + SLICE_BYTES), raw.rfind(b"\n", at, at + SLICE_BYTES))
        cut = at + SLICE_BYTES if cut <= at else cut
        if not _WHITE[raw[cut]]:  # one word longer than a slice: go on to its end
            rest = [x for x in (raw.find(b" ", cut), raw.find(b"\n", cut)) if x >= 0]
            cut = min(rest, default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def _words(part: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begins and hashes of the words of a piece of text."""
    codes = np.frombuffer(part, np.uint8)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_WHITE[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[codes] * _powers(_BASE, len(codes)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(codes))[starts]
    return starts, mix(words ^ (ends - starts).astype(np.uint64))


def word_hashes(raw: bytes, lower: bool) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z folded if ``lower``."""
    return np.concatenate([np.zeros(0, np.uint64)] + [_words(part, lower)[1] for part in _slices(raw)])


def words_of(raws: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of several texts, one after the other, and how many each has."""
    if len(raws) == 1:
        words = word_hashes(raws[0], lower)
        return words, np.array([len(words)])
    starts, words = _words(b"\n".join(raws), lower)
    begins = np.cumsum([0] + [len(raw) + 1 for raw in raws])
    return words, np.diff(np.searchsorted(starts, begins))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of the whole sequence when it is shorter."""
    n = min(n, len(words))
    if not n:
        return words
    if n > 8:  # the same sums, as differences
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _powers(_BASE_INVERSE, len(words)), out=sums[1:])
        out = (sums[n:] - sums[:-n]) * _powers(_BASE, len(words))[n - 1 :]
    else:
        out = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            out = out * np.uint64(_BASE) + words[i : i + len(out)]
    return mix(out ^ np.uint64(n))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs."""
    return np.ascontiguousarray(x).view(np.int64)


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of the undirected ``edges`` (u, v): one row (node, component) per node that has an
    edge, ``component`` being the smallest node.

    Alternating large and small stars: every node is attached to the smallest neighbour until the edges are stars.
    Neighbour minima are aggregated before the join, which AQE splits at hot nodes. Each round is a stored table.
    """
    step = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        step = stored(small.select(F.col("e.a").alias("u"), F.col("e.b").alias("v")).where("u <> v").distinct(),
                      "edges")
        state = step.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                         F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    stars = step.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


#: Up to so many rows of ids, a filter side is sent to every executor; beyond it the join is shuffled.
BROADCAST_ROWS = 4_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of a few numbers a row, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= rows else df


def texts(batch, column: str = "text"):
    """The UTF-8 texts of an Arrow batch, one at a time; null is empty."""
    for value in batch.column(column).cast("binary"):
        yield value.as_py() or b""


def first_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, the first by a hash of ``key``. Rows that cannot be among them stay behind."""
    order = F.xxhash64(key)
    total = df.count()
    if total > 4 * rows:  # twice as many as wanted come through, give or take a little
        df = df.where(F.pmod(order, F.lit(1 << 40)) < int((1 << 40) * 2 * rows / total))
    return df.orderBy(F.pmod(order, F.lit(1 << 40)), key).limit(rows)
