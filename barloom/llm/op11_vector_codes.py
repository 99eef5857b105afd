"""Vector code compression: product-quantised codes by k-means with adaptive distance bounds.

A vector is cut into ``PARTS`` equal parts; each part position has a codebook of ``ENTRIES`` entries, trained on all rows by
``ROUNDS`` rounds of assignment and integer averaging. Everything that decides is an integer: components are
floor(4096 * x), distances are exact squared sums, averages are rounded down.

Between rounds every part keeps, in a stored table, its b closest entries, an upper bound of the distance to the first, ordered
lower bounds of the distances to the others, and one outer bound of all entries it does not list (Drake and Hamerly). When
entries move, bounds give way by the length of the move. A part whose upper bound stays below its lower bounds keeps its
entry unseen. Otherwise its exact integer distances are taken: to its own entry, then to the listed entries up to the first
bound that settles the matter, then to all. b is kept per part position and shrinks from a quarter of the entries to an eighth, to
the rank that settled nearly all parts of the last round. Bounds are widened by more than the rounding of their floats.

One pass over the rows per round: tasks write the new state and, as one more row each, the change of the sums and counts that
their rows caused. Only these sums, ``ENTRIES`` x (width + ``PARTS``) numbers, reach the driver. A state is dropped once the next
one is stored. An executor that is lost costs its part of one round.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; of the rest, the first vector by id that
is not empty sets the width, and a row of another width comes out with null code and error. A width that is not a multiple of
``PARTS`` is an error, as are components of 65,536 and more in size, whose squares may leave 64 bits. Rows without an id
come last in the order that picks the first entries; equal ids go by their vectors. With fewer rows than entries there are so many entries;
repeated rows come out once each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored
from barloom.session import remove_path, scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Share of the uncertain parts that the kept entries should settle.
SETTLED = 0.95
#: Components of this size and more are refused.
LARGEST = 1 << 28


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(fine, F.lit(False))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(4096 * x)."""
    flat = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), width)
    out = np.floor(flat * SCALE)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError("components of 65,536 and more are not coded")
    return out.astype(np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    far = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if x.shape[1] * (2 * far) ** 2 < 1 << 52:  # whole numbers that a double holds
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def one_squared(x: np.ndarray, entries: np.ndarray, which: np.ndarray) -> np.ndarray:
    return ((x - entries[which]) ** 2).sum(1)


def below(x: np.ndarray) -> np.ndarray:
    """A little less than ``x``, at least 0."""
    return np.maximum(x * (1 - 2.0**-22) - 1e-6, 0)


def above(x: np.ndarray) -> np.ndarray:
    return x * (1 + 2.0**-22) + 1e-6


def nearest(d: np.ndarray, b: int):
    """The ``b`` first entries by (distance, index), an upper bound and lower bounds (the last one the outer bound)."""
    order = np.argsort(d, axis=1, kind="stable")
    root = np.sqrt(np.take_along_axis(d, order, 1).astype(float))
    bounds = np.full((len(d), b + 1), np.inf)
    bounds[:, 0] = above(root[:, 0])
    there = min(b, root.shape[1] - 1)
    bounds[:, 1 : there + 1] = below(root[:, 1 : there + 1])
    ids = np.zeros((len(d), b), np.uint8)
    ids[:, : min(b, order.shape[1])] = order[:, :b]
    return ids, bounds


def reassign(x: np.ndarray, entries: np.ndarray, ids: np.ndarray, bounds: np.ndarray, moves: np.ndarray, b: int):
    """New (ids, bounds) of ``b`` entries after the entries moved, and how many rows each rank settled: 0 unseen,
    1 by the distance to its own entry, z by z distances, the last one by all."""
    old = ids.shape[1]
    seen = np.zeros(old + 2, np.int64)
    ids, bounds = ids.copy(), bounds.astype(float)
    listed = min(old, len(entries))
    bounds[:, 0] += moves[ids[:, 0]]
    bounds[:, old] -= moves.max(initial=0)
    for z in range(listed - 1, 0, -1):
        bounds[:, z] = np.minimum(bounds[:, z] - moves[ids[:, z]], bounds[:, z + 1])
    open_ = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    seen[0] = len(x) - len(open_)
    bounds[open_, 0] = above(np.sqrt(one_squared(x[open_], entries, ids[open_, 0]).astype(float)))
    stay = bounds[open_, 0] < bounds[open_, 1]
    seen[1] = stay.sum()
    open_ = open_[~stay]
    for z in range(2, listed + 1):
        if not len(open_):
            break
        done = bounds[open_, 0] < bounds[open_, z]
        rows = open_[done]
        if len(rows):
            near = np.sort(ids[rows, :z], axis=1)  # by index, so that a stable order by distance leaves ties to the lower
            d = np.stack([one_squared(x[rows], entries, near[:, i]) for i in range(z)], axis=1)
            order = np.argsort(d, axis=1, kind="stable")
            root = np.sqrt(np.take_along_axis(d, order, 1).astype(float))
            ids[rows, :z] = np.take_along_axis(near, order, 1)
            bounds[rows, 0] = above(root[:, 0])
            bounds[rows, 1:z] = np.minimum(below(root[:, 1:]), bounds[rows, z][:, None])
            seen[z] = len(rows)
        open_ = open_[~done]
    if b < old:  # fewer entries are kept: the first bound of the left-out ones is the outer bound
        ids, bounds = ids[:, :b], bounds[:, : b + 1]
    if len(open_):
        ids[open_], bounds[open_] = nearest(squared(x[open_], entries), b)
        seen[old + 1] = len(open_)
    bounds[:, 1:] = np.maximum(bounds[:, 1:], 0)
    return ids, bounds, seen


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    size = rows.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpacked(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


class Training:
    """The codebooks and how many entries are kept at each part position."""

    def __init__(self, seeds: np.ndarray):
        self.books = seeds.reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()  # part, entry, position
        self.sums = np.zeros_like(self.books)
        self.counts = np.zeros(self.books.shape[:2], np.int64)
        self.moves = np.zeros(self.books.shape[:2])
        self.kept = [max(ENTRIES // 4, 1)] * PARTS
        self.next_kept = list(self.kept)

    @property
    def width(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def update(self, change: np.ndarray, ranks: list[np.ndarray]) -> bool:
        """Take the changes of sums and counts; move the entries. False if none moved."""
        cells = self.sums.size
        self.sums += change[:cells].reshape(self.sums.shape)
        self.counts += change[cells:].reshape(self.counts.shape)
        new = np.where(self.counts[:, :, None] > 0, self.sums // np.maximum(self.counts, 1)[:, :, None], self.books)
        self.moves = above(np.sqrt(((new - self.books) ** 2).sum(2).astype(float)))
        moved = bool((new != self.books).any())
        self.books = new
        self.kept = list(self.next_kept)
        for p, seen in enumerate(ranks):
            tried = np.cumsum(seen[2:])  # ranks 2, 3, ..., all
            if len(tried) and tried[-1]:
                rank = 2 + int(np.searchsorted(tried, SETTLED * tried[-1]))
                self.next_kept[p] = max(ENTRIES // 8, min(self.kept[p], rank))
        return moved

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _state_type(id_type: str, label_type: str) -> str:
    return f"vec_id {id_type}, label {label_type}, vec array<int>, near binary, bounds binary, summary array<bigint>"


def _assigned(batch: pa.RecordBatch, t: Training):
    """Integer vectors, and ids, bounds, old ids and ranks of each part, of a batch of raw rows or of states."""
    raw = "vec" not in batch.schema.names
    x = integers(batch.column("embedding"), t.width) if raw else np.asarray(
        batch.column("vec").flatten()).reshape(len(batch), t.width).astype(np.int64)
    cut, out = x.reshape(len(x), PARTS, -1), []
    if not raw:
        near, bounds = unpacked(batch.column("near"), np.uint8), unpacked(batch.column("bounds"), np.float32)
    at = 0
    for p in range(PARTS):
        if raw:
            ids, limits = nearest(squared(cut[:, p], t.books[p]), t.kept[p])
            out.append((ids, limits, None, np.zeros(t.kept[p] + 2, np.int64)))
            continue
        b = t.kept[p]
        old = near[:, at : at + b]
        ids, limits, seen = reassign(cut[:, p], t.books[p], old, bounds[:, at + p : at + p + b + 1], t.moves[p], t.next_kept[p])
        out.append((ids, limits, old[:, 0], seen))
        at += b
    return x, out


def _stepper(t: Training):
    def run(batches):
        change, counts = np.zeros_like(t.sums), np.zeros_like(t.counts)
        ranks, schema = None, None
        for batch in batches:
            schema = schema or pa.schema([
                batch.schema.field("vec_id"), batch.schema.field("label"), ("vec", pa.list_(pa.int32())),
                ("near", pa.binary()), ("bounds", pa.binary()), ("summary", pa.list_(pa.int64()))])
            n = len(batch)
            if not n:
                continue
            x, parts = _assigned(batch, t)
            for p, (ids, _, old, _) in enumerate(parts):
                part, new = x.reshape(n, PARTS, -1)[:, p], ids[:, 0]
                moved = np.arange(n) if old is None else np.flatnonzero(old != new)
                k = change.shape[1]
                for j in range(part.shape[1]):
                    change[p, :, j] += np.bincount(new[moved], part[moved, j], k).astype(np.int64)
                counts[p] += np.bincount(new[moved], minlength=k)
                if old is not None:
                    for j in range(part.shape[1]):
                        change[p, :, j] -= np.bincount(old[moved], part[moved, j], k).astype(np.int64)
                    counts[p] -= np.bincount(old[moved], minlength=k)
            seen = np.concatenate([s for _, _, _, s in parts])
            ranks = seen if ranks is None else ranks + seen
            near = np.concatenate([ids for ids, _, _, _ in parts], axis=1)
            bounds = np.concatenate([
                np.concatenate([above(b[:, :1]), below(b[:, 1:])], axis=1) for _, b, _, _ in parts], axis=1)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(x.shape[1]))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.ListArray.from_arrays(offsets, pa.array(x.ravel().astype(np.int32))), packed(near),
                packed(bounds.astype(np.float32)), pa.nulls(n, pa.list_(pa.int64()))], schema=schema)
        if ranks is not None:
            summary = np.concatenate([change.ravel(), counts.ravel(), ranks])
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, f.type) for f in list(schema)[:-1]), pa.array([summary.tolist()], schema.field("summary").type)],
                schema=schema)

    return run


def _coder(t: Training):
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, parts = _assigned(batch, t)
            codes = np.stack([ids[:, 0] for ids, _, _, _ in parts], axis=1)
            error = sum(one_squared(x.reshape(len(x), PARTS, -1)[:, p], t.books[p], codes[:, p]) for p in range(PARTS))
            text, step = codes.tobytes().hex(), 2 * PARTS
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])

    return run


def _first(rows: DataFrame, n: int) -> list:
    return rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(n).collect()


def vector_codes(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Training | None]:
    """Codes of the usable rows of (vec_id, embedding, label), as (vec_id, label, code, error), and the training that
    made them (None without any row that can be coded)."""
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", "label", "embedding").where(usable(F.col("embedding")))
    first = _first(rows.where(F.size("embedding") > 0), ENTRIES)
    if not first:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                           F.lit(None).cast("long").alias("error")), None
    width = len(first[0].embedding)
    if width % PARTS:
        raise ValueError(f"vectors of {width} components do not cut into {PARTS} equal parts")
    same = rows.where(F.size("embedding") == width)
    if any(len(r.embedding) != width for r in first):
        first = _first(same, ENTRIES)
    t = Training(integers(pa.array([r.embedding for r in first]), width))
    types = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    state, before = same, None
    for _ in range(rounds):
        path = scratch_path(spark, "codes")
        state.mapInArrow(_stepper(t), _state_type(*types)).write.parquet(path)
        state = spark.read.schema(_state_type(*types)).parquet(path)
        if before:
            remove_path(spark, before)
        sums = (state.select(F.posexplode("summary").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
                .collect())
        total = np.zeros(len(sums), np.int64)
        for r in sums:
            total[r.at] = r.x
        cells, ranks, at = t.sums.size + t.counts.size, [], t.sums.size + t.counts.size
        for b in t.kept:
            ranks.append(total[at : at + b + 2])
            at += b + 2
        before, state = path, state.where("vec is not null").drop("summary")
        if not t.update(total[:cells], ranks):
            break
    coded = state.mapInArrow(_coder(t), "vec_id {}, label {}, code string, error bigint".format(*types))
    other = rows.where(F.size("embedding") != width).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(other), t


def vector_code_report(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per usable vector: vec_id, code, error, label_error (summed over its label), codebooks_sha256."""
    coded, t = vector_codes(embeddings, rounds)
    coded = stored(coded, "coded")
    by_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    by_label = bounded(by_label.withColumnRenamed("label", "of"))
    digest = t.digest() if t else hashlib.sha256(b"").hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
