"""Prefix trie of conversations by padded turn-id matrices.

A turn is known by half of the SHA-256 of its role and text, a conversation by the run of its turns' ids. Conversations are dealt to
shards by ranges of (ids, conv_id) and sorted there, so that the members of a node lie together, also across shards, and so
that neither a common first turn nor a crowd of equal conversations ends in one task. A task takes its sorted rows in blocks
of bounded size. In a block turn ids become small integers in a matrix padded with -1, rows are put in order by a lexsort, and the
change masks between neighbouring rows are OR-accumulated over the columns: a row starts a node at every depth where its
mask is set. ``reduceat`` over those starts aggregates every depth.

All figures of a node are sums (or a minimum) over the rows below it, given each row's common prefix with the row before it and
whether the row after it goes on from it:

* a row starts a child of the node at depth d if the common prefix is at most d and the row is longer than d;
* a row saves, for the node at depth d, the code points of its turns d to the end of the common prefix;
* a row is a leaf if the next row does not begin with it.

So nodes cut by the border of a block or shard are written as parts, under a digest of their prefix, and are added up by
one aggregate. What a shard's first row has in common with the last row of the shard before it is found by a join of neighbouring
shards and enters the same aggregate as a correction. The list of conversations that end at a node is hashed in the block, or, for
nodes in parts, from the parts' lists in order, one after the other, without building the whole list.

Defined cases: rows without conv_id belong to no conversation; null role or text is empty; turns are ordered with nulls first,
equal turns by their ids, repeated rows stay; ids are taken modulo as Spark's ``%`` does (the sign of the id); a conversation without
turns ends at the root; an empty table has no nodes. A conversation is one row of 20 bytes a turn and fits into a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored

#: Turns of a shard, and cells of a matrix, about.
SHARD_TURNS, BLOCK_CELLS = 1 << 20, 1 << 18
#: Conversations of a block of ids share up to so many first turns.
IDS_PER_BLOCK, SHARED = 100, 5
#: Bytes of a turn's id.
ID = 16
NOTHING = hashlib.sha256(b"").hexdigest()
FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")

_FIELDS = [
    ("kind", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), *((f, pa.int64()) for f in FIGURES), ("ends_sha256", pa.string()), ("ends", pa.string()),
    ("shard", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("sizes", pa.list_(pa.int32())),
]
_SCHEMA = pa.schema(_FIELDS)
_TYPES = ("kind string, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string, shard long, first binary, "
          "last binary, sizes array<int>")


def _rows(kind: str, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([kind] * n, t) if name == "kind" else pa.array(columns[name], t) if name in columns else pa.nulls(n, t)
        for name, t in _FIELDS], schema=_SCHEMA)


# ---- conversations ---------------------------------------------------------------------------

def original(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, ids (its turns' ids, joined), sizes (code points of its turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_id = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", turn_id.alias("id"), F.char_length(text).alias("size")).alias("t"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations with the first turns of their block's head in place of their own: conv_id, ids, sizes."""
    convs = stored(original(turns), "conversations")
    head = convs.where(F.col("conv_id") % IDS_PER_BLOCK == 0).select(
        F.col("conv_id").alias("head"), F.substring("ids", 1, ID * SHARED).alias("head_ids"),
        F.slice("sizes", 1, SHARED).alias("head_sizes"))
    head = stored(head, "heads")
    shared = (F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)).cast("int")
    rows = convs.withColumn("h", shared).join(
        bounded(head, 500_000), F.col("conv_id") - F.col("conv_id") % IDS_PER_BLOCK == F.col("head"), "left")
    head_ids = F.coalesce(F.substring(F.col("head_ids"), F.lit(1), F.col("h") * ID), F.lit(b""))
    head_sizes = F.coalesce(F.slice("head_sizes", F.lit(1), F.col("h")), F.array().cast("array<int>"))
    own_ids = F.substring(F.col("ids"), F.col("h") * ID + 1, F.octet_length("ids"))
    return rows.select("conv_id", F.concat(head_ids, own_ids).alias("ids"),
                       F.concat(head_sizes, F.slice("sizes", F.col("h") + 1, F.size("sizes"))).alias("sizes"))


# ---- one block of sorted rows -------------------------------------------------------------------

def prefix_digests(ids: bytes) -> list[bytes]:
    """A digest of each prefix of whole turns, the empty one first."""
    h, out = hashlib.blake2b(digest_size=16), []
    out.append(h.digest())
    for at in range(0, len(ids), ID):
        h.update(ids[at : at + ID])
        out.append(h.copy().digest())
    return out


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two runs of ids share."""
    n = min(len(a), len(b))
    same = np.frombuffer(a[:n], f"V{ID}") == np.frombuffer(b[:n], f"V{ID}")
    return n // ID if same.all() else int(np.argmin(same))


def block_nodes(convs: np.ndarray, ids: list[bytes], sizes: list[np.ndarray], before: bytes | None, after: bytes | None):
    """Record batches of the nodes of a block of rows, sorted by (ids, conv_id), between the rows ``before`` and ``after``
    it (None at the ends of a shard)."""
    n = len(convs)
    around = ([before] if before is not None else []) + ids + ([after] if after is not None else [])
    lengths = np.array([len(x) // ID for x in around])
    depth = int(lengths.max())
    inside = np.arange(depth) < lengths[:, None]
    turns = np.full((len(around), depth), -1, np.int32)
    turns[inside] = np.unique(np.frombuffer(b"".join(around), f"V{ID}"), return_inverse=True)[1].ravel()
    at = 0 if before is None else 1
    ranks = np.zeros(len(around), np.int64)
    ranks[at : at + n] = convs
    ranks[:at], ranks[at + n :] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    order = np.lexsort((ranks, *turns.T[::-1]))
    turns, lengths = turns[order], lengths[order]
    changed = np.logical_or.accumulate(turns[1:] != turns[:-1], axis=1)
    shared = np.minimum((~changed).sum(axis=1), np.minimum(lengths[1:], lengths[:-1]))  # row k+1 with row k
    common = np.zeros(n, np.int64)  # row with the row before; of a shard's first row, corrected later
    common[1 - at :] = shared[: n - 1 + at]
    follows = np.append(shared, -1)[at : at + n]  # -1: nothing known after the last row
    order, length = order[at : at + n] - at, lengths[at : at + n]
    convs, leaf = convs[order], follows < length
    points = np.zeros((n, depth + 1), np.int64)
    points[:, 1:][inside[at : at + n][order]] = np.concatenate([sizes[i] for i in order] or [np.zeros(0, np.int64)])
    points = points.cumsum(axis=1)

    def path(row: int) -> list[bytes]:
        return prefix_digests(ids[order[row]])

    first_path, last_path = path(0), path(n - 1)
    rows, segment, parents = np.arange(n), np.zeros(n, np.int64), None
    for d in range(int(length.max()) + 1):
        rows = rows[length[rows] >= d]
        starts = np.flatnonzero((common[rows] < d) | (rows == 0))
        stops = np.append(starts[1:], len(rows))
        top, bottom = rows[starts], rows[stops - 1]
        own, least = common[rows], np.minimum.reduceat(convs[rows], starts)
        ends = np.add.reduceat((length[rows] == d).astype(np.int64), starts)
        saved = points[rows, own] - (points[rows, d - 1] if d else 0)
        figures = {
            "n_convs": stops - starts,
            "n_children": np.add.reduceat(((own <= d) & (length[rows] > d)).astype(np.int64), starts),
            "n_leaves": np.add.reduceat(leaf[rows].astype(np.int64), starts),
            "saved_tokens": np.add.reduceat(np.where(own >= d, saved, 0), starts),
        }
        left = (top == 0) & ((common[0] >= d) if before is not None else True)
        right = (bottom == n - 1) & ((follows[-1] >= d) if after is not None else True)
        part = left | right
        lists = [",".join(map(str, convs[i : i + e].tolist())) if e else "" for i, e in zip(top.tolist(), ends.tolist())]
        if parents is None:
            parent_key, parent_conv = [None] * len(top), [None] * len(top)
        else:
            up = segment[top]
            parent_key = [parents[1][i] for i in up.tolist()]
            parent_conv = [None if k is not None else c for k, c in zip(parent_key, parents[0][up].tolist())]
        keys = [(first_path if le else last_path)[d] if pa_ else None for le, pa_ in zip(left.tolist(), part.tolist())]
        for kind, chosen in (("part", part), ("node", ~part)):
            which = np.flatnonzero(chosen)
            if not len(which):
                continue
            columns = {f: v[which] for f, v in figures.items()} | {
                "conv_id": least[which], "depth": np.full(len(which), d), "key": [keys[i] for i in which],
                "parent_key": [parent_key[i] for i in which]}
            if kind == "node":
                columns |= {"parent_conv_id": [parent_conv[i] for i in which],
                            "ends_sha256": [hashlib.sha256(lists[i].encode()).hexdigest() if lists[i] else NOTHING for i in which]}
            yield _rows(kind, len(which), **columns)
        pieces = [i for i in np.flatnonzero(part).tolist() if lists[i]]
        if pieces:
            yield _rows("ends", len(pieces), key=[keys[i] for i in pieces], conv_id=convs[top[pieces]], ends=[lists[i] for i in pieces])
        segment[rows] = np.repeat(np.arange(len(starts)), stops - starts)
        parents = (least, keys)


def _shard_nodes(block_cells: int):
    """Nodes, parts of nodes and the edges of a shard."""
    def run(batches):
        shard = TaskContext.get().partitionId()
        convs, ids, sizes, longest = [], [], [], 0
        before = first = first_sizes = None
        for batch in batches:
            for conv, of, size in zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("sizes")):
                size = size.values.to_numpy(zero_copy_only=False)
                if first is None:
                    first, first_sizes = of, size
                if convs and (len(convs) + 3) * max(longest, len(size), 1) > block_cells:
                    yield from block_nodes(np.array(convs, np.int64), ids, sizes, before, of)
                    before, convs, ids, sizes, longest = ids[-1], [], [], [], 0
                convs.append(conv)
                ids.append(of)
                sizes.append(size)
                longest = max(longest, len(size))
        if convs:
            yield from block_nodes(np.array(convs, np.int64), ids, sizes, before, None)
            yield _rows("edge", 1, shard=[shard], first=[first], last=[ids[-1]], sizes=[first_sizes])

    return run


def _corrections(batches):
    """What the nodes on the path of a shard's first row miss for not knowing the row before it."""
    for batch in batches:
        for last, first, sizes in zip(*(batch.column(c).to_pylist() for c in ("last", "first", "sizes"))):
            d = common_turns(last, first)
            points = np.concatenate([[0, 0], np.cumsum(np.array(sizes[:d], np.int64))])  # before depth -1, 0, 1, ...
            yield _rows("part", d + 1, key=prefix_digests(first[: d * ID]), depth=np.arange(d + 1),
                        n_convs=np.zeros(d + 1, np.int64), n_children=-(np.arange(d + 1) < d).astype(np.int64),
                        n_leaves=np.full(d + 1, -int(d * ID == len(last))), saved_tokens=points[-1] - points[: d + 1])


def _hashed_lists(batches):
    """The SHA-256 of each key's lists, joined; rows come sorted by key and first id."""
    key, h, out = None, None, []
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends")):
            if k != key:
                if h:
                    out.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(piece.as_buffer())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["key", "ends_sha256"])
            out = []
    if h:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])


# ---- plan ----------------------------------------------------------------------------------------

def trie(convs: DataFrame, shards: int | None = None, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Per node of (conv_id, ids, sizes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. ``shards``: by the number of turns, unless given."""
    spark = convs.sparkSession
    convs = stored(convs, "rebuilt")
    turns = convs.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions")) if turns > block_cells else 1
    dealt = convs.repartitionByRange(shards or max(fewest, -(-turns // SHARD_TURNS)), "ids", "conv_id")
    found = stored(dealt.sortWithinPartitions("ids", "conv_id").mapInArrow(_shard_nodes(block_cells), _TYPES), "nodes")

    edges = found.where("kind = 'edge'").select("shard", "first", "last", "sizes")
    numbers = sorted(r.shard for r in edges.select("shard").collect())
    pairs = spark.createDataFrame(list(zip(numbers, numbers[1:])), "a long, b long")
    neighbours = edges.select(F.col("shard").alias("a"), "last").join(F.broadcast(pairs), "a").join(
        edges.select(F.col("shard").alias("b"), "first", "sizes"), "b")
    corrections = neighbours.select("last", "first", "sizes").mapInArrow(_corrections, _TYPES)

    columns = ["key", "parent_key", "conv_id", "depth", *FIGURES]
    parts = found.where("kind = 'part'").select(columns).unionByName(corrections.select(columns))
    merged = stored(parts.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *(F.sum(f).alias(f) for f in FIGURES)), "cut-nodes")
    lists = found.where("kind = 'ends'").select("key", "conv_id", "ends").repartition("key").sortWithinPartitions(
        "key", "conv_id").select("key", "ends").mapInArrow(_hashed_lists, "key binary, ends_sha256 string")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    cut = merged.join(lists, "key", "left").join(above, "parent_key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    whole = found.where("kind = 'node'")
    below_cut = whole.where("parent_key is not null").drop("parent_conv_id").join(bounded(above), "parent_key")
    out = ["conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256"]
    return whole.where("parent_key is null").select(out).unionByName(below_cut.select(out)).unionByName(cut.select(out))


def prefix_trie(turns: DataFrame, shards: int | None = None, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    return trie(rebuilt(turns.select("conv_id", "turn", "role", "text")), shards, block_cells)
