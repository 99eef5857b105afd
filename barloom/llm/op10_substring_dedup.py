"""Removal of repeated substrings of ``LENGTH`` bytes.

Every window of ``LENGTH`` bytes has an anchor, the place of its smallest hashed ``GRAM``-gram; equal windows have equal
anchors at the same distance. Consecutive windows with one anchor are a run. Runs of equal bytes around equal anchors
repeat as a whole and meet as hashes only. Where the runs of an anchor differ, one of each kind is read again and its
windows are compared, anchors with very many kinds window by window across the cluster. The bytes covered by repeated
windows are removed. A document is ``shared`` if one of its windows also starts in another document, a row of another
id or text, and not only elsewhere in itself.

Merging shard Burrows-Wheeler transforms was given up for this: README.md has the figures. All comparisons are of 64-bit
hashes of whole windows.

Defined cases: null text is empty; texts under ``LENGTH`` bytes lose nothing; windows may overlap their own repeats;
equal rows repeat each other and lose everything from ``LENGTH`` bytes on; the order of rows does not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import common
from barloom.llm.common import bounded, mix, signed, stored, texts

LENGTH, GRAM = 400, 64
#: Kinds of runs around one anchor that one task compares; beyond, windows are counted across the cluster.
KINDS = 20_000
#: Bytes of runs that a task compares at once, whole anchors at a time.
CHUNK = 1_500_000
_PLACE = np.uint64((1 << 20) - 1)
#: Texts are cut into slices that a place's bits can number.
SLICE = 1 << 19


def span_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all spans of ``length`` bytes."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(common._BYTE[codes] * common._powers(common._BASE, n), out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * common._powers(common._BASE_INVERSE, n)[: n - length + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values: of each block's suffix and the next one's prefix."""
    blocks = np.append(values, np.full(-len(values) % width, ~np.uint64(0))).reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(suffix[:count], prefix[width - 1 : width - 1 + count])


def runs(raw: bytes) -> list[tuple[np.ndarray, ...]]:
    """Per slice of a text: anchor hash, hash of the run's bytes, first window, last window of every run."""
    out = []
    for at in range(0, len(raw) - LENGTH + 1, SLICE):
        codes = np.frombuffer(raw[at : at + SLICE + LENGTH - 1], np.uint8)
        grams = span_hashes(codes, GRAM)
        place = (sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
                 & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        anchor = place[first]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(common._BYTE[codes] * common._powers(common._BASE, len(codes)), out=sums[1:])
        kind = (sums[last + LENGTH] - sums[first]) * common._powers(common._BASE_INVERSE, len(codes))[first]
        shape = ((anchor - first) * LENGTH + last - first).astype(np.uint64)
        out.append((signed(grams[anchor]), signed(mix(kind ^ mix(shape))), first + at, last + at))
    return out


def _runs(batches):
    for batch in batches:
        rows, index = [], []
        for i, raw in enumerate(texts(batch)):
            for part in runs(raw):
                rows.append(part)
                index.append(np.full(len(part[0]), i))
        if rows:
            anchor, kind, first, last = map(np.concatenate, zip(*rows))
            take = pa.array(np.concatenate(index))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("same").take(take), pa.array(anchor), pa.array(kind),
                 pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64))],
                ["doc_id", "same", "anchor", "kind", "first", "last"])


def _bytes(batches):
    """The bytes of the listed runs of each document."""
    for batch in batches:
        rows, index = [], []
        for i, (raw, listed) in enumerate(zip(texts(batch), batch.column("listed").to_pylist())):
            for r in listed:
                rows.append((r["anchor"], r["first"], r["alone"], r["local"], raw[r["first"] : r["last"] + LENGTH]))
                index.append(i)
        if rows:
            anchor, first, alone, local, data = zip(*rows)
            take = pa.array(index)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("same").take(take), pa.array(anchor, pa.int64()),
                 pa.array(first, pa.int64()), pa.array(alone, pa.bool_()), pa.array(local, pa.bool_()), pa.array(data, pa.binary())],
                ["doc_id", "same", "anchor", "first", "alone", "local", "data"])


def _compared(batches):
    """Rows ordered by anchor: the spans (doc_id, same, begin, end, shared) of windows that another run has too. Spans
    without bytes only say that their document shares a window with another one."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        data = [x.as_py() for x in table.column("data")]
        if not data:
            return
        sizes = np.array([len(x) for x in data])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        hashes = span_hashes(np.frombuffer(b"".join(data), np.uint8), LENGTH)
        # windows inside one run, and the run of each
        counts = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(data)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        value = hashes[starts[owner] + at]
        order = np.argsort(value, kind="stable")
        equal = value[order][1:] == value[order][:-1]
        twice = np.zeros(len(value), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        # groups of equal windows with more than one document among the holders of their runs
        ids: dict[tuple, int] = {}
        document = np.array([ids.setdefault(x, len(ids)) for x in zip(
            table.column("doc_id").to_pylist(), table.column("same").to_pylist())])[owner][order]
        spread = ~table.column("local").to_numpy(zero_copy_only=False)[owner][order]
        group = np.flatnonzero(np.append(True, ~equal))
        size = np.diff(np.append(group, len(order)))
        across = (np.minimum.reduceat(document, group) != np.maximum.reduceat(document, group)) | np.logical_or.reduceat(spread, group)
        mine = np.unique(owner[order][np.repeat(across & (size > 1), size)])
        if len(mine):
            take, none = pa.array(mine), pa.array(np.zeros(len(mine), np.int64))
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").take(take).combine_chunks(), table.column("same").take(take).combine_chunks(), none, none,
                 pa.array(np.ones(len(mine), bool))], ["doc_id", "same", "begin", "end", "shared"])
        twice &= table.column("alone").to_numpy(zero_copy_only=False)[owner]
        # maximal rows of repeated windows within a run
        edge = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
        begin, end = edge[::2], edge[1::2] - 1
        split = np.flatnonzero(owner[begin] != owner[end]) if len(begin) else []
        if len(split):  # rows that go over the border of two runs
            cuts = np.flatnonzero((owner[1:] != owner[:-1]) & twice[1:] & twice[:-1])
            begin, end = np.sort(np.append(begin, cuts + 1)), np.sort(np.append(end, cuts))
        if len(begin):
            take = pa.array(owner[begin])
            first = table.column("first").to_numpy()[owner[begin]]
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").take(take).combine_chunks(), table.column("same").take(take).combine_chunks(),
                 pa.array(first + at[begin]), pa.array(first + at[end] + LENGTH), pa.array(np.zeros(len(begin), bool))],
                ["doc_id", "same", "begin", "end", "shared"])

    for batch in batches:
        held.append(batch)
        if sum(b.column("data").nbytes for b in held) > CHUNK:
            table = pa.Table.from_batches(held)
            anchors = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
            yield from work(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def _windows(batches):
    for batch in batches:
        for doc_id, same, first, alone, local, data in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "same", "first", "alone", "local", "data"))):
            values = signed(span_hashes(np.frombuffer(data, np.uint8), LENGTH))
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id] * n, batch.schema.field("doc_id").type), pa.array([same] * n, pa.int64()),
                 pa.array(values), pa.array(first + np.arange(n)), pa.array([alone] * n), pa.array([local] * n)],
                ["doc_id", "same", "value", "begin", "alone", "local"])


def _merged(batches):
    """Lists of spans as lists of disjoint, maximal ones."""
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            if not spans:
                out.append([])
                continue
            ends = np.array([(s["begin"], s["end"]) for s in spans], np.int64)
            ends = ends[np.argsort(ends[:, 0], kind="stable")]
            reach = np.maximum.accumulate(ends[:, 1])
            new = np.append(True, ends[1:, 0] > reach[:-1])
            at = np.flatnonzero(new)
            out.append([{"begin": int(b), "end": int(e)}
                        for b, e in zip(ends[at, 0], reach[np.append(at[1:], len(ends)) - 1])])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("same"), pa.array(out, batch.schema.field("spans").type), batch.column("shared")],
            ["doc_id", "same", "spans", "shared"])


def _kept(batches):
    for batch in batches:
        out = []
        for raw, spans in zip(texts(batch), batch.column("spans").to_pylist()):
            digest, at = hashlib.sha256(), 0
            for s in spans or []:
                digest.update(raw[at : s["begin"]])
                at = s["end"]
            digest.update(raw[at:])
            removed = sum(s["end"] - s["begin"] for s in spans or [])
            out.append((len(raw), removed, len(spans or []), digest.hexdigest()))
        n, removed, count, digests = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
             pa.array(digests, pa.string()), batch.column("shared")],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shared"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, same, spans, shared): the maximal spans of bytes of ``docs`` (doc_id, same, text) covered by repeated windows,
    and whether one of the windows starts in another document too."""
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    found = stored(docs.mapInArrow(
        _runs, f"doc_id {kind_of_id}, same long, anchor long, kind long, first long, last long"), "runs")
    kinds = found.groupBy("anchor", "kind").agg(
        F.count("*").alias("held"), F.min(F.struct("doc_id", "same", "first", "last")).alias("one"),
        F.max(F.struct("doc_id", "same")).alias("high"))
    local = F.struct("one.doc_id", "one.same").eqNullSafe(F.col("high"))
    kinds = stored(kinds.select("anchor", "kind", "held", "one", local.alias("local")), "kinds")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("held").alias("all")).where("all > 1")
    whole = (found.join(kinds.where("held > 1").select("anchor", "kind", "local"), ["anchor", "kind"])
             .select("doc_id", "same", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end"), (~F.col("local")).alias("shared")))

    open_ = kinds.join(anchors.where("kinds > 1").select("anchor", "kinds"), "anchor").select(
        "one.*", "anchor", (F.col("held") == 1).alias("alone"), "local", "kinds")

    def data(listed: DataFrame) -> DataFrame:
        listed = listed.groupBy("doc_id", "same").agg(
            F.collect_list(F.struct("anchor", "first", "last", "alone", "local")).alias("listed"))
        listed = bounded(stored(listed, "listed"), 500_000).select(
            F.col("doc_id").alias("id"), F.col("same").alias("text_hash"), "listed")
        rows = docs.join(listed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("text_hash")))
        return rows.select("doc_id", "same", "text", "listed").mapInArrow(
            _bytes, f"doc_id {kind_of_id}, same long, anchor long, first long, alone boolean, local boolean, data binary")

    compared = (data(open_.where(F.col("kinds") <= KINDS)).repartition(F.col("anchor")).sortWithinPartitions("anchor")
                .mapInArrow(_compared, f"doc_id {kind_of_id}, same long, begin long, end long, shared boolean"))
    spans = whole.unionByName(compared)
    crowded = stored(open_.where(F.col("kinds") > KINDS), "crowded")
    if not crowded.isEmpty():
        windows = data(crowded).mapInArrow(
            _windows, f"doc_id {kind_of_id}, same long, value long, begin long, alone boolean, local boolean")
        owner = F.struct("doc_id", "same")
        twice = windows.groupBy("value").agg(
            F.count("*").alias("n"), (~F.min(owner).eqNullSafe(F.max(owner)) | F.max(~F.col("local"))).alias("shared")).where("n > 1")
        spans = spans.unionByName(windows.join(twice.select("value", "shared"), "value").where("alone OR shared").select(
            "doc_id", "same", "begin", (F.col("begin") + F.when(F.col("alone"), LENGTH).otherwise(0)).alias("end"), "shared"))
    span = F.when(F.col("end") > F.col("begin"), F.struct("begin", "end"))
    listed = spans.groupBy("doc_id", "same").agg(F.collect_list(span).alias("spans"), F.max("shared").alias("shared"))
    return listed.mapInArrow(
        _merged, f"doc_id {kind_of_id}, same long, spans array<struct<begin:bigint,end:bigint>>, shared boolean")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed spans), kept_sha256 (of what remains), shared
    (a removed window also starts in another document)."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("same"), "text")
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    spans = bounded(stored(repeated_spans(docs), "spans"), 500_000).select(
        F.col("doc_id").alias("id"), F.col("same").alias("text_hash"), "spans", "shared")
    rows = docs.join(
        spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("text_hash")), "left")
    return rows.select("doc_id", "text", "spans", F.coalesce("shared", F.lit(False)).alias("shared")).mapInArrow(
        _kept, f"doc_id {kind_of_id}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shared boolean")
