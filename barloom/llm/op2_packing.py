"""Packing of token sequences by non-negative least squares.

Documents become token ids, each followed by id 0. Full windows of ``WINDOW`` ids stay as they are; what remains of each
document, shorter than a window, goes into a histogram of lengths. All combinations of two or three lengths that fill a
window are enumerated, their repeat counts solved as non-negative least squares against the histogram and rounded. What
the counts leave over is packed greedily, longest first, and cut where a window is full, so that one window at most is
padded.

Texts are encoded once and the ids stored. The driver sees the histogram only: ``WINDOW`` numbers, whatever the input.
A remainder's rank among those of its length is its rank in its task plus what the tasks before it hold, so that no
length, however common, is gathered in one task.

Defined cases: null and empty texts are the single id 0; repeated rows are packed once each; an empty table gives no
pieces; special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import bounded, stored

WINDOW = 1024
TOKENIZER = "byte_bpe_50k.json"
#: Encoded words that a worker remembers.
CACHE = 300_000
#: Characters of text that are encoded together.
TOGETHER = 1_000_000
DESCENTS = 400

#: Before a single space between other characters the tokenizer's pattern always begins a new piece.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Letters and what punctuation follows them are two pieces of the pattern; an apostrophe may begin a contraction.
_PLAIN = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
#: The splitting for which that holds.
_SPLITTING = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: The characters that stand for bytes in the model's vocabulary.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}
_TOKENIZERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts as little-endian numbers.

    The tokenizer's pattern never joins characters over a line break or before a space that stand between other
    characters, so that words are encoded once and remembered; the ``CACHE`` last ones are looked up as well. A word of
    letters, with or without punctuation behind them, is one or two pieces, which go to the tokenizer's model directly;
    other words are encoded by many. Texts with other white space go piece by piece.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.line = self._ids(["\n"])[0]
        form = json.loads(self.tokenizer.to_str())
        self.direct = form["normalizer"] is None and (form["pre_tokenizer"] or {}).items() >= _SPLITTING.items()
        self.model, numbers = self.tokenizer.model, np.arange(self.tokenizer.get_vocab_size()).astype(self.type)
        self.number = [x.tobytes() for x in numbers]
        self.endings: dict[str, bytes] = {}
        #: words at the start of a line, words after a space; before them those that were remembered earlier
        self.words: tuple[dict[str, bytes], ...] = ({}, {})
        self.older: tuple[dict[str, bytes], ...] = ({}, {})

    def forget(self) -> None:
        self.words, self.older = ({}, {}), ({}, {})

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type).tobytes() for x in found]

    def _piece(self, text: str) -> bytes:
        """Ids of what the pattern leaves in one piece."""
        found = self.model.tokenize(text.encode().decode("latin-1").translate(_BYTES))
        return b"".join([self.number[x.id] for x in found])

    def _ending(self, text: str) -> bytes:
        ids = self.endings.get(text)
        if ids is None:
            ids = self._piece(text)
            if len(self.endings) < 10_000:
                self.endings[text] = ids
        return ids

    def _learn(self, known: dict[str, bytes], older: dict[str, bytes], words: set[str], front: str) -> None:
        new = words - known.keys()
        again = new & older.keys()
        known.update({w: older[w] for w in again})
        other = []
        for w in new - again:
            plain = _PLAIN.fullmatch(w) if self.direct else None
            if plain:
                stem, ending = plain.groups()
                ids = known.get(stem) or older.get(stem) or self._piece(front + stem)
                known[stem] = ids
                if ending:
                    known[w] = ids + self._ending(ending)
            elif w and w == w.strip():  # what has white space at its ends is not remembered
                other.append(w)
        size = self.type.itemsize
        for at in range(0, len(other), 5000):
            part = other[at : at + 5000]
            raw = self._ids(["".join([f"{front}{w}\n" for w in part])])[0]
            ends = (np.flatnonzero(np.frombuffer(raw, self.type) == np.frombuffer(self.line, self.type)[0]) * size)
            begins = [0, *(ends + size).tolist()]
            known.update(zip(part, [raw[b:e] for b, e in zip(begins, ends.tolist())], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [[line.split(" ") for line in text.split("\n")] for text in texts]
        if sum(map(len, self.words)) > CACHE:
            self.older, self.words = self.words, ({}, {})
        self._learn(self.words[0], self.older[0], {line[0] for lines in split for line in lines}, "")
        self._learn(self.words[1], self.older[1], set().union(*[line[1:] for lines in split for line in lines]), " ")
        first, after = self.words[0].__getitem__, self.words[1].__getitem__
        out = []
        for text, lines in zip(texts, split):
            try:
                out.append(self.line.join([first(line[0]) + b"".join(map(after, line[1:])) for line in lines]))
            except KeyError:
                out.append(b"".join(self._ids(_CUT.split(text))))
        return out


def encoder(name: str) -> Encoder:
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = Encoder(name)
    return _TOKENIZERS[name]


def _encoded(name: str, window: int, remember: bool):
    """Rows (doc_id, n, ids, task, rest, rank, full): ``rank`` of the remainder among the task's of that length,
    ``full`` windows that the task had before. Words may be remembered for the worker's next task."""
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        made, task = encoder(name), TaskContext.get().partitionId()
        ranks, full = np.zeros(window, np.int64), 0
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < batch.num_rows:
                part, size, begin = [], 0, at
                while at < batch.num_rows and size < TOGETHER:
                    part.append(texts[at].as_py() or "")
                    size, at = size + len(part[-1]), at + 1
                end = np.zeros(1, made.type).tobytes()
                ids = [x + end for x in made.encode(part)]
                rows = []
                for x in ids:
                    n = len(x) // made.type.itemsize
                    rest = n % window
                    rows.append((n, rest, ranks[rest], full))
                    ranks[rest] += 1
                    full += n // window
                n, rest, rank, before = (pa.array(c, pa.int64()) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, at - begin), n, pa.array(ids, pa.binary()),
                     pa.array([task] * len(ids), pa.int64()), rest, rank, before],
                    ["doc_id", "n", "ids", "task", "rest", "rank", "full"])
        if not remember:
            made.forget()
    return run


def combinations(window: int) -> np.ndarray:
    """All sets of two or three lengths that fill the window; 0 stands for no third."""
    a = np.arange(1, window // 2 + 1)
    two = np.stack([np.zeros_like(a), a, window - a], axis=1)
    x, y = np.meshgrid(np.arange(1, window // 3 + 1), np.arange(1, window), indexing="ij")
    z = window - x - y
    keep = (x <= y) & (y <= z)
    return np.concatenate([two, np.stack([x[keep], y[keep], z[keep]], axis=1)])


def repeats(histogram: np.ndarray, combos: np.ndarray, descents: int = DESCENTS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients: how often each combination is to be used."""
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0

    def used(x):
        out = np.bincount(combos.ravel(), np.repeat(x, 3), size)
        out[0] = 0
        return out

    def back(y):
        return y[combos].sum(axis=1)

    probe = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue bounds the step
        probe = back(used(probe))
        scale = np.linalg.norm(probe)
        probe /= scale
    x = step = np.zeros(len(combos))
    for k in range(descents):
        new = np.maximum(0, step - back(used(step) - target) / scale)
        step = new + k / (k + 3) * (new - x)
        x = new
    return x


class Plan:
    """Where the remainder of a length and rank goes: sequence and offset."""

    def __init__(self, histogram: np.ndarray, window: int, first: int):
        left = histogram.astype(np.int64).copy()
        combos = combinations(window)
        counts = np.rint(repeats(histogram, combos)).astype(np.int64) if left[1:].any() else np.zeros(len(combos), int)
        slots: list[list[tuple[int, int, int]]] = [[] for _ in range(window)]  # (repeats, sequence, offset)
        sequence = first
        for c in np.argsort(-counts, kind="stable"):
            lengths = [int(x) for x in combos[c] if x]
            times = min([counts[c], *(left[x] // lengths.count(x) for x in lengths)])
            if counts[c] <= 0:
                break
            if times <= 0:
                continue
            for x, offset in zip(lengths, itertools.accumulate([0, *lengths])):
                slots[x].append((int(times), sequence, offset))
                left[x] -= times
            sequence += int(times)
        self.window, self.tail = window, sequence
        self.ends = [np.cumsum([s[0] for s in x], dtype=np.int64) for x in slots]
        self.slots = slots
        # what is left over: one stream, longest first, cut at full windows
        sizes = left * np.arange(window)
        self.stream = sizes[::-1].cumsum()[::-1] - sizes
        self.left = left

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, ids) of each piece of a remainder."""
        ends = self.ends[length]
        k = int(np.searchsorted(ends, rank, side="right"))
        if k < len(ends):
            times, sequence, offset = self.slots[length][k]
            return [(sequence + rank - int(ends[k]) + times, offset, length)]
        at = int(self.stream[length]) + (rank - (int(ends[-1]) if len(ends) else 0)) * length
        sequence, offset = self.tail + at // self.window, at % self.window
        room = self.window - offset
        return [(sequence, offset, length)] if length <= room else [
            (sequence, offset, room), (sequence + 1, 0, length - room)]


def _placed(plan: Plan, width: str):
    def run(batches):
        for batch in batches:
            rows, index = [], []
            for i, row in enumerate(batch.select(["n", "ids", "rest", "at", "full"]).to_pylist()):
                ids, start = np.frombuffer(row["ids"], width), 0
                pieces = [(row["full"] + k, 0, plan.window) for k in range(row["n"] // plan.window)]
                for sequence, offset, length in pieces + (plan.place(row["rest"], row["at"]) if row["rest"] else []):
                    crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                    rows.append((start, length, crc, row["n"], sequence, offset))
                    index.append(i)
                    start += length
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(index)), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, remember: bool = True) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``remember``: a worker keeps encoded words, some 100 MB, from task to task, which saves time, and until it ends,
    which other jobs of the session pay for.
    """
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tokens = stored(docs.mapInArrow(
        _encoded(tokenizer, window, remember),
        f"doc_id {id_type}, n long, ids binary, task long, rest long, rank long, full long"), "tokens")

    counts = stored(tokens.groupBy("task", "rest").agg(
        F.count("*").alias("held"), F.sum(F.floor(F.col("n") / window)).alias("windows")), "lengths")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("held").alias("held")).collect():  # one row per length
        histogram[r.rest] = r.held
    total = counts.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    plan = Plan(histogram, window, int(total))

    # per length (the full window is one) what the tasks before hold: windows of one row per task
    held = counts.select("task", "rest", "held").unionByName(
        counts.groupBy("task").agg(F.lit(window).cast("long").alias("rest"), F.sum("windows").alias("held")))
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(held.select("task", "rest", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before")),
                    "starts")
    ranks = before.where(F.col("rest") < window).withColumnRenamed("before", "ranks")
    windows = before.where(F.col("rest") == window).select("task", F.col("before").alias("windows"))
    start = bounded(stored(ranks.join(windows, "task"), "starts"))
    rows = tokens.join(start, ["task", "rest"]).select(
        "doc_id", "n", "ids", "rest", (F.col("rank") + F.col("ranks")).alias("at"),
        (F.col("full") + F.col("windows")).alias("full"))
    width = encoder(tokenizer).type.str
    return rows.mapInArrow(
        _placed(plan, width), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long")
