"""Near-duplicate passages by compact windows.

A document is its sequence of 5-word shingles. For each of ``HASHES`` hash functions a Cartesian tree over the hashed
sequence groups all subsequences of at least ``LEAST`` shingles by their smallest hash: those that begin in [left, centre]
and end in [centre, right] share the centre's. A signature is that hash refined by a second smallest hash, of the ``HALF``
shingles that end or that begin at the centre; of a passage around the centre, one of the halves lies inside. Equal
signatures of two documents are joined; places where windows of at least ``ENOUGH`` functions meet along one diagonal are
candidates. Both sides of a candidate are then read and aligned:
the longest stretch in which eight of nine shingles are shared is a passage if the similarity of the two sides' shingle
sets is at least 0.8.

Equal sequences collapse to one node first. Signatures of up to ``LAGS`` + 1 windows are joined all with all. In a larger
one, a crowd, rows are ordered by the smallest hash of the other half, and each is joined with the ``LAGS`` before it and
the first. A crowd's window whose centre lies in no passage after that is open, and meets all others of its crowd by the
rarest shingles: of a stretch in which one in nine at most is not shared, the rarest shared one is among the first so many
and one more, and of its counterpart, in which it is one in five at most, too.

Equal passages do not depend on those partners. Every run of ``LEAST`` shingles has its centre in a window of the first
function, and the half on one side of the centre inside. Where the hash of such a half occurs in two nodes, all runs
around it are hashed, and those that occur in two nodes are passages, however many nodes share the half. Passages that are
only similar can be missed near the threshold, as by every min-hash method.

Defined cases: null and empty texts and texts under 50 words have no passages; repeats inside one document do not count;
equal rows are passages of each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import common
from barloom.llm.common import bounded, grams, mix, signed, texts, words_of

WORDS, PERCENT = 5, 80
#: Shortest passage, in words and in shingles.
LEAST_WORDS = 50
LEAST = LEAST_WORDS - WORDS + 1
HASHES, ENOUGH = 4, 2
#: Shingles of a half, the centre included: a run of ``LEAST`` has so many on one side.
HALF = LEAST // 2
#: Preceding windows of a signature that a window is joined with at first.
LAGS = 4
#: Bytes of texts that are hashed together, and shingles of documents whose windows are made together.
HASHED, TOGETHER = 1 << 18, 50_000
#: Windows that are ordered together; of one signature, so many, which are ordered in parts beyond.
TAKEN, HELD = 30_000, 1_000_000
#: Ranges of shingles are read with bounds at multiples of this.
GRID = 256
#: Distinct sequences of which a task remembers that their windows are out.
SEEN = 200_000
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
#: A packed place without its order, which has done its work when windows have met.
_PLACE = (1 << 48) - 1
_SIDES = mix(np.arange(1, 3, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table, without the files of its shuffles, which nothing reads again."""
    conf, cleanup = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(cleanup)
    conf.set(cleanup, "true")
    try:
        return common.stored(df, name)
    finally:
        conf.set(cleanup, before)


def sequences(raws: Iterable[bytes]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Number of words, and the shingles in order, of each text; some at a time."""
    held, size = [], 0
    for raw in raws:
        if held and size + len(raw) > HASHED:
            yield _sequences(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield _sequences(held)


def _sequences(raws: list[bytes]) -> list[tuple[int, np.ndarray]]:
    words, counts = words_of(raws, lower=True)
    together = grams(words, WORDS)
    return [(n, together[end - n : end - WORDS + 1] if n >= WORDS else grams(words[end - n : end], WORDS))
            for n, end in zip(counts.tolist(), np.cumsum(counts).tolist())]


def each(raws: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The shingles of each text."""
    for some in sequences(raws):
        for _, shingles in some:
            yield shingles


def nodes_of(parts: list[np.ndarray]) -> list[int]:
    """A hash of each sequence."""
    sizes = np.array([len(x) for x in parts], np.int64)
    ends = np.cumsum(sizes)
    places = np.arange(1, ends[-1] + 1, dtype=np.uint64) - np.repeat(ends - sizes, sizes).astype(np.uint64)
    sums = np.zeros(ends[-1] + 1, np.uint64)
    np.cumsum(mix(np.concatenate(parts) ^ mix(places)), out=sums[1:])
    return signed(sums[ends] - sums[ends - sizes]).tolist()


def compact_windows(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(left, centre, right) of the nodes of the Cartesian tree that span at least ``LEAST`` values."""
    out, stack = [], [(0, len(values))] if len(values) >= LEAST else []
    while stack:
        left, end = stack.pop()
        centre = left + int(values[left:end].argmin())
        out.append((left, centre, end - 1))
        if centre - left >= LEAST:
            stack.append((left, centre))
        if end - centre - 1 >= LEAST:
            stack.append((centre + 1, end))
    return out


def _runwise(least: np.ufunc, values: np.ndarray) -> np.ndarray:
    """Minima (or maxima) of all runs of ``LEAST`` values."""
    out, width = values, 1
    while 2 * width <= LEAST:
        out, width = least(out[:-width], out[width:]), 2 * width
    return least(out[: len(values) - LEAST + 1], out[LEAST - width :])


def forest(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The compact windows of several sequences, each a part [begin, end) of ``values``, in order of their centres.

    A centre is the smallest value of a run of ``LEAST``. What bounds its window, the smaller values next to it, are
    centres of larger windows."""
    keep = ends - begins >= LEAST
    begins, ends = begins[keep], ends[keep]
    if not len(begins):
        return np.zeros((0, 3), np.int64)
    least = _runwise(np.minimum, values)
    change = np.zeros(len(least) + 1, np.int8)
    change[begins] = 1
    change[ends - LEAST + 1] = -1
    padded = np.zeros(len(least) + 2 * (LEAST - 1), np.uint64)
    np.copyto(padded[LEAST - 1 : 1 - LEAST], least, where=np.cumsum(change[:-1], dtype=np.int8).view(bool))
    at = np.flatnonzero(_runwise(np.maximum, padded) == values)  # with all equal values, and some of 0
    owner = np.searchsorted(begins, at, side="right") - 1
    inside = (owner >= 0) & (at < ends[owner])
    at, owner = at[inside], owner[inside]
    value = values[at]
    first, last = np.searchsorted(owner, owner), np.searchsorted(owner, owner, side="right") - 1
    before, after = np.arange(len(at)) - 1, np.arange(len(at)) + 1
    here = np.arange(len(at))
    while len(here):  # from one larger value to the one before it that is smaller, or not known to be larger
        here = here[before[here] >= first[here]]
        here = here[value[before[here]] > value[here]]
        before[here] = before[before[here]]
    here = np.arange(len(at))
    while len(here):
        here = here[after[here] <= last[here]]
        here = here[value[after[here]] >= value[here]]
        after[here] = after[after[here]]
    left = np.where(before >= first, at[before] + 1, begins[owner])
    right = np.where(after <= last, at[np.minimum(after, len(at) - 1)], ends[owner]) - 1
    return np.stack([left, at, right], axis=1)[right - left + 1 >= LEAST]


def _nodes(batches):
    for batch in batches:
        n, node = [], []
        for some in sequences(texts(batch)):
            n += [count for count, _ in some]
            node += nodes_of([shingles for _, shingles in some])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("same"), pa.array(n, pa.int64()),
                                          pa.array(node, pa.int64())], ["doc_id", "same", "n_words", "node"])


def packed(fn: int, windows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Order in its signature (15 bits), function (4), shingles to the left and right, ``LEAST`` at most (6 each), and
    centre (32) as one number. Wider windows add nothing to a candidate."""
    left, centre, right = windows[:, 0], windows[:, 1], windows[:, 2]
    out = (order >> np.uint64(49)).astype(np.int64) << 48 | fn << 44
    return out | np.minimum(centre - left, LEAST) << 38 | np.minimum(right - centre, LEAST) << 32 | centre


def unpacked(places: np.ndarray) -> np.ndarray:
    """(function, left, centre, right) of packed places."""
    centre = places & 0xFFFFFFFF
    return np.stack([places >> 44 & 15, centre - (places >> 38 & 63), centre, centre + (places >> 32 & 63)], axis=1)


def halves(shingles: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the runs of ``HALF`` shingles that end, and that begin, at each centre, and whether they are in the window."""
    runs = grams(shingles, HALF)
    left, centre, right = windows[:, 0], windows[:, 1], windows[:, 2]
    a, b = np.maximum(centre - HALF + 1, 0), np.minimum(centre, len(runs) - 1)
    return (signed(mix(runs[a] ^ _SIDES[0])), signed(mix(runs[b] ^ _SIDES[1])),
            centre - HALF + 1 >= left, centre + HALF - 1 <= right)


def _smallest(hashed: np.ndarray, centres: np.ndarray) -> list[np.ndarray]:
    """Smallest of the ``HALF`` values that end, and that begin, at each centre, which has so many on either side."""
    views = np.lib.stride_tricks.sliding_window_view(hashed, HALF)
    return [views[centres - HALF + 1].min(axis=1), views[centres].min(axis=1)]


def apart(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Several sequences in one array with gaps of ``HALF`` zeros, where each begins, and their sizes."""
    sizes = np.array([len(x) for x in parts])
    gap = np.zeros(HALF, np.uint64)
    together = np.concatenate([gap] + [x for one in parts for x in (one, gap)])
    return together, HALF + np.cumsum(sizes + HALF) - sizes - HALF, sizes


def windows_of(nodes: list[int], parts: list[np.ndarray]) -> list[np.ndarray]:
    """(sig, node, place) of the windows and halves of several sequences."""
    shingles, begins, sizes = apart(parts)
    empty = np.ones(len(shingles), bool)
    empty[np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = False
    nodes, out = np.array(nodes, np.int64), []
    for fn, seed in enumerate(_SEEDS):
        hashed = mix(shingles ^ seed)
        at = forest(hashed, begins, begins + sizes)
        owner = np.searchsorted(begins, at[:, 1], side="right") - 1
        centre = mix(hashed[at[:, 1]] ^ seed)
        values = mix(hashed ^ _SIDES[0])
        values[empty] = 2**64 - 1
        ends = _smallest(values, at[:, 1])
        own = at - begins[owner][:, None]
        for k in (0, 1):
            out.append((signed(mix(centre ^ mix(ends[k] ^ _SIDES[k]))), nodes[owner], packed(fn, own, ends[1 - k])))
        if not fn:
            one, two, has_one, has_two = halves(shingles, at)
            out += [(key[has], nodes[owner[has]], packed(HASHES + k, own[has], np.zeros(int(has.sum()), np.uint64)))
                    for k, (key, has) in enumerate(((one, has_one), (two, has_two)))]
    return [np.concatenate(c) for c in zip(*out)]


def _windows(batches):
    seen: set[int] = set()
    names = ["sig", "node", "place"]
    held, size = {}, 0
    for batch in batches:
        for some in sequences(texts(batch)):
            some = [shingles for n, shingles in some if n >= LEAST_WORDS]
            for node, shingles in zip(nodes_of(some) if some else (), some):
                if node in seen or node in held:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                held[node], size = shingles, size + len(shingles)
                if size > TOGETHER:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in windows_of(list(held), list(held.values()))], names)
                    held, size = {}, 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in windows_of(list(held), list(held.values()))], names)


def _in_order(batches):
    """Rows that come by sig, by (sig, place, node): whole signatures of more than one row, the largest in parts."""
    held, size, parted = [], 0, None

    def work(whole: bool):
        nonlocal held, size, parted
        sig, node, place = (np.concatenate(x) for x in zip(*held))
        cut = len(sig) if whole else int(np.searchsorted(sig, sig[-1]))  # the last signature may go on
        part = not cut
        if part:
            cut = len(sig)
        size = len(sig) - cut
        held = [tuple(x[cut:] for x in (sig, node, place))] if size else []
        sig, node, place = (x[:cut] for x in (sig, node, place))
        edge = np.append(True, sig[1:] != sig[:-1])
        keep = ~(edge & np.append(edge[1:], True)) | part
        if parted is not None:
            keep |= sig == parted
        parted = sig[-1] if part else None
        sig, node, place = (x[keep] for x in (sig, node, place))
        order = np.lexsort((node, place, sig))
        return sig[order], node[order], place[order]

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(c).to_numpy() for c in ("sig", "node", "place")))
            size += batch.num_rows
            if size >= (HELD if held[0][0][0] == held[-1][0][-1] else TAKEN):
                yield work(False)
    if size:
        yield work(True)


def _met(batches):
    """Rows that come by sig: each window beside the preceding ones and the first of its signature, of other nodes
    (u, v and the packed places). As u = v come the halves that two nodes share, by their key and -1, and the windows of
    crowds, by their signature and place."""
    kept, count = None, 0  # the last rows and the first of the last row's signature, which had so many rows
    for sig, node, place in _in_order(batches):
        if not len(sig):
            continue
        old = 0
        if kept is not None:
            old = len(kept[0])
            sig, node, place = (np.append(a, b) for a, b in zip(kept, (sig, node, place)))
        new = np.append(True, sig[1:] != sig[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))
        first, first_place = node[start], place[start]
        if kept is not None:
            first[start == 0], first_place[start == 0] = kept[3]
        half = (place >> 44 & 15) >= HASHES
        pairs = []
        at = np.arange(old, len(sig))
        for lag in range(1, LAGS + 1):
            here = at[at >= lag]
            here = here[(sig[here] == sig[here - lag]) & ~half[here]]
            pairs.append((node[here], node[here - lag], place[here], place[here - lag]))
        here = at[~half[at] & ((at - start[at] > LAGS) | (start[at] == 0))]
        pairs.append((node[here], first[here], place[here], first_place[here]))
        u, v, up, vp = map(np.concatenate, zip(*pairs))
        up, vp = up & _PLACE, vp & _PLACE
        u, v, up, vp = (x[u != v] for x in (u, v, up, vp))
        swap = u > v
        rows = np.stack([np.where(swap, v, u), np.where(swap, u, v), np.where(swap, vp, up), np.where(swap, up, vp)], axis=1)
        here = at[half[at] & (node[at] != first[at])]
        once = here[np.unique(sig[here], return_index=True)[1]]
        shared = [np.stack([x, x, sig[h], np.full(len(h), -1)], axis=1) for h, x in ((here, node[here]), (once, first[once]))]
        here, count = _crowds(sig, node, half, old, count)
        rows = np.concatenate([rows, *shared, np.stack([node[here], node[here], sig[here], place[here] & _PLACE], axis=1)])
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        kept = (sig[-LAGS - 1 :], node[-LAGS - 1 :], place[-LAGS - 1 :], (first[-1], first_place[-1]))
        same = kept[0] == sig[-1]  # the first of the last row's signature is the first of no other
        kept = (*(x[same] for x in kept[:3]), kept[3])
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)],
                                             ["u", "v", "up", "vp"])


def _crowds(sig: np.ndarray, node: np.ndarray, half: np.ndarray, old: int, count: int) -> tuple[np.ndarray, int]:
    """Places of the rows of crowds, and how many rows the last signature had by now. The first ``old`` rows are the last
    ones of the ``count`` that the first signature had before; they are among the places if they were not before."""
    starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    sizes = np.diff(np.append(starts, len(sig)))
    total = sizes.copy()
    if old:
        total[0] += count - old
    crowd = (total > LAGS + 1) & ~half[starts]
    crowd[1:-1] &= (np.minimum.reduceat(node, starts) != np.maximum.reduceat(node, starts))[1:-1]  # whole ones, of one node
    here = np.repeat(crowd, sizes)
    if old and count > LAGS + 1:
        here[:old] = False
    return np.flatnonzero(here), int(total[-1])


def runs_of(nodes: list[int], parts: list[np.ndarray], wanted: list[np.ndarray]) -> list[np.ndarray]:
    """Hash, node and place of every run of ``LEAST`` shingles around a wanted half of several sequences."""
    shingles, begins, sizes = apart(parts)
    at = forest(mix(shingles ^ _SEEDS[0]), begins, begins + sizes)
    owner = np.searchsorted(begins, at[:, 1], side="right") - 1
    one, two, has_one, has_two = halves(shingles, at)
    salt = mix(np.arange(len(parts), dtype=np.uint64))  # a half is wanted of one sequence
    keys = np.concatenate(wanted).view(np.uint64) ^ np.repeat(salt, [len(x) for x in wanted])
    has_one, has_two = (has & np.isin(half.view(np.uint64) ^ salt[owner], keys) for half, has in ((one, has_one), (two, has_two)))
    change = np.zeros(len(shingles) + 1, np.int64)
    left, centre, right = at.T
    low, high = np.maximum(left, centre - LEAST + 1), np.minimum(centre, right - LEAST + 1)
    for first, last, has in ((low, np.minimum(high, centre - HALF + 1), has_one),
                             (np.maximum(low, centre + HALF - LEAST), high, has_two)):
        has = has & (first <= last)
        np.add.at(change, first[has], 1)
        np.add.at(change, last[has] + 1, -1)
    begin = np.flatnonzero(np.cumsum(change)[:-1] > 0)
    owner = np.searchsorted(begins, begin, side="right") - 1
    return [signed(grams(shingles, LEAST)[begin]), np.array(nodes, np.int64)[owner], (begin - begins[owner]).astype(np.int32)]


def _runs(batches):
    """Hash and place of every run of ``LEAST`` shingles around a wanted half."""
    for batch in batches:
        nodes = batch.column("node").to_pylist()
        wanted = [x.values.to_numpy() for x in batch.column("wanted")]
        done = 0
        for some in sequences(texts(batch)):
            part = slice(done, done + len(some))
            done += len(some)
            found = runs_of(nodes[part], [shingles for _, shingles in some], wanted[part])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["run", "node", "begin"])


def candidates(owner: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges (u from, u to, v from, v to) where windows of enough functions meet, and the owner of each. Rows of ``group``
    are (fn, ul, uc, ur, vl, vc, vr); those of one owner, a small number, are of one pair of nodes."""
    lag = group[:, 5] - group[:, 2]
    order = np.argsort((owner << 33) + lag)  # centres have 32 bits
    owner, group, lag = owner[order], group[order], lag[order]
    line = np.cumsum(np.append(0, (np.diff(owner) != 0) | (np.diff(lag) > LEAST)))  # along one diagonal
    order = np.argsort((line << 32) + group[:, 2])
    group, line = group[order], line[order]  # owners stay where they are
    starts = np.flatnonzero(np.append(True, (np.diff(line) != 0) | (np.diff(group[:, 2]) > 2 * LEAST)))
    met = np.bitwise_count(np.bitwise_or.reduceat(1 << group[:, 0], starts)) >= ENOUGH
    low, high = np.minimum.reduceat(group, starts)[met], np.maximum.reduceat(group, starts)[met]
    return owner[starts[met]], np.stack([
        np.maximum(low[:, 1], low[:, 2] - LEAST), np.minimum(high[:, 3], high[:, 2] + LEAST),
        np.maximum(low[:, 4], low[:, 5] - LEAST), np.minimum(high[:, 6], high[:, 5] + LEAST)], axis=1)


def _candidates(batches):
    """Rows (u, v, up, vp) that come pair by pair: the candidates of whole pairs."""
    held, size, enough = [], 0, TAKEN

    def work(whole: bool):
        nonlocal held, size, enough
        u, v, up, vp = (np.concatenate(x) for x in zip(*held))
        starts = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])))
        cut = len(u) if whole else int(starts[-1])  # the last pair may go on
        held, size = [tuple(x[cut:] for x in (u, v, up, vp))], len(u) - cut
        enough = TAKEN + 2 * size
        starts = starts[starts < cut]
        if not len(starts):
            return
        # pairs that do not meet in enough functions at all are left out
        met = np.bitwise_count(np.bitwise_or.reduceat(1 << (up[:cut] >> 44 & 15), starts)) >= ENOUGH
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, cut)))
        keep = np.flatnonzero(met[owner])
        if len(keep):
            owner, found = candidates(owner[keep], np.hstack([unpacked(up[keep]), unpacked(vp[keep])[:, 1:]]))
            at = starts[owner]
            yield pa.RecordBatch.from_arrays([pa.array(u[at]), pa.array(v[at]), *(
                pa.array(np.ascontiguousarray(c)) for c in found.T)], ["u", "v", "uf", "ut", "vf", "vt"])

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(c).to_numpy() for c in ("u", "v", "up", "vp")))
            size += batch.num_rows
            if size >= enough:
                yield from work(False)
    if size:
        yield from work(True)


def _slices(batches):
    for batch in batches:
        nodes, parts = batch.column("node").to_numpy(), batch.column("wanted")
        for node, shingles, wanted in zip(nodes, each(texts(batch)), parts):
            begin, end = (wanted.values.field(c).to_numpy() for c in ("begin", "end"))
            shingles = signed(shingles)
            for at in range(0, len(begin), 64):
                b, e = begin[at : at + 64], end[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), node)), pa.array(b), pa.array(e),
                     pa.array([shingles[x:y].tobytes() for x, y in zip(b.tolist(), e.tolist())], pa.binary())],
                    ["node", "begin", "end", "data"])


def flat(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of several ranges [begin, end), one after the other, where each begins, and the range of each place."""
    sizes = end - begin
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(row)) + (begin - starts)[row], starts, row


def _first(good: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each range, the first place that is good; each has one."""
    at = np.flatnonzero(good)
    return at[np.searchsorted(at, starts)]


class Pairs:
    """Several pairs of sequences of shingles, u and v, compared abreast. Places count on from one u (or v) to the next."""

    def __init__(self, ones: list[np.ndarray], twos: list[np.ndarray]):
        n, sizes = len(ones), np.array([len(x) for x in ones + twos])
        salt = mix(np.arange(n, dtype=np.uint64))  # shingles of different pairs are different
        values = np.concatenate(ones + twos).view(np.uint64) ^ np.repeat(np.append(salt, salt), sizes)
        known, ids = np.unique(values, return_inverse=True)
        cut = int(sizes[:n].sum())
        self.u, self.v = ids[:cut], ids[cut:]
        self.u_end, self.v_end = np.cumsum(sizes[:n]), np.cumsum(sizes[n:])
        self.u_begin, self.v_begin = self.u_end - sizes[:n], self.v_end - sizes[n:]
        has = np.zeros(len(known), bool)
        has[self.v] = True
        self.shared = has[self.u]
        self.sums = np.append(0, np.cumsum(np.where(self.shared, 1, -8)))
        self.place, self.once = np.full(len(known), -1), np.zeros(len(known), np.int64)

    def _scores(self, begin: np.ndarray, end: np.ndarray):
        """Sums before and after each place of the ranges, a shared shingle counting 1 and another -8, and the lowest so far."""
        at, starts, row = flat(begin, end)
        base, apart_ = self.sums[begin][row], row << 32
        before, after = self.sums[at] - base, self.sums[at + 1] - base
        return before, after, np.minimum.accumulate(before - apart_) + apart_, starts, row

    def longest(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the longest stretch of which at least eight of nine places are shared."""
        _, after, lowest, starts, row = self._scores(begin, end)
        first = np.searchsorted((row << 32) - lowest, (row << 32) - after)  # before which the sum is not above the one at the end
        lengths = np.arange(1, len(row) + 1) - first
        last = _first(lengths == np.maximum.reduceat(lengths, starts)[row], starts)
        return begin + first[last] - starts, begin + last - starts

    def densest(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretch of the largest sum."""
        before, after, lowest, starts, row = self._scores(begin, end)
        score = after - lowest
        last = _first(score == np.maximum.reduceat(score, starts)[row], starts)
        first = np.maximum.accumulate(np.where(before == lowest, np.arange(len(row)), 0))[last]
        return begin + first - starts, begin + last - starts

    def similar(self, pair: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the stretches [begin, end] of u, one of a pair, have counterparts in v whose sets of shingles are similar
        enough, and the first and last place of these."""
        at, starts, row = flat(begin, end + 1)
        ids, offset = self.u[at], at - begin[row]
        self.place[ids[::-1]] = offset[::-1]  # the first of equal ones
        ones = np.add.reduceat((self.place[ids] == offset).astype(np.int64), starts)
        base = self.v_begin[pair]
        at, _, row = flat(base, self.v_end[pair])
        place = self.place[self.v[at]]
        hit = np.flatnonzero(place >= 0)
        at, row = at[hit], row[hit]
        lag = at - base[row] - place[hit]
        # of several places in v, the one with the most
        lags, often = np.unique((row << 34) + lag + (1 << 33), return_counts=True)
        starts = np.searchsorted(lags >> 34, np.arange(len(pair)))
        most = _first(often == np.maximum.reduceat(often, starts)[lags >> 34], starts)
        near = np.abs(lag - (lags[most] & (1 << 34) - 1)[row] + (1 << 33)) <= LEAST
        at, row = at[near], row[near]
        rows = np.arange(len(pair))
        first, last = at[np.searchsorted(row, rows)], at[np.searchsorted(row, rows, side="right") - 1]
        # how many different shingles: of both, of v alone
        two, starts, row = flat(first, last + 1)
        two, count = self.v[two], np.arange(len(two))
        self.once[two[::-1]] = count[::-1]
        different, met = self.once[two] == count, self.place[two] >= 0
        both, alone = (np.add.reduceat((different & x).astype(np.int64), starts) for x in (met, ~met))
        self.place[ids] = -1
        good = (last + 1 - first >= LEAST * PERCENT // 100) & (100 * both >= PERCENT * (ones + alone))
        return good, first, last

    def passages(self) -> np.ndarray:
        """Rows (pair, first and last shingle in u, in v) of the passages: in each u the longest stretch, or the densest if the
        longest, which may reach over several places of v, is not similar to one of them; then those in what is left of u on
        either side."""
        pending = np.stack([np.arange(len(self.u_end)), self.u_begin, self.u_end], axis=1)
        found = [np.zeros((0, 5), np.int64)]
        while len(pending):
            pair, begin, end = pending.T
            # a stretch of ``LEAST`` has enough shared ones
            pending = pending[(end - begin >= LEAST) & (self.sums[end] - self.sums[begin] + 8 * (end - begin) >= 8 * LEAST)]
            now = np.unique(pending[:, 0], return_index=True)[1]  # one of each pair
            (pair, begin, end), pending = pending[now].T, np.delete(pending, now, axis=0)
            seen = None
            for stretch in (self.longest, self.densest):
                if not len(pair):
                    break
                first, last = stretch(begin, end)
                asked = last - first + 1 >= LEAST
                if seen is not None:
                    asked &= (first != seen[0]) | (last != seen[1])
                good, there, until = np.zeros(len(pair), bool), np.zeros_like(pair), np.zeros_like(pair)
                if asked.any():
                    good[asked], there[asked], until[asked] = self.similar(pair[asked], first[asked], last[asked])
                p = pair[good]
                found.append(np.stack([p, first[good] - self.u_begin[p], last[good] - self.u_begin[p],
                                       there[good] - self.v_begin[p], until[good] - self.v_begin[p]], axis=1))
                pending = np.concatenate([pending, np.stack([p, begin[good], first[good]], axis=1),
                                          np.stack([p, last[good] + 1, end[good]], axis=1)])
                pair, begin, end, seen = pair[~good], begin[~good], end[~good], (first[~good], last[~good])
        return np.concatenate(found)


def aligned(u: np.ndarray, v: np.ndarray) -> tuple[int, int, int, int] | None:
    """The first passage of ``u`` and ``v`` (first and last shingle of each), if there is one."""
    found = Pairs([u], [v]).passages()
    return tuple(found[0, 1:].tolist()) if len(found) else None


def _verified(batches):
    for batch in batches:
        u, v, uf, vf = (batch.column(c).to_numpy() for c in ("u", "v", "uf", "vf"))
        ones, twos = ([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(c)] for c in ("one", "two"))
        # pairs of about so many shingles together
        group = np.cumsum([len(x) + len(y) for x, y in zip(ones, twos)]) // (4 * TOGETHER)
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist() + [len(u)] if len(u) else []
        for a, b in zip(cuts, cuts[1:]):
            pair, begin, end, first, last = Pairs(ones[a:b], twos[a:b]).passages().T
            pair = pair + a
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in ((u[pair], v[pair]), (uf[pair] + begin, vf[pair] + first),
                                                       (uf[pair] + end + WORDS, vf[pair] + last + WORDS))], ["node", "begin", "end"])


def ranges(pairs: DataFrame) -> DataFrame:
    """The distinct (node, begin, end) that ``pairs`` need, on a grid: however many partners a node has, its text has
    few of them."""
    def grid(side: str):
        begin, end = F.col(f"{side}f"), F.col(f"{side}t")
        return pairs.select(F.col(side).alias("node"), (begin - begin % GRID).alias("begin"),
                            (end - end % GRID + GRID).alias("end"))

    return grid("u").unionByName(grid("v")).distinct()


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The passages (node, begin, end) of the candidates ``pairs`` (u, v, uf, ut, vf, vt). Each range is cut once; the
    pairs are joined to it and keep their part."""
    asked = (ranges(pairs).join(nodes.select("node", "one.*"), "node").groupBy("node", "doc_id", "same")
             .agg(F.collect_list(F.struct("begin", "end")).alias("wanted")))
    slices = stored(read(docs, asked, "asked").mapInArrow(_slices, "node long, begin long, end long, data binary")
                    .dropDuplicates(["node", "begin", "end"]), "slices")
    for side, data in (("u", "one"), ("v", "two")):
        begin, end = F.col(f"{side}f"), F.col(f"{side}t")
        found = slices.select(F.col("node").alias(side), F.col("begin").alias(f"{side}b"), F.col("end").alias(f"{side}e"),
                              F.col("data").alias(data))
        pairs = pairs.withColumns({f"{side}b": begin - begin % GRID, f"{side}e": end - end % GRID + GRID}).join(
            found, [side, f"{side}b", f"{side}e"]).withColumn(data, F.substring(
                data, (begin - F.col(f"{side}b")).cast("int") * 8 + 1, (end - begin + 1).cast("int") * 8)).drop(f"{side}b", f"{side}e")
    return pairs.select("u", "v", "uf", "vf", "one", "two").mapInArrow(
        _verified, "node long, begin long, end long")


def equal(docs: DataFrame, nodes: DataFrame, halves_met: DataFrame) -> DataFrame:
    """The equal passages (node, begin, end), run by run, of nodes with the halves ``halves_met`` (node, key)."""
    asked = (halves_met.groupBy("node").agg(F.collect_set("key").alias("wanted"))
             .join(nodes.select("node", "one.*"), "node"))
    runs = stored(read(docs, asked, "halves").mapInArrow(_runs, "run long, node long, begin int"), "runs")
    # equal rows of a document bring the same runs
    often = runs.groupBy("run").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("run")
    begins = runs.join(often, "run").groupBy("node").agg(F.collect_set("begin").alias("begins"))
    return begins.mapInArrow(_ranges, "node long, begin long, end long")


def _ranges(batches):
    """Consecutive runs as one passage."""
    for batch in batches:
        out = []
        for node, begins in zip(batch.column("node").to_pylist(), batch.column("begins")):
            at = np.sort(np.array(begins.as_py(), np.int64))
            cut = np.flatnonzero(np.diff(at) > 1)
            out += [(node, int(b), int(e) + LEAST_WORDS) for b, e in zip(at[np.append(0, cut + 1)], at[np.append(cut, -1)])]
        columns = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "begin", "end"])


def _open(batches):
    """The windows (sig, place) whose centre lies in none of the spans of their node."""
    def parts():
        for batch in batches:
            for node, windows, spans in zip(batch.column("node").to_pylist(), batch.column("windows"), batch.column("spans")):
                sig, place = (windows.values.field(c).to_numpy() for c in ("sig", "place"))
                inside = np.zeros(len(place), bool)
                if spans.is_valid:
                    begin, end = (spans.values.field(c).to_numpy() for c in ("begin", "end"))  # by begin
                    centre = place & 0xFFFFFFFF
                    at = np.searchsorted(begin, centre, side="right") - 1
                    inside = (at >= 0) & (np.maximum.accumulate(end)[at] - WORDS >= centre)
                if not inside.all():
                    yield sig[~inside], np.full(int((~inside).sum()), node), place[~inside]

    yield from _batched(parts(), ["sig", "node", "place"])


def around(places: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` shingles lie in one of the windows."""
    _, left, _, right = unpacked(places).T
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, left, 1)
    np.add.at(change, np.minimum(right + 1, size), -1)
    return np.cumsum(change)[:-1] > 0


def _around(batches):
    """The shingles in the wanted windows and their places."""
    def parts():
        for batch in batches:
            for node, shingles, wanted in zip(batch.column("node").to_pylist(), each(texts(batch)), batch.column("wanted")):
                at = np.flatnonzero(around(wanted.values.to_numpy(), len(shingles)))
                yield signed(shingles[at]), np.full(len(at), node), at

    yield from _batched(parts(), ["shingle", "node", "at"])


def _batched(parts: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns of many nodes in batches of some thousand rows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)


def rarest(rank: np.ndarray, inside: np.ndarray, least: int, rate: int, centres: np.ndarray | None = None) -> np.ndarray:
    """The places that have, in some stretch of at least ``least`` places ``inside`` (around one of ``centres``, if given), at
    most one place in ``rate`` before them by ``rank``; not those of rank 0. Stretches reach less than 2 * ``least`` to
    either side."""
    reach, found = 2 * least - 1, []
    padded = np.full(len(rank) + 2 * reach, -1, np.int32)
    padded[reach:-reach] = np.where(inside, rank, -1)
    views = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1)
    wanted = np.flatnonzero(inside & (rank > 0))
    more = np.maximum(least - 1 - np.arange(reach + 1), 0)
    for begin in range(0, len(wanted), 1000):
        at = wanted[begin : begin + 1000]
        here = views[at]
        score = np.where(here < padded[at + reach][:, None], np.int32(1 - rate), np.int32(1))
        score[here < 0] = -rate * reach
        right = np.cumsum(score[:, reach:], axis=1, dtype=np.int32)  # of the place itself and so many after it
        left = np.zeros_like(right)  # of so many before it
        np.cumsum(score[:, reach - 1 :: -1], axis=1, out=left[:, 1:])
        best = np.maximum.accumulate(right[:, ::-1], axis=1)[:, ::-1]  # of so many or more after it
        if centres is None:
            good = (left + best[:, more]).max(axis=1) >= 0
        else:  # the stretch goes on to the centre before the place, or to the one after it
            k, steps = np.searchsorted(centres, at, side="right"), np.arange(reach + 1)
            before = np.where(k > 0, at - centres[k - 1], reach + 1)[:, None]
            after = np.where(k < len(centres), centres[np.minimum(k, len(centres) - 1)] - at, reach + 1)[:, None]
            good = np.where(steps >= before, left + best[:, more], -1).max(axis=1) >= 0
            right = np.where(steps >= after, right, -rate * reach * reach)
            best = np.maximum.accumulate(right[:, ::-1], axis=1)[:, ::-1]
            good |= (left + best[:, more]).max(axis=1) >= 0
        found.append(at[good])
    return np.concatenate(found) if found else wanted


def _rarest(batches):
    """The rarest shingles of windows, and whether they are those of open ones. Places that are not listed have a shingle
    that no other node has."""
    def parts():
        for batch in batches:
            for node, *columns in zip(batch.column("node").to_pylist(), *(batch.column(c) for c in ("wanted", "open", "listed"))):
                part = rarest_of(node, *columns)
                if part:
                    yield part

    yield from _batched(parts(), ["shingle", "node", "low", "high", "open"])


def rarest_of(node: int, wanted: pa.ListScalar, is_open: pa.ListScalar, listed: pa.ListScalar) -> tuple[np.ndarray, ...] | None:
    at, often, shingle = (listed.values.field(c).to_numpy() for c in ("at", "often", "shingle"))
    wanted = wanted.values.to_numpy()
    size = int(max(at.max(), unpacked(wanted)[:, 3].max())) + 1
    order = np.lexsort((shingle, often))
    rank, shingles = np.zeros(size, np.int64), np.zeros(size, np.int64)
    rank[at[order]] = np.cumsum(np.append(True, np.diff(shingle[order]) != 0))  # equal ones have equal ranks
    shingles[at] = shingle
    found = rarest(rank, around(wanted, size), LEAST * PERCENT // 100, 5)
    if not len(found):
        return None
    inside = np.zeros(size, bool)
    if is_open.is_valid:
        windows = is_open.values.to_numpy()
        inside[rarest(rank, around(windows, size), LEAST, 9, np.unique(unpacked(windows)[:, 2]))] = True
    # those of one shingle that are near each other as one
    order = np.lexsort((found, found // (2 * LEAST), rank[found], inside[found]))
    found = found[order]
    new = np.append(True, (np.diff(rank[found]) != 0) | (np.diff(found // (2 * LEAST)) != 0) | (np.diff(inside[found]) != 0))
    first, last = found[new], found[np.append(new[1:], True)]
    return shingles[first], np.full(len(first), node), first, last, inside[first]


def crowded(docs: DataFrame, nodes: DataFrame, crowds: DataFrame, spans: DataFrame) -> DataFrame:
    """The candidates (u, v, uf, ut, vf, vt) that open windows of ``crowds`` (node, sig, place) make with the other windows
    of their signatures. ``spans`` (node, spans) has the passages found so far."""
    windows = crowds.groupBy("node").agg(F.collect_list(F.struct("sig", "place")).alias("windows"))
    left = stored(windows.join(spans, "node", "left").mapInArrow(_open, "sig long, node long, place long"), "open")
    near = crowds.join(bounded(stored(left.select("sig").distinct(), "sigs")), "sig", "left_semi")
    near = stored(near.groupBy("node").agg(F.collect_set("place").alias("wanted")), "near")
    shingles = stored(read(docs, near.join(nodes.select("node", "one.*"), "node"), "crowded").mapInArrow(
        _around, "shingle long, node long, at long"), "around")
    shared = shingles.groupBy("shingle").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("often")).where(
        "a <> b").select("shingle", "often")
    listed = shingles.join(shared, "shingle").groupBy("node").agg(F.collect_list(F.struct("at", "often", "shingle")).alias("listed"))
    is_open = left.groupBy("node").agg(F.collect_set("place").alias("open"))
    few = near.join(listed, "node").join(is_open, "node", "left").mapInArrow(
        _rarest, "shingle long, node long, low long, high long, open boolean")
    few = stored(few, "rarest")
    met = few.where("open").select("shingle", F.col("node").alias("n"), F.col("low").alias("from"), F.col("high").alias("to")).join(
        few.drop("open"), "shingle").where("n <> node")
    swap = F.col("n") > F.col("node")
    sides = [(F.when(swap, F.col(y)).otherwise(F.col(x)), F.when(swap, F.col(x)).otherwise(F.col(y)))
             for x, y in (("n", "node"), ("from", "low"), ("to", "high"))]
    met = met.select(*(c.alias(a) for names, side in zip((("u", "v"), ("ub", "vb"), ("ue", "ve")), sides)
                       for a, c in zip(names, side)))
    # along one diagonal, as far as the places are near each other
    wide, zero = 2 * LEAST, F.lit(0).cast("long")
    met = met.groupBy("u", "v", F.floor((F.col("vb") - F.col("ub")) / wide), F.floor(F.col("ub") / wide)).agg(
        F.min("ub").alias("ub"), F.max("ue").alias("ue"), F.min("vb").alias("vb"), F.max("ve").alias("ve"))
    return met.select("u", "v", F.greatest(zero, F.col("ub") - wide).alias("uf"), (F.col("ue") + wide).alias("ut"),
                      F.greatest(zero, F.col("vb") - wide).alias("vf"), (F.col("ve") + wide).alias("vt"))


def covered(spans: DataFrame) -> DataFrame:
    """The distinct spans (node, begin, end) in order, per node."""
    return spans.distinct().groupBy("node").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def read(docs: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """(node, text, wanted) of ``asked`` (node, doc_id, same, wanted)."""
    asked = bounded(stored(asked, name), 500_000).select(
        "node", F.col("doc_id").alias("id"), F.col("same").alias("text_hash"), "wanted")
    return docs.join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("text_hash"))).select(
        "node", "text", "wanted")


def passages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_passages (disjoint ones), n_dup_words (words in them), repeated (any)."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("same"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    base = stored(docs.mapInArrow(_nodes, f"doc_id {id_type}, same long, n_words long, node long"), "sequences")
    nodes = stored(base.where(F.col("n_words") >= LEAST_WORDS).groupBy("node").agg(
        F.count("*").alias("held"), F.max("n_words").alias("n_words"), F.min(F.struct("doc_id", "same")).alias("one")),
        "nodes")

    windows = docs.mapInArrow(_windows, "sig long, node long, place long")
    met = (windows.repartition(F.col("sig")).sortWithinPartitions("sig")
           .mapInArrow(_met, "u long, v long, up long, vp long"))
    met = stored(met, "met")
    halves_met = met.where("u = v AND vp < 0").selectExpr("u as node", "up as key")
    crowds = met.where("u = v AND vp >= 0").selectExpr("u as node", "up as sig", "vp as place")
    met = met.where("u <> v")
    met = met.repartition("u", "v").withColumn("pair", F.xxhash64("u", "v")).sortWithinPartitions("pair").drop("pair")
    pairs = stored(met.mapInArrow(_candidates, "u long, v long, uf long, ut long, vf long, vt long"), "candidates")
    spans = verified(docs, nodes, pairs).unionByName(equal(docs, nodes, halves_met))
    whole = nodes.where("held > 1").select("node", F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end"))
    spans = stored(covered(spans.unionByName(whole)), "spans")
    rest = stored(crowded(docs, nodes, crowds, spans), "candidates")
    more = verified(docs, nodes, rest)
    spans = covered(spans.select("node", F.inline("spans")).unionByName(more))
    # words covered and disjoint passages, span by span in order
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("passages"),
                     F.lit(-1).cast("long").alias("reach"))
    folded = F.aggregate("spans", start, lambda a, s: F.struct(
        (a.words + F.greatest(F.lit(0), s.end - F.greatest(s.begin, a.reach))).cast("long").alias("words"),
        (a.passages + (s.begin > a.reach).cast("long")).alias("passages"), F.greatest(s.end, a.reach).alias("reach")))
    counts = spans.select("node", folded.alias("f")).select("node", "f.words", "f.passages")
    long = F.col("n_words") >= LEAST_WORDS
    return base.join(counts, "node", "left").select(
        "doc_id", "n_words", F.when(long, F.coalesce("passages", F.lit(0))).otherwise(0).cast("long").alias("n_passages"),
        F.when(long, F.coalesce("words", F.lit(0))).otherwise(0).cast("long").alias("n_dup_words"),
        (long & F.col("words").isNotNull()).alias("repeated"))
