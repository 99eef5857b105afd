"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the hashes of its distinct 5-word shingles. Two sets of the same size band whose similarity is
at least 0.8 differ in few elements. The feature domain is cut into ``first`` partitions, each into ``SECOND`` parts;
every subset of ``SECOND - DIFFER`` parts is a signature: which parts, and the set's elements in them. More parts hold
elements than two linked sets can differ in, so some signature is shared.

Steps: equal sets collapse to one node. Nodes that share a signature held by few are counted as pairs; a linked pair
shares at least as many as the parts it cannot differ in, which leaves few pairs to be verified. A signature of more than
``CROWD`` nodes is not paired; it matters only to nodes that have as many crowded signatures as any partner must share.
Those are compared along stars first, and what the links leave in several components is joined exactly by as many of the
nodes' rarest crowded signatures as a partner may miss, and one more.

Defined cases: null or empty text and text of white space have an empty set and are linked with nothing; a text under
five words is one shingle; repeated rows come out once each; null ids form no component of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import bounded, components, grams, mix, signed, small_batches, stored, texts, word_hashes

WORDS = 5
PERCENT = 80
#: Ratio of a size band; over 1 / 0.8, so that linked sets are in the same band or the next.
BAND = 1.6
#: Parts per element of the largest set of a band. Linked sets differ in a quarter of the elements at most.
DENSITY = 0.30
SECOND, DIFFER = 2, 1
#: Signatures shared by more nodes are handled apart.
CROWD = 16
#: Words of the parities that go along with single shingles.
SKETCH = 16
#: Distinct sets of which a task remembers that their signatures are out.
SEEN = 200_000

BOUNDS = [4]
while BOUNDS[-1] < 1 << 48:
    BOUNDS.append(int(BOUNDS[-1] * BAND))
BOUNDS = np.array(BOUNDS)


def shingle_set(raw: bytes) -> np.ndarray:
    return np.unique(grams(word_hashes(raw, lower=True), WORDS))


def digests(elements: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values that stand for the set."""
    one, two = mix(elements).sum(dtype=np.uint64), mix(elements ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def signatures(elements: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each band in which the set can meet partners: its signatures, and the number of parts with elements, or 0
    if those are so few that the signatures of empty parts are given as well."""
    n = len(elements)
    if n < BOUNDS[0]:  # such a set is linked with equal sets only
        return
    own = int(np.searchsorted(BOUNDS, n))
    for band in [own] + [own - 1] * int(own > 0 and 100 * BOUNDS[own - 1] >= PERCENT * n):
        first = math.ceil((DENSITY * BOUNDS[band] + 2) / SECOND)
        place = (mix(elements + np.uint64(7919 * (band + 1))) % np.uint64(first * SECOND)).astype(np.int64)
        sums = np.zeros(first * SECOND, np.uint64)
        np.add.at(sums, place, mix(elements))
        # DIFFER is SECOND - 1: the subsets of SECOND - DIFFER parts are the single parts
        values = mix(sums ^ mix(np.arange(first * SECOND, dtype=np.uint64) + np.uint64(band << 40)))
        held = np.bincount(place, minlength=first * SECOND) > 0
        parts = int(held.sum())
        yield (values[held], parts) if parts > n * (100 - PERCENT) // PERCENT else (values, 0)


def _sets(batches):
    for batch in batches:
        rows = [(len(s), *digests(s)) for s in map(shingle_set, texts(batch))]
        n, d1, d2 = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                                          pa.array(d2, pa.int64())], ["doc_id", "n_shingles", "d1", "d2"])


def _signatures(batches):
    seen: set[int] = set()
    for batch in batches:
        out = []
        for raw in texts(batch):
            elements = shingle_set(raw)
            node = digests(elements)[0]
            if node in seen:
                continue
            if len(seen) < SEEN:
                seen.add(node)
            out += [(signed(v), np.full(len(v), node), np.full(len(v), parts, np.int32))
                    for v, parts in signatures(elements)]
            if sum(len(x[0]) for x in out) > 200_000:
                yield _batch(["sig", "node", "parts"], map(np.concatenate, zip(*out)))
                out = []
        if out:
            yield _batch(["sig", "node", "parts"], map(np.concatenate, zip(*out)))


def _batch(names: list[str], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def _shared(batches):
    """Rows ordered by (sig, node): the nodes that share a signature, with the first of them."""
    names = ["sig", "node", "parts"]
    last = None  # sig, node, parts of the row before, then node and parts of the first row of its run
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node, parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        if last is not None:
            sig, node, parts = (np.concatenate([[x], y]) for x, y in zip(last[:3], (sig, node, parts)))
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node, parts = sig[keep], node[keep], parts[keep].astype(np.int32)
        begins = np.ones(len(sig), bool)
        begins[1:] = sig[1:] != sig[:-1]
        start = np.maximum.accumulate(np.where(begins, np.arange(len(sig)), 0))
        first, first_parts = node[start], parts[start]
        if last is not None:  # the run that goes on
            going = start == 0
            first, first_parts = np.where(going, last[3], first), np.where(going, last[4], first_parts)
        at = np.flatnonzero(~begins)
        last = (sig[-1], node[-1], parts[-1], first[-1], np.int32(first_parts[-1]))
        if len(at):
            yield _batch(["sig", "first", "first_parts", "node", "parts"],
                         (sig[at], first[at], first_parts[at].astype(np.int32), node[at], parts[at]))


def parities(elements: np.ndarray, words: int = 0) -> np.ndarray:
    """Per hash bucket whether an odd number of elements is in it, as bits of 64-bit words; some four buckets an element
    unless the number of words is given.

    Each element that two sets do not share flips one bit: the bits in which they differ are never more than those.
    """
    words = words or 1 << max(0, (4 * len(elements) - 1).bit_length() - 6)
    hashed = mix(elements ^ np.uint64(0xA0761D6478BD642F))
    # word and bit are drawn apart, so that the two halves of the words add up to the words of a set of half the size
    place = ((hashed % np.uint64(words)) * np.uint64(64) + (hashed >> np.uint64(58))).astype(np.int64)
    odd = (np.bincount(place, minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _elements(batches):
    for batch in batches:
        found = [shingle_set(raw) for raw in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), pa.array([len(s) for s in found], pa.int64()),
             pa.array([parities(s) for s in found], pa.list_(pa.int64())),
             pa.array([parities(s, SKETCH) for s in found], pa.list_(pa.int64())),
             pa.array([signed(s) for s in found], pa.list_(pa.int64()))], ["rep", "n", "parities", "sketch", "elements"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough; most others differ in too many parities already."""
    def side(c, column):
        return sets.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col(column).alias(f"e_{c}"))

    def halved(bits):
        half = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    rough = (pairs.join(side("u", "parities"), "u").join(side("v", "parities"), "v").where(_fit("n_u", "n_v")))
    one = F.when(F.size("e_u") > F.size("e_v"), halved(F.col("e_u"))).otherwise(F.col("e_u"))
    two = F.when(F.size("e_v") > F.size("e_u"), halved(F.col("e_v"))).otherwise(F.col("e_v"))
    rough = rough.where(_alike(one, two, F.col("n_u") + F.col("n_v"))).select("u", "v")
    both = F.size(F.array_intersect("e_u", "e_v"))
    return (rough.join(side("u", "elements"), "u").join(side("v", "elements"), "v")
            .where(100 * both >= PERCENT * (F.col("n_u") + F.col("n_v") - both)).select("u", "v"))


def _alike(one, two, size):
    """Whether parities differ in no more bits than linked sets of together ``size`` elements can differ in elements."""
    differ = F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return (100 + PERCENT) * differ <= (100 - PERCENT) * size


def _pair(one: str, two: str):
    return F.struct(F.least(one, two).alias("u"), F.greatest(one, two).alias("v"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id reachable by links, itself included)."""
    docs = small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    base = stored(docs.mapInArrow(_sets, "doc_id long, n_shingles long, d1 long, d2 long"), "shingle-sets")
    classes = stored(base.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2")
                     .agg(F.min("doc_id").alias("rep")), "shingle-classes")

    rows = docs.mapInArrow(_signatures, "sig long, node long, parts int")
    shared = stored(
        rows.repartition(F.col("sig")).sortWithinPartitions("sig", "node")
        .mapInArrow(_shared, "sig long, first long, first_parts int, node long, parts int"), "shared")
    nodes = classes.where("rep is not null").select(F.col("d1").alias("node"), "rep", F.col("n_shingles").alias("n"))
    held = shared.select("sig", "node", "parts").unionByName(
        shared.select("sig", F.col("first").alias("node"), F.col("first_parts").alias("parts")).distinct())
    sizes = shared.groupBy("sig").agg((F.count("*") + 1).alias("size"))
    held = stored(held.join(sizes, "sig").join(nodes, "node").select("sig", "rep", "parts", "n", "size"), "held")

    crowded = stored(held.where(F.col("size") > CROWD).groupBy("rep", "parts", "n")
                     .agg(F.count("*").alias("crowds")), "crowds")
    # every partner may be hidden among the crowds
    differ = F.floor(F.col("n") * (100 - PERCENT) / PERCENT)
    unsafe = stored(crowded.where(F.col("crowds") >= F.col("parts") - differ).select("rep").distinct(), "unsafe")
    near = stored(_counted(held.where(F.col("size") <= CROWD), crowded), "near")
    stars = stored(_stars(held.where(F.col("size") > CROWD).join(unsafe, "rep", "left_semi"), crowded), "stars")

    wanted = near.unionByName(stars)
    wanted = wanted.select(F.col("u").alias("rep")).union(wanted.select("v")).union(unsafe).distinct()
    wanted = bounded(stored(wanted, "wanted"))
    sets = stored(docs.join(wanted, docs.doc_id == wanted.rep).select("rep", "text")
                  .mapInArrow(_elements, "rep long, n long, parities array<long>, sketch array<long>, elements array<long>").dropDuplicates(["rep"]), "sets")
    links = stored(_verified(near.unionByName(stars).distinct(), sets), "links")
    joined = components(links)

    # crowded signatures that still join several components
    open_ = (held.where(F.col("size") > CROWD).join(unsafe, "rep", "left_semi")
             .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
             .select("sig", "rep", "parts", "n", "size", F.coalesce("component", "rep").alias("part")))
    mixed = open_.groupBy("sig").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    rest = stored(_prefixes(open_.join(mixed, "sig", "left_semi")), "prefixes")
    if not rest.isEmpty():
        pairs = stored(_met(rest, sets), "prefix-pairs")
        more = _verified(pairs.join(stars, ["u", "v"], "left_anti"), sets)
        joined = components(links.unionByName(more))
    joined = joined.withColumnRenamed("node", "rep")
    return (
        base.join(classes, ["n_shingles", "d1", "d2"], "left").join(joined, "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )


def _counted(held: DataFrame, crowded: DataFrame) -> DataFrame:
    """Pairs (u, v) that share enough of the signatures in ``held``, each of which has ``CROWD`` nodes at most.

    Every part that holds elements of one set and is not shared has a difference of its own, and linked sets have
    ``(n + m) * 20 / 180`` differences at most. Crowded signatures, which are not in ``held``, count as shared.
    """
    def side(rep, parts, n, crowds):
        return crowded.select(F.col("rep").alias(rep), F.col("parts").alias(parts), F.col("n").alias(n),
                              F.col("crowds").alias(crowds))

    one = held.select("sig", F.col("rep").alias("u"), F.col("parts").alias("p"), F.col("n").alias("n"))
    two = held.select("sig", F.col("rep").alias("v"), F.col("parts").alias("q"), F.col("n").alias("m"))
    counts = (one.join(two, "sig").where((F.col("u") < F.col("v")) & _fit("n", "m"))
              .groupBy("u", "v", "p", "q", "n", "m").agg(F.count("*").alias("both")))
    counts = (counts.join(side("u", "p", "n", "a"), ["u", "p", "n"], "left")
              .join(side("v", "q", "m", "b"), ["v", "q", "m"], "left"))
    hidden = F.least(F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0)))
    differ = F.floor((F.col("n") + F.col("m")) * (100 - PERCENT) / (100 + PERCENT))
    # parts is 0 where empty parts were given: any shared signature counts
    return counts.where(F.col("both") + hidden >= F.greatest("p", "q") - differ).select("u", "v").distinct()


def _fit(n: str, m: str):
    """Whether the sizes allow a link."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _stars(held: DataFrame, crowded: DataFrame) -> DataFrame:
    """Each node with the hub of each of its signatures: the one of most crowded signatures, as an original has among
    its edited copies."""
    hubs = crowded.groupBy("rep").agg(F.max("crowds").alias("crowds"))
    centres = held.join(hubs, "rep").groupBy("sig").agg(F.max(F.struct("crowds", "rep")).alias("hub"))
    return (held.join(centres.select("sig", F.col("hub.rep").alias("hub")), "sig").where("rep <> hub")
            .select(_pair("rep", "hub").alias("p")).select("p.*").distinct())


def _prefixes(rows: DataFrame) -> DataFrame:
    """Of the crowded signatures ``rows`` (sig, rep, parts, n, size, part) those in which a set must meet its partners.

    Two linked sets that share no signature of few nodes share ``parts - n * 20 / 80`` of the crowded ones at least. Ordered
    by size, the first one they share then has that many less one behind it in either set's order, so that each set needs
    the signatures before those only. Edits take signatures out of the crowds, which shortens the list.
    """
    one = ["rep", "parts", "n"]
    counts = rows.groupBy(*one).agg(F.count("*").alias("crowds"))
    least = F.greatest(F.lit(1), F.col("parts") - F.floor(F.col("n") * (100 - PERCENT) / PERCENT))
    rows = rows.join(counts.select(*one, (F.col("crowds") - least + 1).alias("room")).where("room > 0"), one)
    order = Window.partitionBy(*one).orderBy("size", "sig")
    return (rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.col("room"))
            .select("sig", "rep", "n", "part").distinct())


def _met(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs of the prefixes ``rest`` (sig, rep, n, part): nodes of different parts whose sketches allow a link."""
    rest = rest.join(sets.select("rep", "sketch"), "rep")
    one, two = rest.alias("one"), rest.alias("two")
    met = (F.col("one.sig") == F.col("two.sig")) & (F.col("one.rep") < F.col("two.rep")) & (
        F.col("one.part") != F.col("two.part")) & _fit("one.n", "two.n") & _alike(
        F.col("one.sketch"), F.col("two.sketch"), F.col("one.n") + F.col("two.n"))
    return one.join(two, met).select(F.col("one.rep").alias("u"), F.col("two.rep").alias("v")).distinct()
