"""Operators against brute force on the smallest tables, and on odd input."""

import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import op1_decontaminate, op3_passage_dedup, op4_line_quality, op9_jaccard_join, op10_substring_dedup
from barloom.llm import op2_packing as packing
from barloom.llm.common import components, word_hashes

ITEM, TEXT = "item_id long, text string", "doc_id long, text string"


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- common -------------------------------------------------------------------------------

def test_words_are_hashed_by_their_bytes_alone():
    text = "Ab é\u00a0x  ab\x0bAB\t" + "long " * 500_000
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode())
    hashes = word_hashes(text.encode(), lower=False)
    assert len(hashes) == len(words)
    assert dict(zip(words, hashes.tolist())) | {} and len(set(hashes.tolist())) == len(set(words))
    same = word_hashes(b"ab AB Ab", lower=True)
    assert len(set(same.tolist())) == 1


def test_components_of_a_chain_a_star_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(300, 301), (301, 300), (5, 5)]
    out = by_id(components(spark.createDataFrame(edges, "u long, v long")))
    assert all(out[i] == (100,) for i in range(100, 141)) and all(out[i] == (7,) for i in range(200, 260))
    assert out[300] == out[301] == (300,) and 5 not in out


# ---- decontamination -----------------------------------------------------------------------

def contaminated(docs, items, window=10):
    cut = {i: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t)) for i, t in items}
    wins = collections.defaultdict(set)
    for i, w in cut.items():
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[k : k + n])].add(i)
    out = {}
    for d, t in docs:
        w, hit, found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        names = ",".join(sorted(map(str, found)))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def test_contamination_with_short_items_overlaps_and_case(spark):
    base = [f"w{i}" for i in range(30)]
    items = [(10, " ".join(base[:12])), (9, "Solo"), (2, "two words"), (3, None), (4, "..."), (5, "ÉTÉ x" + " a" * 8)]
    docs = [(1, " ".join(base).upper()), (2, "a solo, SOLO; two--words"), (3, " ".join(base[1:10])), (4, None), (5, ""),
            (6, " ".join(base[3:12])), (7, "été x" + " a" * 30), (8, "ÉTÉ X" + " a" * 30), (9, "two " * 5 + "words")]
    out = by_id(op1_decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                                spark.createDataFrame(items, ITEM)))
    assert out == contaminated(docs, items)


def test_contamination_of_odd_rows_and_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame([(1, "same text again same text again same text"), (2, "x")], ITEM)
    out = op1_decontaminate.contamination(odd, items)
    assert out.count() == odd.count()
    found = by_id(out)
    assert found[6] == found[7] and found[6][1] == 119 and found[3][1] == 1 and found[1][:2] == (0, 0)
    assert op1_decontaminate.contamination(nothing, items).count() == 0
    clean = op1_decontaminate.contamination(odd, items.where("false"))
    assert clean.where("contaminated").count() == 0 and clean.count() == odd.count()


# ---- Jaccard join ----------------------------------------------------------------------------

def linked(docs):
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", folded(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    home = {d: d for d in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and len(sets[a]) <= 1.25 * len(sets[b]) <= 1.6 * len(sets[a]):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    home[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d)) for d in sets}


def edited(rng, words, changes):
    out = list(words)
    for k in rng.choice(len(out), changes, replace=False):
        out[k] = f"z{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("length", [7, 30, 200, 600])
def test_links_near_the_threshold(spark, length):
    """Hubs with edited copies: similarities on both sides of 0.8, groups beyond the crowd limit, copies of copies."""
    rng = np.random.default_rng(length)
    docs, d = [], 100
    for hub in range(3):
        words = [f"h{hub}x{rng.integers(1 << 20)}" for _ in range(length)]
        docs.append((d, " ".join(words)))
        for k in range(30 if hub == 0 else 4):
            d += 1
            docs.append((d, edited(rng, words, int(rng.integers(0, max(2, length // 30))))))
        docs.append((d + 1, " ".join(words[: length - length // 9])))
        d += 10
    docs = [(int(i), t) for i, t in rng.permutation(np.array(docs, object))]
    out = by_id(op9_jaccard_join.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out == linked(docs)


@pytest.mark.parametrize("copies", [40, 120])
def test_crowds_without_an_original(spark, monkeypatch, copies):
    """Edited copies of a text that is not there itself: few links, many components in each crowded signature. The rows
    that are joined are a small part of the shingles, however many copies there are."""
    rng, tables = np.random.default_rng(copies), {}
    words = [f"c{rng.integers(1 << 20)}" for _ in range(300)]
    docs = [(d, edited(rng, words, int(rng.integers(3, 11)))) for d in range(copies)]

    def kept(df, name, stored=op9_jaccard_join.stored):
        tables[name] = stored(df, name)
        return tables[name]

    monkeypatch.setattr(op9_jaccard_join, "stored", kept)
    out = by_id(op9_jaccard_join.jaccard_groups(spark.createDataFrame(docs, TEXT)))
    assert out == linked(docs)
    assert len({c for _, c in out.values()}) > 1 and tables["prefix-pairs"].count() > 0
    assert tables["prefixes"].count() < sum(n for n, _ in out.values()) / 5


def test_links_of_odd_rows(spark, odd, nothing):
    out = op9_jaccard_join.jaccard_groups(odd)
    assert out.count() == odd.count()
    found = by_id(out)
    assert found[6] == found[7] == (3, 6) and found[1] == (0, 1) and found[8] == (0, 8) and found[3] == (1, 3)
    assert op9_jaccard_join.jaccard_groups(nothing).count() == 0


def test_parities_never_exceed_the_differences():
    rng = np.random.default_rng(0)
    for n in (1, 15, 17, 300):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.append(a[: n * 9 // 10], rng.integers(0, 1 << 62, 1 + n // 9).astype(np.uint64)))
        x, y = op9_jaccard_join.parities(a), op9_jaccard_join.parities(b)
        while len(x) != len(y):
            long = x if len(x) > len(y) else y
            half = long[: len(long) // 2] ^ long[len(long) // 2 :]
            x, y = (half, y) if len(x) > len(y) else (x, half)
        bits = sum(bin(int(v)).count("1") for v in (x ^ y).view(np.uint64))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


# ---- repeated substrings -------------------------------------------------------------------------

def removed(docs, length=400):
    seen = collections.Counter(x[i : i + length] for x in docs.values() for i in range(len(x) - length + 1))
    holders = collections.defaultdict(set)
    for d, x in docs.items():
        for i in range(len(x) - length + 1):
            holders[x[i : i + length]].add(d)
    out = {}
    for d, x in docs.items():
        cover = np.zeros(len(x) + 1, int)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = int(np.count_nonzero(np.diff(np.append(0, gone.astype(int))) == 1))
        elsewhere = any(len(holders[x[i : i + length]]) > 1 for i in range(len(x) - length + 1))
        out[d] = (len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), elsewhere)
    return out


@pytest.mark.parametrize("kinds", [20_000, 3])
def test_removed_bytes(spark, monkeypatch, kinds):
    """Passages of 399 to 900 bytes between other text, repeats inside a text, periods, copies; also with the way for
    crowded anchors."""
    monkeypatch.setattr(op10_substring_dedup, "KINDS", kinds)
    rng = np.random.default_rng(3)

    def prose(n):
        return "".join(rng.choice(list("abcdefgh \né"), n))

    shared = [prose(n) for n in (399, 400, 401, 500, 900)]
    texts = [prose(int(rng.integers(0, 300))) + s + prose(int(rng.integers(0, 300))) for s in shared for _ in range(5)]
    texts += [prose(700), "", "ab" * 450, "x" * 400, "x" * 401, prose(200) + shared[3] + prose(9) + shared[3], texts[0], texts[0]]
    own, end = prose(450), prose(60)  # repeats inside one text only, one of them in another text too, at its edge
    texts += [own + prose(30) + own, prose(40) + own[:430] + end + prose(5) + own[:430] + end, prose(50) + prose(500) * 2]
    texts += [prose(80) + own[10:440] + prose(90)] if kinds == 3 else []
    docs = {i: t for i, t in enumerate(texts)}
    out = by_id(op10_substring_dedup.substring_dedup(spark.createDataFrame(list(docs.items()), "doc_id long, text string")))
    assert out == removed({i: t.encode() for i, t in docs.items()})


def test_removed_bytes_of_odd_rows(spark, odd, nothing):
    out = op10_substring_dedup.substring_dedup(odd)
    found = by_id(out)
    assert out.count() == odd.count() and found[1][:3] == found[2][:3] == (0, 0, 0)
    assert found[6] == found[7] and found[6][0] == found[6][1] and found[4][1] == 300_000
    assert op10_substring_dedup.substring_dedup(nothing).count() == 0


# ---- passages ---------------------------------------------------------------------------------------

def test_passages_shared_in_whole_and_nearly(spark, odd, nothing):
    rng = np.random.default_rng(11)

    def prose(n):
        return [f"p{rng.integers(1 << 30)}" for _ in range(n)]

    passage, long = prose(70), prose(200)
    docs = [(1, " ".join(prose(60) + passage + prose(40))), (2, " ".join(prose(10) + passage + prose(90))),
            (3, " ".join(prose(150))), (4, " ".join(long)), (5, " ".join(prose(30)) + " " + edited(rng, long, 3)),
            (6, " ".join(passage[:20])), (7, " ".join(long))]
    out = by_id(op3_passage_dedup.passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {d for d, r in out.items() if r[3]} == {1, 2, 4, 5, 7}
    assert all(70 <= out[d][2] <= 80 for d in (1, 2)) and out[4][2] == out[7][2] == 200 and out[3] == (150, 0, 0, False)
    assert op3_passage_dedup.passages(odd).count() == odd.count()
    assert op3_passage_dedup.passages(nothing).count() == 0


@pytest.mark.parametrize("length", [50, 60, 70, 80, 90])
def test_one_word_changed_in_the_middle(length):
    """A passage with one middle edit between other words, against all stretches of the definition."""
    rng = np.random.default_rng(length)
    passage = rng.integers(1, 1 << 62, length).astype(np.uint64)
    other = passage.copy()
    other[length // 2] += 1
    u, v = (op3_passage_dedup.grams(np.concatenate([rng.integers(1, 1 << 62, 30).astype(np.uint64), x,
                                                    rng.integers(1, 1 << 62, 30).astype(np.uint64)]), 5) for x in (passage, other))
    shared = np.isin(u, v)
    brute = max(j - i + 1 for i in range(len(u)) for j in range(i, len(u)) if 9 * shared[i : j + 1].sum() >= 8 * (j - i + 1))
    begin, end, first, last = op3_passage_dedup.aligned(u, v)
    assert end - begin + 1 == brute >= length - 4
    both = len(np.intersect1d(u[begin : end + 1], v[first : last + 1]))
    assert both >= 0.8 * (end - begin + 1 + last - first + 1 - both)


def test_ranges_of_a_hub_do_not_grow_with_its_partners(spark):
    """A text of 300 shingles and 2,000 partners that meet it at different places."""
    pairs = spark.range(2000).selectExpr(
        "-1 as u", "id as v", "id % 97 as uf", "200 + id % 89 as ut", "id % 13 as vf", "100 + id % 11 as vt")
    rows = op3_passage_dedup.ranges(pairs.selectExpr("bigint(u) as u", "v", "uf", "ut", "vf", "vt"))
    per = {r["node"]: r["count"] for r in rows.groupBy("node").count().collect()}
    assert per[-1] <= 4 and len(per) == 2001


def test_passages_of_which_all_shingles_are_frequent(spark):
    """Two texts with a passage, between texts that hold each of its shingles by itself."""
    rng = np.random.default_rng(17)

    def prose(n):
        return [f"t{rng.integers(1 << 40)}" for _ in range(n)]

    docs, pairs = [], set()
    for _ in range(5):
        passage = prose(60)
        for _ in range(2):
            pairs.add(len(docs))
            docs.append((len(docs), " ".join(prose(30) + passage + prose(30))))
        for _ in range(16):
            pieces = [passage[i : i + 5] + prose(6) for i in rng.permutation(56)]
            docs.append((len(docs), " ".join(sum(pieces, []))))
    out = by_id(op3_passage_dedup.passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {d for d, r in out.items() if r[3]} == pairs
    assert all(60 <= out[d][2] <= 70 for d in pairs)


def test_similar_passages_in_crowded_signatures(spark):
    """Two texts with a passage but for one word, between many that hold up to 40 shingles of it, one fewer than it takes."""
    rng = np.random.default_rng(23)

    def prose(n):
        return [f"c{rng.integers(1 << 40)}" for _ in range(n)]

    docs, pairs = [], set()
    for _ in range(4):
        passage = prose(60)
        other = passage[:30] + prose(1) + passage[31:]
        for words in (passage, other):
            pairs.add(len(docs))
            docs.append((len(docs), " ".join(prose(20) + words + prose(20))))
        for k in range(80):
            begin = rng.integers(17)
            docs.append((len(docs), " ".join(prose(20) + (passage, other)[k % 2][begin : begin + 44] + prose(20))))
    docs = [docs[i] for i in rng.permutation(len(docs))]
    out = by_id(op3_passage_dedup.passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {d for d, r in out.items() if r[3]} == pairs


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 100])
def test_windows_of_crowds_whatever_the_batches(monkeypatch, batch):
    """All windows of signatures with more than ``LAGS`` + 1 of them come out once, at the border of batches too."""
    for name in ("TAKEN", "HELD"):
        monkeypatch.setattr(op3_passage_dedup, name, batch)
    sizes = [1, 6, 5, 3, 13, 1, 6]
    sig = np.repeat(np.arange(len(sizes)), sizes)
    node = np.arange(len(sig))
    place = node * 1000
    batches = [pa.RecordBatch.from_arrays([pa.array(x[at : at + batch]) for x in (sig, node, place)], ["sig", "node", "place"])
               for at in range(0, len(sig), batch)]
    rows = [tuple(r.values()) for b in op3_passage_dedup._met(batches) for r in b.to_pylist()]
    assert sorted(r for r in rows if r[0] == r[1]) == [(n, n, s, 1000 * n) for s, n in zip(sig, node) if sizes[s] > 5]
    near = {(n, m) for n in node for m in node if n < m and sig[n] == sig[m] and (m - n <= 4 or n in (0, *np.cumsum(sizes)))}
    assert {r[:2] for r in rows if r[0] != r[1]} == near


def test_rarest_places_of_all_stretches():
    rng = np.random.default_rng(4)
    for often, least, rate in ((2, 46, 9), (20, 46, 9), (500, 46, 9), (20, 36, 5), (500, 36, 5)):
        rank, inside = rng.integers(0, often, 160), np.ones(160, bool)
        inside[rng.integers(50, 160, 2)] = False
        centres = np.sort(rng.choice(160, 2, replace=False))
        brute, short, beside = set(), set(), set()  # longer stretches have parts as dense
        for i in range(160):
            for j in range(i + least, 161):
                if inside[i:j].all():
                    places = {p for p in range(i, j) if rank[p] and rate * (rank[i:j] < rank[p]).sum() <= j - i}
                    brute |= places
                    short |= places if j - i < 2 * least else set()
                    if np.any((centres >= i) & (centres < j)) and j - i < 2 * least:
                        beside |= places
        assert short <= set(op3_passage_dedup.rarest(rank, inside, least, rate).tolist()) <= brute
        found = set(op3_passage_dedup.rarest(rank, inside, least, rate, centres).tolist())
        assert beside <= found <= brute


def test_a_counterpart_that_occurs_twice():
    rng = np.random.default_rng(8)
    one, gap = (rng.integers(1, 1 << 62, 60) for _ in range(2))
    assert op3_passage_dedup.aligned(one, np.concatenate([one, gap, gap + 1, one])) == (0, 59, 0, 59)


def test_compact_windows_cover_every_long_subsequence_once():
    values = np.random.default_rng(2).integers(0, 1 << 40, 150).astype(np.uint64)
    wins = op3_passage_dedup.compact_windows(values)
    for i in range(150):
        for j in range(i + op3_passage_dedup.LEAST - 1, 150):
            owner = [(left, c, right) for left, c, right in wins if left <= i <= c <= j <= right]
            assert len(owner) == 1 and values[owner[0][1]] == values[i : j + 1].min()


def test_windows_of_many_sequences_are_those_of_each():
    """Sequences of any length, with few and with many equal values, in one array."""
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, top, n).astype(np.uint64) for top in (3, 1 << 60) for n in (46, 47, 90, 300, 2000) for _ in range(4)]
    begins = np.cumsum([0] + [len(x) for x in parts])
    found = op3_passage_dedup.forest(np.concatenate(parts), begins[:-1], begins[1:])
    alone = [(b + left, b + c, b + right) for b, x in zip(begins.tolist(), parts)
             for left, c, right in op3_passage_dedup.compact_windows(x)]
    assert sorted(map(tuple, found.tolist())) == sorted(alone)
    nodes = list(range(len(parts)))
    together = op3_passage_dedup.windows_of(nodes, parts)
    each = [op3_passage_dedup.windows_of([i], [x]) for i, x in zip(nodes, parts)]
    assert sorted(zip(*(c.tolist() for c in together))) == sorted(
        row for one in each for row in zip(*(c.tolist() for c in one)))


def test_candidates_of_many_pairs_are_those_of_each():
    """Windows of two functions along one diagonal, far from it, and of one function only."""
    rows = np.array([(0, 10, 30, 60, 110, 130, 160), (1, 20, 40, 70, 121, 141, 171), (2, 10, 30, 60, 410, 430, 460),
                     (0, 510, 530, 560, 610, 630, 660), (0, 515, 535, 565, 615, 635, 665)])
    owner, found = op3_passage_dedup.candidates(np.repeat([7, 8, 9], [5, 3, 2]), np.concatenate([rows, rows[2:], rows[:2]]))
    assert list(zip(owner.tolist(), map(tuple, found.tolist()))) == [(i, (10, 70, 110, 171)) for i in (7, 9)]


# ---- packing ------------------------------------------------------------------------------------------

def test_packing_is_an_exact_round_trip(spark, documents, plain):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    odd = [(-1, None), (-2, ""), (-3, " a  b\n\n c \t d\r\n"), (-4, "<|endoftext|> it's  x" * 50), (-5, "z" * 5000)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in [*plain.items(), *odd]}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for d, start, length, crc, total, sequence, offset in packing.pack(docs).collect():
        assert total == len(ids[d]) and crc == zlib.crc32(struct.pack(f"<{length}I", *ids[d][start : start + length]))
        pieces[d].append((start, length))
        sequences[sequence].append((offset, length))
    assert set(pieces) == set(ids)
    for parts, size in [(p, len(ids[d])) for d, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == size if size is not None else at <= 1024
    short = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(n < 1024 for n in short) <= 1  # what is left over is cut at full windows


def test_words_are_encoded_as_the_tokenizer_does(monkeypatch):
    """Letters with all kinds of characters behind and between them; a word that differs in its punctuation alone is not
    sent to the tokenizer again."""
    made = packing.Encoder(packing.TOKENIZER)
    marks = [chr(c) for c in range(33, 0x250) if not chr(c).isspace()] + ["'s", "'ll.", "...'", "$$$", "\u0301", "ʰ", "²", "<|endoftext|>"]
    words = [f"{a}{m}{b}" for m in marks for a in ("", "word", "Été") for b in ("", ",", "x", "##'t")]
    texts = [w + " " + w for w in words] + [" ".join(words), "\n".join(words), "word. word,  word"]
    for text, ids in zip(texts, made.encode(texts), strict=True):
        assert np.frombuffer(ids, made.type).tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids
    sent = []
    monkeypatch.setattr(made, "_ids", lambda parts: sent.extend(parts) or packing.Encoder._ids(made, parts))
    made.encode([" ".join(f"wordy{'!' * n}" for n in range(20))])
    assert not sent


def test_packing_of_odd_rows(odd, nothing):
    out = packing.pack(odd.select("doc_id", "text", "n"))
    assert out.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    assert out.groupBy("doc_id").sum("length").count() == 10
    assert packing.pack(nothing).count() == 0


def test_repeat_counts_use_what_there_is():
    histogram = np.zeros(1024, np.int64)
    histogram[[100, 924, 300, 362, 700]] = 500, 500, 90, 180, 1000
    plan = packing.Plan(histogram, 1024, 0)
    places = [p for n in (100, 924, 300, 362, 700) for k in range(histogram[n]) for p in plan.place(n, k)]
    used = collections.defaultdict(list)
    for sequence, offset, length in places:
        used[sequence].append((offset, length))
    for parts in used.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:])) and min(parts)[0] == 0
    assert sum(sum(n for _, n in p) < 1024 for p in used.values()) <= 1


# ---- line quality -------------------------------------------------------------------------------------

def test_base_measures(plain, documents, spark, sf_dir):
    from barloom.llm.queries import QUERIES

    out = by_id(QUERIES["op4_line_quality"](spark, sf_dir))
    for d, text in plain.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = collections.Counter(zip(w, w[1:], w[2:]))
        twice = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        assert out[d][:5] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice))
        assert out[d][6] == failed and not (failed and out[d][7])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(out[d][7], q) for d, q in labels.items() if d in out and not out[d][6]]
    assert np.mean([kept == bool(q) for kept, q in judged]) > 0.95


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    field = op4_line_quality.Field(rng.normal(size=(op4_line_quality.FEATURES, 2)), rng.normal(size=(2, 2)))
    rows = rng.random((7, op4_line_quality.FEATURES)) > 0.5
    score = rows @ field.weights
    best = max(np.ndindex(*[2] * 7), key=lambda p: sum(score[i, y] for i, y in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])))
    assert tuple(field.viterbi(rows)) == best


def test_line_quality_without_labels(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    plain = spark.createDataFrame([(20, " ".join(f"word{i}" for i in range(80)))], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(plain)
    out = op4_line_quality.line_quality(docs, labels)
    assert out.count() == docs.count() and [r.doc_id for r in out.where("kept").collect()] == [20]
    assert op4_line_quality.line_quality(nothing, labels).count() == 0


def test_shingles_of_many_texts_are_those_of_each():
    """Texts of any length hashed together, and long runs by differences of sums."""
    rng = np.random.default_rng(6)
    raws = [" ".join(f"W{x}é" for x in rng.integers(0, 50, n)).encode() for n in (0, 1, 4, 5, 6, 300, 49, 50)] + [b"", b" \n", b"a\n"]
    found = [x for some in op3_passage_dedup.sequences(raws) for x in some]
    words = [word_hashes(raw, lower=True) for raw in raws]
    assert [n for n, _ in found] == [len(x) for x in words]
    assert all(s.tolist() == op3_passage_dedup.grams(w, 5).tolist() for (_, s), w in zip(found, words))
    values = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    plain = np.zeros(200 - 46 + 1, np.uint64)
    for i in range(46):
        plain = plain * np.uint64(0x9E3779B97F4A7C15) + values[i : i + len(plain)]
    assert op3_passage_dedup.grams(values, 46).tolist() == op3_passage_dedup.mix(plain ^ np.uint64(46)).tolist()


def test_passages_of_many_pairs_are_those_of_each():
    """Pairs with several passages, edits, repeats and shingles of other pairs, compared abreast and one by one."""
    rng = np.random.default_rng(9)
    ones, twos = [], []
    for k in range(60):
        top = 1 << 62 if k % 3 else 90  # few different shingles: repeats in both
        parts = [rng.integers(0, top, int(rng.integers(20, 140))) for _ in range(6)]
        ones.append(np.concatenate(parts[:5]))
        two = np.concatenate([parts[i] for i in rng.permutation([0, 2, 4, 5, 5])])
        two[rng.integers(0, len(two), int(rng.integers(0, 12)))] += 1
        twos.append(two)
    ones.append(twos[0])  # the shingles of another pair
    twos.append(rng.integers(0, 1 << 62, 100))
    found = op3_passage_dedup.Pairs(ones, twos).passages()
    alone = [(i, *row[1:]) for i, (u, v) in enumerate(zip(ones, twos)) for row in op3_passage_dedup.Pairs([u], [v]).passages().tolist()]
    assert sorted(map(tuple, found.tolist())) == sorted(alone) and len({r[0] for r in alone}) > 40
    for pair, begin, end, first, last in found.tolist():
        u, v = ones[pair], twos[pair]
        one, two = set(u[begin : end + 1].tolist()), set(v[first : last + 1].tolist())
        assert end - begin + 1 >= 46 and 100 * len(one & two) >= 80 * len(one | two)
        assert 9 * np.isin(u[begin : end + 1], v).sum() >= 8 * (end - begin + 1)
    # whichever shared run is long enough by itself is in a passage of its pair, unless v has it in several places
    for pair in (k for k in range(60) if k % 3):
        shared = np.isin(ones[pair], twos[pair])
        covered = np.zeros(len(shared), bool)
        for _, begin, end, _, _ in (r for r in found.tolist() if r[0] == pair):
            covered[begin : end + 1] = True
        assert not any(shared[i : i + 46].all() and not covered[i : i + 46].any() for i in range(len(shared) - 45))


@pytest.mark.parametrize("batch", [1, 3, 100])
def test_candidates_whatever_the_batches(monkeypatch, batch):
    monkeypatch.setattr(op3_passage_dedup, "TAKEN", batch)
    windows = [(0, 10, 30, 60), (1, 20, 40, 70), (2, 510, 530, 560)]
    place = [int(op3_passage_dedup.packed(f, np.array([[left, c, right]]), np.zeros(1, np.uint64))[0]) for f, left, c, right in windows]
    rows = [(1, 2, p, q) for p, q in zip(place, place)] + [(1, 3, place[0], place[0])] + [(2, 3, p, q) for p, q in zip(place[:2], place[:2])]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + batch])], ["u", "v", "up", "vp"])
               for i in range(0, len(rows), batch)]
    found = sorted(tuple(r.values()) for b in op3_passage_dedup._candidates(batches) for r in b.to_pylist())
    assert found == [(1, 2, 10, 70, 10, 70), (2, 3, 10, 70, 10, 70)]


def test_rows_of_many_nodes_come_in_one_batch():
    """A batch a node cost more than its rows."""
    text, window = " ".join(f"n{i}" for i in range(80)), np.array([[0, 20, 60]])
    place = op3_passage_dedup.packed(0, window, np.zeros(1, np.uint64)).tolist()
    nodes = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([text] * 200), pa.array([place] * 200)], ["node", "text", "wanted"])
    out = list(op3_passage_dedup._around([nodes]))
    assert len(out) == 1 and out[0].num_rows == 200 * 61
