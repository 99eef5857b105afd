"""Vector codes, prefix trie and archives against brute force, on odd rows and across borders of tasks."""

import base64
import collections
import gzip
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest

from barloom.llm import op11_vector_codes as codes
from barloom.llm import op12_prefix_trie as tries
from barloom.llm import op13_warc as warc

CLASH = ", code string, n long, key string, size long, depth long, shard int, `first` string"
EXTRA = ("x", 1, "k", 2, 3, 4, "f")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- vector codes ----------------------------------------------------------------------------

def lloyd(rows, rounds=6):
    """{position: (code, error)} and the codebooks of rows (vec_id, vector), plainly."""
    ints = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:16]
    m = len(ints[0]) // 8
    books = [[ints[i][p * m : p * m + m] for i in order] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for turn in range(rounds + 1):
        found = [[near(v[p * m : p * m + m], books[p]) for p in range(8)] for v in ints]
        if turn == rounds:
            break
        for p in range(8):
            for k in range(len(books[p])):
                mine = [v[p * m : p * m + m] for v, f in zip(ints, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [("".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for f in found], hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], "vec_id long, embedding array<float>, label int" + CLASH)
    return codes.vector_code_report(df.repartition(3))


@pytest.mark.parametrize("kind", ["clusters", "ties", "few", "large"])
def test_codes_equal_plain_rounds(spark, kind):
    rng = np.random.default_rng(7)
    n, m = (9, 16) if kind == "few" else (400, 24)
    centres = rng.normal(size=(30, m))
    x = centres[rng.integers(0, 30, n)] + 0.2 * rng.normal(size=(n, m))
    if kind == "ties":
        x = rng.integers(-2, 3, (n, m)) / 4096  # many equal distances and equal rows
    if kind == "large":
        x = x * 9000  # squares beyond what a double holds
    rows = [(int(i), [float(np.float32(a)) for a in v], int(i) % 3 or None) for i, v in enumerate(x)]
    want, digest = lloyd([(i, v) for i, v, _ in rows])
    out = {r.vec_id: r for r in coded(spark, rows).collect()}
    by_label = collections.Counter()
    for (_, _, label), (_, error) in zip(rows, want):
        by_label[label] += error
    assert len(out) == n
    for (i, _, label), (code, error) in zip(rows, want):
        assert (out[i].code, out[i].error, out[i].label_error) == (code, error, by_label[label])
        assert out[i].codebooks_sha256 == digest


def test_bounds_settle_most_parts_unseen_and_b_shrinks(spark):
    rng = np.random.default_rng(2)
    apart = np.repeat(np.arange(25), 40)[rng.permutation(1000)]
    vectors = [(i, [float(a) for a in rng.normal(scale=0.02, size=16) + c // 5 * 0.5 + c % 5 * 0.05], 0) for i, c in enumerate(apart.tolist())]
    _, t = codes.vector_codes(spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int"))
    assert all(codes.ENTRIES // 8 <= b <= codes.ENTRIES // 4 for b in t.kept) and min(t.kept) < codes.ENTRIES // 4
    x, entries = rng.integers(-999, 999, (500, 8)), rng.integers(-999, 999, (16, 8))
    ids, bounds = codes.nearest(codes.squared(x, entries), 4)
    for _ in range(5):
        new = entries + rng.integers(-5, 6, entries.shape)
        moves = codes.above(np.sqrt(((new - entries) ** 2).sum(1).astype(float)))
        ids, bounds, seen = codes.reassign(x, new, ids, bounds, moves, 4)
        entries, d = new, codes.squared(x, new)
        assert (ids[:, 0] == d.argmin(axis=1)).all() and seen.sum() == len(x) and seen[0] > 250
        root = np.sqrt(np.take_along_axis(d, ids.astype(int), 1))
        assert (bounds[:, 0] >= root[:, 0]).all() and (np.diff(bounds[:, 1:], axis=1) >= 0).all()
        others = d.astype(float)
        np.put_along_axis(others, ids.astype(int), np.inf, axis=1)
        assert (bounds[:, 4] <= np.sqrt(others.min(axis=1))).all()


def test_codes_of_odd_vectors(spark):
    ones = [1.0] * 16
    rows = [(1, None, 1), (2, [1.0] * 15 + [None], 1), (3, [float("nan")] + ones[1:], 2), (4, [float("inf")] + ones[1:], 2),
            (5, ones, None), (5, ones, None), (None, ones, 3), (6, [], 4), (7, ones[:8], 4), (8, [-0.00001] * 16, 4)]
    out = rows_of(coded(spark, rows).select("vec_id", "code", "error", "label_error"))
    assert len(out) == 6 and {r[0] for r in out} == {5, None, 6, 7, 8}
    assert [r for r in out if r[0] in (6, 7)] == [(6, None, None, 0), (7, None, None, 0)]
    assert all(r[2:] == (0, 0) for r in out if r[0] not in (6, 7))
    assert coded(spark, rows[:4]).count() == 0 and coded(spark, [(6, [], 4)]).count() == 1
    with pytest.raises(Exception, match="do not cut"):
        coded(spark, [(1, [1.0] * 9, 1)])


# ---- prefix trie ----------------------------------------------------------------------------------

def plain_trie(rows):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    turns = {c: [x for _, x in sorted(t, key=lambda p: p[0])] for c, t in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = collections.Counter(s[:-1] for s in members if s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
    return sorted(((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s],
                    hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()) for s, m in members.items()), key=repr)


def crowded():
    """Conversations with common first turns, copies, prefixes of each other and one that is long."""
    rng, rows = random.Random(3), []
    for c in range(-150, 650):
        kind = c % 7
        if kind == 0:
            texts = ["hello", "copy", "same"]
        elif kind == 1:
            texts = ["hello", "copy", "same", "and more"][: c % 5]
        else:
            texts = [rng.choice(["hello", "hi", "né 日本", ""]) for _ in range(rng.randrange(0, 7))]
        if c == 305:
            texts = ["hello"] * 90
        if c == 311:
            texts = ["hello"] * 88 + ["end"]
        rows += [(c, None if i == 0 and c % 11 == 0 else i, "user" if i % 2 == 0 else None, t or None) for i, t in enumerate(texts)]
    return rows + [(None, 1, "user", "nobody's")]


@pytest.mark.parametrize("shards,cells", [(1, 1 << 18), (1, 40), (7, 60), (40, 1)])
def test_trie_equals_plain_trie_across_borders(spark, shards, cells):
    rows = crowded()
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], "conv_id long, turn long, role string, text string" + CLASH)
    out = tries.prefix_trie(df.repartition(5), shards, cells)
    assert rows_of(out) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    types = "conv_id long, turn long, role string, text string"
    assert tries.prefix_trie(spark.createDataFrame([], types)).count() == 0
    gone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(gone, 1, "user", "only one, and the head is absent")]
    out = rows_of(tries.prefix_trie(spark.createDataFrame(rows, types)))
    assert out == plain_trie(rows) and out[0][1:4] == (0, None, 1) and len(out) == 1
    twice = [(200, 1, "user", "again")] * 2 + [(200, None, "user", "first")]
    assert rows_of(tries.prefix_trie(spark.createDataFrame(twice, types))) == plain_trie(twice)


# ---- archives --------------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def plain_records(rows):
    """Rows of the result, plainly; one of equal rows with the largest id is the response."""
    groups = collections.defaultdict(list)
    for page_id, url, html in rows:
        data = (html or "").encode()
        groups[data].append((page_id, url))
    out = []
    for data, pages in groups.items():
        pages = sorted(pages, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
        for i, (page_id, _) in enumerate(pages):
            first = len(data) < 1000 or i == len(pages) - 1
            out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit",
                        None if first else pages[-1][0]))
    return sorted(out, key=repr)


def many_pages():
    rng = random.Random(5)
    rows = [(i, f"http://h{i % 7}.example/p{i}", "<p>" + "".join(rng.choices("abcdé ", k=rng.randrange(0, 3000)))) for i in range(300)]
    copy, small = "<p>copied " + "x" * 2000, "tiny"
    rows += [(1000 + i, f"http://c.example/{i}", copy) for i in range(120)]
    rows += [(1119, "http://c.example/other", copy), (1119, "http://c.example/other", copy), (1119, None, copy)]
    rows += [(5, "http://c.example/5", copy)] * 40 + [(7, None, small)] * 30 + [(None, None, copy)] * 2
    rows += [(2000, "http://a b\n.example/", None), (2001, None, ""), (2001, None, ""), (2002, "http://long.example/", "é" * 400_000)]
    return rows


def archive_files(root):
    return {n: hashlib.sha256(open(f"{root}/{n}", "rb").read()).hexdigest() for n in os.listdir(root) if n.endswith(".gz")}


def test_archive_round_trip_is_deterministic_and_rolls(spark, tmp_path):
    rows = many_pages()
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], PAGE + CLASH)
    roots = [f"{tmp_path}/a", f"file://{tmp_path}/b"]
    for root, parts in zip(roots, (2, 9)):
        out = warc.archived(df.repartition(parts), root, file_bytes=30_000, shard_bytes=100_000)
        assert rows_of(out) == plain_records(rows)
    a, b = (archive_files(r.removeprefix("file://")) for r in roots)
    assert a == b and len(a) > 8 and any(n.endswith("-0001.warc.gz") for n in a)
    manifest = {r.name: r for r in warc.read_manifest(spark, roots[0]).collect()}
    assert {n: r.sha256 for n, r in manifest.items()} == a and sum(r.records for r in manifest.values()) == len(rows)
    assert not os.path.exists(f"{roots[0]}/_temporary")
    ids = []
    for name, r in manifest.items():
        data = open(f"{roots[0]}/{name}", "rb").read()
        found = [warc.parse(m) for m in warc.members(open(f"{roots[0]}/{name}", "rb"))]
        assert len(data) == r.bytes and found[0][0]["WARC-Type"] == "warcinfo" and len(found) == r.records + 1
        assert len(data) <= 30_000 or r.records == 1
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") == len(found)
        ids += [f["WARC-Record-ID"] for f, _ in found]
        for fields, block in found[1:]:
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    assert len(ids) == len(set(ids))


def test_revisits_name_records_that_exist(spark, tmp_path):
    root = f"{tmp_path}/w"
    warc.write_archive(spark.createDataFrame(many_pages(), PAGE), root)
    found = [warc.parse(m)[0] for n in archive_files(root) for m in warc.members(open(f"{root}/{n}", "rb"))]
    responses = {f["WARC-Record-ID"]: f["WARC-Payload-Digest"] for f in found if f["WARC-Type"] == "response"}
    revisits = [f for f in found if f["WARC-Type"] == "revisit"]
    assert revisits and all(responses[f["WARC-Refers-To"]] == f["WARC-Payload-Digest"] for f in revisits)


def test_archive_of_nothing_and_a_broken_one(spark, tmp_path):
    assert warc.archived(spark.createDataFrame([], PAGE), f"{tmp_path}/e").count() == 0
    root = f"{tmp_path}/x"
    warc.write_archive(spark.createDataFrame([(1, "u", "some page")], PAGE), root)
    name = next(iter(archive_files(root)))
    whole = open(f"{root}/{name}", "rb").read()
    broken = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = gzip.decompress(whole).replace(b"some page", b"same page")
    open(f"{root}/{name}", "wb").write(broken.compress(data) + broken.flush())
    with pytest.raises(Exception, match="not a record|digest"):
        warc.read_archive(spark, root).collect()
    open(f"{root}/{name}", "wb").write(whole[:-5])
    with pytest.raises(Exception, match="ends within"):
        warc.read_archive(spark, root).collect()


def test_moves_may_be_repeated(spark, tmp_path):
    root = f"{tmp_path}/m"
    os.makedirs(f"{root}/_temporary")
    open(f"{root}/_temporary/f.1", "w").write("data")
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["f"]), pa.array(["_temporary/f.1"])], ["name", "temporary"])
    for _ in range(2):
        assert len(list(warc._mover(root)([batch]))) == 1
    assert open(f"{root}/f").read() == "data"
    os.rename(f"{root}/f", f"{root}/g")
    with pytest.raises(FileNotFoundError):
        list(warc._mover(root)([batch]))
