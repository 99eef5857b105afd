"""Quality rules by line labelling: a linear-chain conditional random field marks content and boilerplate.

Every line with a word is described by yes-no features: its length, shares of symbols, capitals, digits and bars, how
much of it repeats elsewhere in the text, its end. The field's weights and transitions are fitted on a bounded sample of
``SAMPLE`` labelled documents, whose lines take the document's label. Viterbi decoding labels the lines of a whole text; the
share of words in content lines decides whether it stays, besides two base rules.

Defined cases: null and empty texts have no words and fail the base rules; without labels of both kinds every line is
content; lines without words are no part of the sequence; repeated rows come out once each.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded, first_rows, grams, stored, texts, word_hashes

#: Labelled documents that the field is fitted on at most, and lines of each.
SAMPLE, SAMPLE_LINES = 2000, 120
#: Base rules: fewest words, and the largest share of words in repeated runs of three, in per cent.
FEWEST, REPEATED = 50, 50
#: Least share of words in content lines.
CONTENT = 0.5
SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\x0b\x0c\r"
FEATURES = 20


def measures(raw: bytes) -> tuple[int, int, int, int, int, np.ndarray, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words and features (lines x FEATURES) of the lines
    that have words."""
    words = word_hashes(raw, lower=False)
    n = len(words)
    repeated = np.zeros(n, bool)
    if n >= 3:
        runs = grams(words, 3)
        order = np.sort(runs)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if len(twice):
            at = np.isin(runs, twice)
            for i in range(3):
                repeated[i : i + len(at)] |= at
    code_points = len(raw) - int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))
    chars = code_points - sum(raw.count(c) for c in _WHITE)
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)

    lines = [line for line in raw.split(b"\n") if line.strip(_WHITE)]
    counts = np.array([len(line.split()) for line in lines], int)
    seen: Counter[bytes] = Counter()
    rows = np.zeros((len(lines), FEATURES), bool)
    sums = np.concatenate([[0], np.cumsum(repeated)])
    start = 0
    for line, k, row in zip(lines, counts, rows):
        size = max(1, len(line))
        letters = max(1, size - line.count(b" "))
        marks = sum(line.count(bytes([c])) for c in SYMBOLS) / letters
        capitals = sum(line.count(bytes([c])) for c in range(65, 91)) / letters
        repeats = (sums[start + k] - sums[start]) / k
        shouts = line.count(b"!") / k
        row[:] = (
            True, k <= 2, 3 <= k <= 8, 9 <= k <= 40, k > 40, marks > 0.01, marks > 0.05, marks > 0.2, capitals > 0.15,
            capitals > 0.5, shouts > 0.1, shouts > 0.5, repeats > 0.1, repeats > 0.4, repeats > 0.8,
            seen[line] > 0, line.count(b"|") / k > 0.2, sum(map(line.count, b"0123456789")) / letters > 0.1,
            line.rstrip(_WHITE)[-1:] in b".?!;:", letters / k > 9)
        seen[line] += 1
        start += k
    return n, chars, symbols, sum(c - 1 for c in seen.values()), int(repeated.sum()), counts, rows


class Field:
    """Weights (features x 2) and transitions (2 x 2); label 1 is content."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def viterbi(self, rows: np.ndarray) -> np.ndarray:
        scores = (rows @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0]
        back = []
        for s, t in scores[1:]:
            from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = s + (a + m00 if from_a else b + m10), t + (a + m01 if from_b else b + m11)
        label = 0 if a > b else 1
        path = [label]
        for step in reversed(back):
            label = step[label]
            path.append(label)
        return np.array(path[::-1])


def fit(sequences: list[np.ndarray], labels: list[int], rounds: int = 120, rate: float = 0.3) -> Field:
    """Maximum likelihood by gradient steps (Adam); forward and backward sums run over all sequences at once.

    Transitions are held back more than weights: whole documents of one label would make them all but certain.
    """
    ridge = np.array([1e-3] * (2 * FEATURES) + [0.02] * 4)
    most = max(map(len, sequences))
    x = np.zeros((len(sequences), most, FEATURES), np.float32)
    there = np.zeros((len(sequences), most), bool)
    for i, rows in enumerate(sequences):
        x[i, : len(rows)], there[i, : len(rows)] = rows, True
    y = np.array(labels)
    total = there.sum()
    seen_weights = np.stack([x[y == c].sum(axis=(0, 1)) for c in (0, 1)], axis=1)
    pairs = there[:, 1:].sum(axis=1)
    seen_moves = np.diag([pairs[y == 0].sum(), pairs[y == 1].sum()]).astype(float)
    w = np.zeros(FEATURES * 2 + 4)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        weights, moves = w[:-4].reshape(FEATURES, 2), w[-4:].reshape(2, 2)
        score = x @ weights
        forward, backward = np.zeros((most, len(y), 2)), np.zeros((most, len(y), 2))
        forward[0] = score[:, 0]
        for t in range(1, most):
            step = np.logaddexp.reduce(forward[t - 1][:, :, None] + moves, axis=1) + score[:, t]
            forward[t] = np.where(there[:, t, None], step, forward[t - 1])
        for t in range(most - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (score[:, t + 1] + backward[t + 1])[:, None, :], axis=2)
            backward[t] = np.where(there[:, t + 1, None], step, 0)
        norm = np.logaddexp.reduce(forward[-1], axis=1)
        share = np.exp(forward.transpose(1, 0, 2) + backward.transpose(1, 0, 2) - norm[:, None, None])
        share *= there[:, :, None]
        expected = np.einsum("stf,stc->fc", x, share)
        both = np.exp(forward[:-1, :, :, None] + moves + (score[:, 1:].transpose(1, 0, 2) + backward[1:])[:, :, None, :]
                      - norm[None, :, None, None]) * there[:, 1:].T[:, :, None, None]
        gradient = np.concatenate([(seen_weights - expected).ravel(), (seen_moves - both.sum(axis=(0, 1))).ravel()])
        gradient = gradient / total - ridge * w
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        w = w + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return Field(w[:-4].reshape(FEATURES, 2), w[-4:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field of documents (doc_id, text) with ``labels`` (doc_id, quality: 1 content, 0 boilerplate)."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    # an id with two labels counts as the better
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = bounded(stored(first_rows(known, "doc_id", sample), "labelled"))

    def lines(batches):
        for batch in batches:
            rows = [measures(raw)[-1][:SAMPLE_LINES] for raw in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(
                [x.astype(np.uint8).tobytes() for x in rows], pa.binary())], ["doc_id", "quality", "lines"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.join(chosen, "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
            .mapInArrow(lines, f"doc_id {id_type}, quality int, lines binary").where(F.length("lines") > 0)
            .orderBy("doc_id", "lines").limit(2 * sample).collect())
    if len({r.quality for r in rows}) < 2:
        return None
    return fit([np.frombuffer(r.lines, np.uint8).reshape(-1, FEATURES) for r in rows], [r.quality for r in rows])


def judge(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_share, base_failed,
    kept."""
    def run(batches):
        for batch in batches:
            out = []
            for raw in texts(batch):
                n, chars, symbols, duplicates, repeated, counts, rows = measures(raw)
                content = counts.sum() if field is None or not n else counts[field.viterbi(rows) == 1].sum()
                share = float(content / n) if n else 0.0
                failed = n < FEWEST or 100 * repeated > REPEATED * n
                out.append((n, chars, symbols, duplicates, repeated, share, failed, not failed and share >= CONTENT))
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_share",
                 "base_failed", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "content_share double, base_failed boolean, kept boolean")


def line_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, train(docs, labels))
