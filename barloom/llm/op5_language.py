"""Language identification with error-correcting output codes.

Every learned language gets a codeword. One binary classifier per bit, a logistic regression on hashed byte n-grams,
predicts that bit. Decoding adds up, for each codeword, the logistic losses of the bits, weighted by how reliable each
bit was in training, and takes the codeword of the smallest loss; a small lead over the second marks the text ambiguous.

Training reads a bounded sample: ``SAMPLE`` labelled ids, the first by a hash, and of their rows (ids may repeat) at most as
many, again the first by a hash. Their feature vectors, not their texts, come to the driver. The sample is not drawn by
language: one that does not occur in it is never learned. Prediction reads whole texts, long ones slice by slice.

Defined cases: null text or text without a letter is ``und`` with score 0; with one learned language every bit agrees
and the score is 1; without any labelled row everything is ``und``; repeated rows come out once each.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded, first_rows, small_batches, stored

#: Rows that the classifiers are fitted on at most.
SAMPLE = 4000
#: The sample comes to the driver in so many portions.
PORTIONS = 8
#: Hash buckets of the n-grams, and their lengths in bytes.
BUCKETS, LENGTHS = 4096, (1, 2, 3, 4)
#: Texts are counted in slices of so many bytes.
SLICE = 1 << 20
#: Code length for many languages; few languages get every useful bit.
BITS = 31
#: Leads in score below this mark a text as ambiguous.
LEAD = 0.2
UNKNOWN = "und"


def codewords(classes: int) -> np.ndarray:
    """One row of +1 and -1 per class; every two rows differ in about half of the bits."""
    if classes <= 6:  # exhaustive code: each split of the classes once
        columns = [c for c in itertools.product((1, -1), repeat=classes) if c[0] == 1 and -1 in c]
        return np.array(columns or [(1,) * classes], float).T.reshape(classes, -1)
    rng, best, apart = np.random.default_rng(5), None, -1
    for _ in range(200):
        code = rng.choice((1.0, -1.0), (classes, BITS))
        least = int(((BITS - code @ code.T) / 2 + BITS * np.eye(classes)).min())
        if least > apart and (np.abs(code.sum(axis=0)) < classes).all():
            best, apart = code, least
    return best


def features(text: str) -> np.ndarray:
    """Square roots of n-gram shares in hash buckets, of unit length."""
    raw = text.lower().encode()
    counts = np.zeros(BUCKETS)
    for at in range(0, len(raw), SLICE):
        codes = np.frombuffer(raw[at : at + SLICE + max(LENGTHS) - 1], np.uint8).astype(np.uint32)
        for n in LENGTHS:
            ends = min(SLICE, len(codes) - n + 1)
            if ends > 0:
                key = np.full(ends, n * 40503, np.uint32)
                for j in range(n):
                    key = (key ^ codes[j : j + ends]) * np.uint32(0x01000193)
                key ^= key >> np.uint32(15)
                counts += np.bincount(key & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    counts = np.sqrt(counts)
    return counts / max(np.linalg.norm(counts), 1e-9)


def fit_bits(x: np.ndarray, signs: np.ndarray, rounds: int = 300, rate: float = 20.0, ridge: float = 1e-5):
    """Logistic regressions of all bits at once by accelerated gradient steps; weights (features + 1, bits)."""
    w = step = np.zeros((x.shape[1] + 1, signs.shape[1]), np.float32)
    for k in range(rounds):
        margin = np.clip(signs * (x @ step[:-1] + step[-1]), -30, 30)
        pull = (signs / (1 + np.exp(margin))).astype(np.float32)
        gradient = ridge * step - np.vstack([x.T @ pull, pull.sum(axis=0)]) / np.float32(len(x))
        new = step - np.float32(rate / 4) * gradient
        step = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w


class Model:
    """Languages, their codewords, the bits' classifiers and the bits' weights in decoding."""

    def __init__(self, languages: list[str], x: np.ndarray, labels: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 1))
        if languages:
            signs = self.code[labels]
            self.w = fit_bits(x, signs)
            right = (signs * self.margins(x) > 0).mean(axis=0)
            self.trust = np.clip(2 * right - 1, 0.05, 1)
            self.trust /= self.trust.sum()

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w[:-1] + self.w[-1]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best class, its share among exp(-loss), and the lead of that share."""
        margins = self.margins(x)
        loss = np.stack([(np.logaddexp(0, -margins * c) * self.trust).sum(axis=1) for c in self.code], axis=1)
        share = np.exp((loss.min(axis=1, keepdims=True) - loss) * 4)
        share /= share.sum(axis=1, keepdims=True)
        order = np.sort(share, axis=1)
        return loss.argmin(axis=1), order[:, -1], order[:, -1] - (order[:, -2] if order.shape[1] > 1 else 0)


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(3)) == 1


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the ``lang`` values of documents (doc_id, text, lang) that are not held out."""
    known = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
             .where(~F.coalesce(held_out(F.col("doc_id")), F.lit(True))))
    ids = bounded(stored(first_rows(known.select("doc_id").distinct(), "doc_id", sample), "sample"))
    chosen = known.join(ids, "doc_id")

    def vectors(batches):
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                if any(map(str.isalpha, text)):
                    x = features(text)
                    at = np.flatnonzero(x)
                    yield pd.DataFrame({"lang": [lang], "at": [at.astype(np.int16).tobytes()],
                                        "x": [x[at].astype(np.float32).tobytes()]})

    rows = small_batches(chosen).select("lang", "text").mapInPandas(vectors, "lang string, at binary, x binary")
    rows = stored(rows.orderBy(F.xxhash64("lang", "at", "x"), "lang", "at", "x").limit(sample), "vectors")
    x, names = np.zeros((rows.count(), BUCKETS), np.float32), []
    for part in range(PORTIONS):  # the driver holds a portion beside the matrix, not all rows twice
        portion = rows.where(F.pmod(F.xxhash64("at", "x"), F.lit(PORTIONS)) == part).toArrow()
        for row, at, values in zip(x[len(names) :], portion["at"], portion["x"]):
            row[np.frombuffer(at.as_buffer(), np.int16)] = np.frombuffer(values.as_buffer(), np.float32)
        names += portion["lang"].to_pylist()
        del portion
    pa.default_memory_pool().release_unused()
    languages = sorted(set(names))
    return Model(languages, x, np.array([languages.index(n) for n in names], int))


def _judged(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether it is ambiguous, of each text."""
    known = [i for i, t in enumerate(texts) if t is not None and model.languages and any(map(str.isalpha, t))]
    lang, score, ambiguous = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    for at in range(0, len(known), 256):
        part = known[at : at + 256]
        best, share, lead = model.decode(np.stack([features(texts[i]) for i in part]))
        for i, b in zip(part, best):
            lang[i] = model.languages[b]
        score[part], ambiguous[part] = np.clip(share, 0, 1), lead < LEAD
    return lang, score, ambiguous


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is not ``und``, with all columns."""
    def run(batches):
        for batch in batches:
            lang, _, _ = _judged(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != UNKNOWN for x in lang], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (0 to 1), ambiguous."""
    def run(batches):
        for batch in batches:
            lang, score, ambiguous = _judged(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(ambiguous)], ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = small_batches(docs).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, train(docs, sample))
