import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [p for p in (ROOT, os.path.join(ROOT, "tests")) if p not in sys.path]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for Spark's Python workers

TEXT = "doc_id long, text string"

#: Null and empty texts, one character, one very long word, a long text, repeated rows, a row without an id.
ODD = [
    (1, None), (2, ""), (3, "x"), (4, "y" * 300_000), (5, " ".join(f"w{i % 977}" for i in range(60_000))),
    (6, "same text again " * 40), (6, "same text again " * 40), (7, "same text again " * 40), (None, "no id here at all"),
    (8, " \t\n\x0b\x0c\r"), (9, "Äpfel\u00a0und \u2003Öl\x00 \x1c d'été «ß»"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names clash with those of results."""
    return spark.createDataFrame(
        [(*r, "en", "s", 1, 7, "z", True) for r in ODD],
        TEXT + ", lang string, source string, n_words long, same long, n string, kept boolean")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], TEXT + ", lang string, source string")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain(documents):
    """The documents of the smallest scale as a dictionary."""
    return {r.doc_id: r.text for r in documents.collect()}
