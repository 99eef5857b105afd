"""Licence scan by canonical digests.

A text's canonical form has A-Z lower-cased, copyright lines dropped, equivalent spellings made one, and every run of
punctuation and white space turned into a blank. Its SHA-256 is looked up among the digests of known licence texts: the
entire document, and each of its lines as an entire text of its own (one-line notices).

The known table is ``KNOWN`` and the digests of ``license_digests.csv`` (license, whether it restricts use, SHA-256 of the
canonical form, source), a few hundred rows, far below any broadcast limit. Defined cases: null text is empty, and an empty
canonical form matches nothing; repeated lines count each time; repeated rows come out once each.
"""

from __future__ import annotations

import csv
import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.op1_decontaminate import LOWER, UPPER, let

# fixed values: spellings that count as one, after lower-casing, in this order
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"),
             ("non-commercial", "noncommercial"), ("version", "v"), ("gnu general public license", "gnu gpl"),
             ("creative commons attribution noncommercial", "cc by nc"), ("merchantability", "merchantibility"))
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|copr[.])[^\n]*"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: known texts (public notices and short licences) and the terms that restrict use
KNOWN = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)
RESTRICTED = ("GPL-3.0", "CC-BY-NC-4.0")


def catalogue() -> list[dict[str, str]]:
    """Rows of the data file: license, restricted (0 or 1), sha256, source."""
    return list(csv.DictReader(pkgutil.get_data(__package__, "license_digests.csv").decode().splitlines()))


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), COPYRIGHT_LINE, "$1")
    for variant, one in SPELLINGS:
        out = F.replace(out, F.lit(variant), F.lit(one))
    return F.btrim(F.regexp_replace(out, MARKS, " "))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null if that is empty."""
    return let(canonical(text), lambda form: F.when(form != "", F.sha2(form, 256)))


def known_digests(spark: SparkSession, known=KNOWN, listed=()) -> DataFrame:
    rows = spark.createDataFrame(list(known), "license string, text string")
    rows = rows.select("license", digest(F.col("text")).alias("digest")).unionByName(
        spark.createDataFrame([(r["license"], r["sha256"]) for r in listed], "license string, digest string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known=KNOWN, restricted=RESTRICTED, listed=None) -> DataFrame:
    """Per document: doc_id, digest (of the entire text; null if empty), license (of the entire text), n_license_lines,
    line_licenses (of entire lines, distinct, sorted, comma-joined), restricted (either is among ``restricted`` or is
    marked so in ``listed``, by default the data file)."""
    listed = catalogue() if listed is None else listed
    restricted = sorted({*restricted, *(r["license"] for r in listed if r["restricted"] == "1")})
    table = known_digests(docs.sparkSession, known, listed)
    docs = docs.select("doc_id", F.xxhash64("text").alias("same"), "text")
    lines = docs.select("doc_id", "same", F.explode(F.split("text", "\n")).alias("line"))
    # equal lines of a document meet before they are shuffled; most lines match nothing
    found = lines.select("doc_id", "same", digest(F.col("line")).alias("digest")).join(F.broadcast(table), "digest")
    found = found.groupBy("doc_id", "same").agg(
        F.count("*").alias("lines"), F.sort_array(F.collect_set("license")).alias("names"))
    found = found.withColumnRenamed("doc_id", "id").withColumnRenamed("same", "text_hash")
    whole = (docs.select("doc_id", "same", digest(F.col("text")).alias("digest"))
             .join(F.broadcast(table), "digest", "left"))
    rows = whole.join(
        found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("text_hash")), "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    is_restricted = F.exists(names, lambda x: x.isin(*restricted)) | F.coalesce(
        F.col("license").isin(*restricted), F.lit(False))
    return rows.select(
        "doc_id", "digest", "license", F.coalesce("lines", F.lit(0)).cast("long").alias("n_license_lines"),
        F.array_join(names, ",").alias("line_licenses"), is_restricted.alias("restricted"))
