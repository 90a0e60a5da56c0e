"""Licence scans: canonical digests of whole texts, joined to the digests of known licences.

A text is canonical once it is in lower case, without copyright lines, with one spelling for equivalent words
and with single spaces for all punctuation. Its digest covers the whole canonical text. Three kinds of text are looked up:
the document, and each of its lines as a notice of its own. What a line says besides a notice makes it another text.

Null and empty texts have the digest of the empty text and match nothing. Repeated rows each get their result.
Without known licences nothing matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import checked, stage

#: Equivalent spellings in licence texts, left to right, after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"),
    ("organisation", "organization"), ("favour", "favor"), ("labour", "labor"), ("fulfilment", "fulfillment"),
    ("non-commercial", "noncommercial"), ("sub-license", "sublicense"),
    ("sub license", "sublicense"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("https://", "http://"), ("&", " and "),
)
#: Patterns that Java and RE2 read alike.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright( \(c\)| ©)?|\(c\)|©)[^\p{L}\n]*([0-9]{4}|\[|<|by )[^\n]*$|(?m)^[^\p{L}\n]*all rights reserved[^\p{L}\n]*$"
BETWEEN_WORDS = r"[^\p{L}\p{N}\n]+"
BLANK_LINES = r" *\n[ \n]*"

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_ITEMS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def catalogue() -> list[tuple[str, str]]:
    """(license_id, text) of well-known short licences and of the notices that name a licence."""
    bsd = lambda n: "\n".join([BSD_HEAD, *[f"{i}. {x}" for i, x in enumerate(BSD_ITEMS[:n], 1)], BSD_TAIL])
    known = [
        ("MIT", MIT), ("MIT", f"MIT License\n{MIT}"), ("MIT", f"The MIT License (MIT)\n{MIT}"), ("ISC", ISC),
        ("ISC", f"ISC License\n{ISC}"), ("BSD-2-Clause", bsd(2)), ("BSD-3-Clause", bsd(3)),
    ]
    names = {
        "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0"), "MIT": ("the MIT License",),
        "GPL-2.0": ("the GNU General Public License, version 2",), "GPL-3.0": ("the GNU General Public License, version 3",),
        "LGPL-3.0": ("the GNU Lesser General Public License, version 3",), "MPL-2.0": ("the Mozilla Public License, version 2.0",),
        "CC0-1.0": ("CC0 1.0",), "CC-BY-4.0": ("CC BY 4.0",), "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
        "CC-BY-NC-4.0": ("CC BY-NC 4.0",), "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",), "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
        "BSD-2-Clause": ("the BSD 2-Clause License",), "BSD-3-Clause": ("the BSD 3-Clause License",), "ISC": ("the ISC License",),
    }
    openings = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This software is licensed under")
    for license_id, titles in names.items():
        known.append((license_id, f"SPDX-License-Identifier: {license_id}"))
        known += [(license_id, f"{opening} {title}.") for opening in openings for title in titles]
    return known


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(F.regexp_replace(out, BETWEEN_WORDS, " "), BLANK_LINES, "\n"), F.lit(" \n"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(digest, license_id): one row per digest, the smallest name if two licences share a text."""
    texts = spark.createDataFrame(known, "license_id string, text string")
    flat = texts.select("license_id", F.md5(F.replace(canonical(F.col("text")), F.lit("\n"), F.lit(" "))).alias("digest"))
    return flat.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row: doc_id, the digest of the canonical text, its licence, its lines, and the licences that single lines name."""
    spark = docs.sparkSession
    lines = F.split(canonical(F.col("text")), "\n")
    digests = stage(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lines.alias("lines")).select(
            "doc_id", F.md5(F.array_join("lines", " ")).alias("digest"), F.size("lines").cast("bigint").alias("n_lines"),
            F.transform("lines", lambda x: F.md5(F.trim(x))).alias("line_digests"),
        ),
        "license-digests",
    )
    table = known_digests(spark, catalogue() if known is None else known)
    listed = checked(table, 100)
    per_line = digests.select("doc_id", "digest", F.explode("line_digests").alias("line"))
    found = per_line.join(listed.withColumnRenamed("digest", "line"), "line").groupBy("doc_id", "digest").agg(
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices")
    )
    whole = digests.drop("line_digests").join(listed, "digest", "left").alias("w")
    same = F.col("w.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("w.digest") == F.col("f.digest"))
    return whole.join(found.alias("f"), same, "left").select(
        F.col("w.doc_id"), F.col("w.digest"), F.col("w.license_id"), F.col("w.n_lines"), F.coalesce("f.notices", F.lit("")).alias("notices")
    )


def canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim(regexp_replace(regexp_replace({out}, '{BETWEEN_WORDS}', ' ', 'g'), '{BLANK_LINES}', chr(10), 'g'), ' ' || chr(10))"


def scan_sql(known: list[tuple[str, str]] | None = None) -> str:
    """The same rows in DuckDB's SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in (catalogue() if known is None else known))
    return f"""
WITH listed AS (
  SELECT md5(replace({canonical_sql('text')}, chr(10), ' ')) AS digest, min(license_id) AS license_id
  FROM (VALUES {rows}) AS v(license_id, text) GROUP BY 1),
cut AS (SELECT doc_id, string_split({canonical_sql('text')}, chr(10)) AS lines FROM documents),
told AS (SELECT doc_id, lines, md5(array_to_string(lines, ' ')) AS digest, CAST(len(lines) AS BIGINT) AS n_lines FROM cut),
found AS (
  SELECT doc_id, digest, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT doc_id, told.digest, listed.license_id
        FROM (SELECT doc_id, digest, md5(trim(unnest(lines))) AS line FROM told) told
        JOIN listed ON listed.digest = told.line) GROUP BY ALL)
SELECT t.doc_id, t.digest, l.license_id, t.n_lines, coalesce(f.notices, '') AS notices
FROM told t LEFT JOIN listed l ON l.digest = t.digest
LEFT JOIN found f ON f.doc_id IS NOT DISTINCT FROM t.doc_id AND f.digest = t.digest
"""
