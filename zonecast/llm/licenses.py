"""Licence scan by canonical digests.

A text is brought to a canonical form (lower case, copyright lines out, punctuation and
white space to single blanks, equivalent spellings made one), its SHA-256 is the key of a
hash join with the digests of known licence texts, brought to the same form by the same
expressions. Whole texts are looked up, and every single line too, since notices stand
alone in a line. The known table is broadcast only behind a check of its row count (a
digest and a name are under 200 bytes); a larger one is joined by shuffle.

Defined results: null and empty texts, and texts without a letter or digit, have the digest
of the empty string and match nothing; equal texts get equal results; of several known
texts with one digest the least name is given; repeated rows each get theirs; an empty
table gives no rows; extra columns are ignored, an id that repeats, the null id too, gets the
lines of all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
#: Spellings taken as equal, after lower-casing and punctuation to blanks.
EQUIVALENT = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
              ("sub license", "sublicense"), ("copyright owner", "copyright holder"), ("favour", "favor"),
              ("organisation", "organization"), ("organisations", "organizations"), ("authorisation", "authorization"),
              ("non commercial", "noncommercial"), ("whilst", "while"), ("per cent", "percent"), ("http", "https"), ("gnu gpl", "gnu general public license"),
              ("v3", "version 3"), ("version 3 0", "version 3"), ("v2", "version 2")]
#: A line with the word or sign of copyright and a year, "copyright (c)" with a name, or the usual reservation.
COPYRIGHT_LINE = (r"(^|\n)[^\p{L}\p{N}\n]*((copyright|\(c\)|©)[^\n]*[0-9][0-9][0-9][0-9]|copyright (\(c\)|©) *\p{L}|© *\p{L}"
                  r"|all rights reserved)[^\n]*")
#: Short licence texts and the usual one-line notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC0-1.0 notice": "This work is dedicated to the public domain under CC0 1.0.",
}


def canonical(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    # every word with blanks of its own, so that a spelling is found beside an equal one
    t = F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(spaced(a)), F.lit(spaced(b)))
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def spaced(words: str) -> str:
    return f" {words.replace(' ', '  ')} "


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(known: DataFrame) -> DataFrame:
    """(license, text) -> (digest, license), one row per digest, without the empty text."""
    return (known.select(digest(F.col("text")).alias("digest"), "license").where(F.col("digest") != F.sha2(F.lit(""), 256))
            .groupBy("digest").agg(F.min("license").alias("license")))


def scan(df: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, license, line_licenses): the licence that the whole text is, or null, and
    the sorted names of those that a line of it is."""
    k = known_digests(known)
    if k.count() <= MAX_BROADCAST_ROWS:
        k = F.broadcast(k)
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = docs.select("id", digest(F.col("text")).alias("digest")).join(k, "digest", "left")
    line = docs.select("id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).where("trim(line) != ''")
    found = (line.select("id", digest(F.col("line")).alias("digest")).join(k, "digest")
             .groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("license")), ", ").alias("line_licenses")))
    found = found.withColumnRenamed("id", "line_id")
    return whole.join(found, F.col("id").eqNullSafe(F.col("line_id")), "left").select(F.col("id").alias(id), "digest", "license", "line_licenses")
