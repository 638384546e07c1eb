"""Licence scan by canonical digests of entire texts.

A text is brought to canonical form: lower case, lines with a copyright notice removed, equivalent
spellings unified, punctuation and white space reduced to single spaces. The SHA-256 of the form is
hash-joined to the digests of known licences, whose canonical form comes from the same expression.
Both a document and each of its lines count as an entire text, since notices stand on lines of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foghorn.functions.text import let
from foghorn.llm.common import text_of
from foghorn.llm.licence_texts import known_texts

#: The known texts are broadcast, so the table of them is refused beyond this many rows.
KNOWN_LIMIT = 20_000

# Spellings that licence matching treats as equal (second form is kept).
EQUIVALENT = [
    ("acknowledgment", "acknowledgement"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgment", "judgement"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("offence", "offense"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("sub-license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# Texts and notices of licences, by SPDX identifier.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS '
        'IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        'in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]
# the same under another title, or the ISC text without one, then texts, headers, notices and tags of others
KNOWN += [(n, f"{t}\n" + x.split("\n", 1)[1]) for n, x in KNOWN if n == "MIT" and "\n" in x for t in ("The MIT License", "The MIT License (MIT)")]
KNOWN += [(n, x.split("\n", 1)[1]) for n, x in KNOWN if n == "ISC" and "\n" in x]
KNOWN += known_texts()

# Characters that count as white space when a text is made canonical.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\x0b\x0c\r©“”‘’–—•"


NOTICE = r"(?m)^[ \t*#/;-]*(?:copyright|\(c\)|©)[^\n]*\b(?:19|20)\d\d[^\n]*$"


def unified(text: Column) -> Column:
    """The text in canonical spelling, line ends kept and white space not yet reduced.

    A line with a copyright notice starts, apart from marks, with the word, or with the sign, and
    names a year. Spellings with a mark inside are unified before marks become spaces.
    """
    out = F.lower(text)
    out = F.when(
        out.contains("copyright") | out.contains("(c)") | out.contains("©"), F.regexp_replace(out, NOTICE, "")
    ).otherwise(out)
    for spelling, kept in EQUIVALENT:
        if not spelling.isalpha():
            out = F.replace(out, F.lit(spelling), F.lit(kept))
    out = F.translate(out, MARKS, " " * len(MARKS))
    for spelling, kept in EQUIVALENT:
        if spelling.isalpha():
            out = F.replace(out, F.lit(spelling), F.lit(kept))
    return out


def reduced(spelt: Column) -> Column:
    """White space reduced to single spaces, one at each end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(spelt, "[ \n]+", " ")), F.lit(" "))


def canonical(text: Column) -> Column:
    return reduced(unified(text))


def digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``digest``, ``license`` and the length of the form, for each known text."""
    if len(known) > KNOWN_LIMIT:
        raise ValueError(f"{len(known)} known texts; at most {KNOWN_LIMIT} are broadcast")
    rows = spark.createDataFrame(known, "license string, text string")
    rows = rows.select("license", canonical(F.col("text")).alias("form"))
    rows = rows.select(digest(F.col("form")).alias("digest"), "license", F.length("form").alias("n"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"), F.max("n").alias("n"))


def scan_licences(
    docs: DataFrame,
    known: list[tuple[str, str]] = KNOWN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, license, line_licenses.

    ``license`` is the known licence that the whole text is, or null; ``line_licenses`` are those that
    single lines are, sorted and joined by commas, empty if none. Null counts as the empty text, which
    is no licence. Repeated rows are scanned each on
    their own. An empty table gives no rows; other
    columns are dropped.
    """
    table = known_digests(docs.sparkSession, known)
    longest = table.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    table = F.broadcast(table.drop("n"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(text_col).alias("text")
    )

    def digests(spelt: Column) -> Column:
        forms = F.transform(F.split(spelt, "\n"), reduced)
        forms = F.filter(forms, lambda f: F.length(f) <= longest)  # longer than any known one
        return F.struct(
            digest(reduced(spelt)).alias("whole"),
            F.array_distinct(F.transform(forms, digest)).alias("lines"),
        )

    rows = rows.select("doc_id", "row", let(unified(F.col("text")), digests).alias("found"))
    lines = rows.select("doc_id", "row", "found.whole", F.explode_outer("found.lines").alias("digest"))
    # the lines of a row follow each other, so they meet again before the shuffle
    per_row = lines.join(table, "digest", "left").groupBy("row", "doc_id", "whole")
    per_row = per_row.agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"))
    out = per_row.join(table, per_row["whole"] == table["digest"], "left")
    return out.select("doc_id", F.col("whole").alias("canonical_sha256"), "license", "line_licenses")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def unified_sql(text: str) -> str:
    """``unified`` as a DuckDB expression."""
    out = f"regexp_replace(lower({text}), {_quoted(NOTICE)}, '', 'g')"
    for spelling, kept in EQUIVALENT:
        if not spelling.isalpha():
            out = f"replace({out}, {_quoted(spelling)}, {_quoted(kept)})"
    out = f"translate({out}, {_quoted(MARKS)}, {_quoted(' ' * len(MARKS))})"
    for spelling, kept in EQUIVALENT:
        if spelling.isalpha():
            out = f"replace({out}, {_quoted(spelling)}, {_quoted(kept)})"
    return out


def scan_sql(known: list[tuple[str, str]] = KNOWN) -> str:
    """The whole scan of ``documents`` in DuckDB."""
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    form = lambda x: f"sha256(' ' || trim(regexp_replace({x}, '[ \\n]+', ' ', 'g')) || ' ')"
    return f"""
WITH known AS (
  SELECT {form("spelt")} AS digest, min(license) AS license
  FROM (SELECT license, {unified_sql("text")} AS spelt FROM (VALUES {values}) AS k(license, text)) GROUP BY 1
), d AS (SELECT doc_id, {unified_sql("coalesce(text, '')")} AS spelt FROM documents
), lines AS (
  SELECT doc_id, {form("line")} AS digest
  FROM (SELECT doc_id, unnest(string_split(spelt, chr(10))) AS line FROM d)
), found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM lines JOIN known USING (digest) GROUP BY doc_id
), whole AS (SELECT doc_id, {form("spelt")} AS canonical_sha256 FROM d)
SELECT whole.doc_id, canonical_sha256, license, coalesce(line_licenses, '') AS line_licenses
FROM whole LEFT JOIN known ON digest = canonical_sha256 LEFT JOIN found ON found.doc_id = whole.doc_id"""
