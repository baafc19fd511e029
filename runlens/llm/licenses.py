"""Licence scan by canonical digests of entire texts.

A unit is a whole document, one of its paragraphs or one of its lines. Case, punctuation, white space,
copyright lines and equivalent spellings are normalised; the digest of what is left is joined with the
digests of known licence texts and notices. The known texts are a parameter; their table is bounded by
that list and broadcast. Only units with as many words as some known text are digested, which loses
nothing because no rule changes the number of words once copyright lines are gone.

Defined results: null or empty text has no licence; a licence found in several units of a document is
reported once; every row gives a row, so repeated rows repeat. An empty list of known texts finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that count as the same word, by the published matching guidelines.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "authorised": "authorized",
    "favour": "favor",
    "fulfil": "fulfill",
    "judgement": "judgment",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "organisation": "organization",
    "programme": "program",
    "recognise": "recognize",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Public licence texts and the notices that name a licence.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
)

COPYRIGHT_LINE = r"(?m)^[ \t#*/;-]*(?:copyright|©|\(c\)|all rights reserved)[^\n]*$"
_MARKS = r"[^\p{L}\p{N}]+"


def _words(lowered: Column) -> Column:
    return F.trim(F.regexp_replace(lowered, _MARKS, " "))


def _spelled(words: Column) -> Column:
    for variant, standard in SPELLINGS.items():
        words = F.regexp_replace(words, rf"\b{variant}\b", standard)
    return words


def _n_words(words: Column) -> Column:
    return F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1


def _uncopyrighted(text: Column) -> Column:
    lowered = F.lower(text)
    marked = lowered.contains("copyright") | lowered.contains("©") | lowered.contains("(c)") | lowered.contains("all rights")
    return F.when(marked, F.regexp_replace(lowered, COPYRIGHT_LINE, "")).otherwise(lowered)


def known_digests(spark, known: tuple = KNOWN) -> DataFrame:
    """license_id, digest and n_words of the known texts; as many rows as the list has, at most."""
    texts = spark.createDataFrame(list(known), "license_id string, text string")
    words = _spelled(_words(_uncopyrighted(F.col("text"))))
    return texts.select("license_id", F.sha2(words, 256).alias("digest"), _n_words(words).alias("n_words")).distinct()


def scan(docs: DataFrame, known: tuple = KNOWN) -> DataFrame:
    """doc_id, license_ids in order, and whether the whole document is a licence text, for every row."""
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    sizes = sorted({r["n_words"] for r in digests.select("n_words").collect()})
    lowered = _uncopyrighted(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), lowered.alias("lowered"))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("lowered").alias("unit")))
    paragraphs = F.when(F.col("lowered").rlike(r"\n[ \t\r]*\n"), F.split("lowered", r"\n[ \t\r]*\n", -1)).otherwise(F.array().cast("array<string>"))
    lines = F.split("lowered", "\n", -1)
    parts = F.transform(F.concat(paragraphs, lines), lambda u: F.struct(F.lit(False).alias("whole"), u.alias("unit")))
    units = rows.select("doc_id", "row", F.inline(F.concat(whole, parts)))
    longest = max((len(text) for _, text in known), default=0)
    # Marks and white space may stretch a unit, words cannot: a first bound by letters, then by words.
    units = units.select("doc_id", "row", "whole", _words(F.col("unit")).alias("words")).where(F.length("words") <= 2 * longest)
    units = units.where((F.col("words") != "") & _n_words(F.col("words")).isin(sizes))
    found = units.select("doc_id", "row", "whole", F.sha2(_spelled(F.col("words")), 256).alias("digest"))
    found = found.join(F.broadcast(digests.select("license_id", "digest")), "digest")
    by_row = found.groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_set("license_id")).alias("license_ids"), F.max("whole").alias("whole_document")
    )
    return rows.select("doc_id", "row").join(by_row.drop("doc_id"), "row", "left").select(
        "doc_id",
        F.coalesce(F.array_join("license_ids", ","), F.lit("")).alias("license_ids"),
        F.coalesce("whole_document", F.lit(False)).alias("whole_document"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(known: tuple = KNOWN) -> str:
    """The same rules as SQL over `documents`."""

    def canonical(column: str) -> str:
        sql = f"regexp_replace(lower({column}), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
        sql = f"trim(regexp_replace({sql}, {_quoted(_MARKS)}, ' ', 'g'))"
        for variant, standard in SPELLINGS.items():
            sql = f"regexp_replace({sql}, '\\b{variant}\\b', '{standard}', 'g')"
        return sql

    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    return f"""
        WITH known AS (
            SELECT DISTINCT license_id, {canonical("text")} AS words FROM (VALUES {rows}) AS t(license_id, text)
        ), units AS (
            SELECT doc_id, true AS whole, text AS unit FROM documents
            UNION ALL SELECT doc_id, false, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents
            UNION ALL SELECT doc_id, false, unnest(string_split(text, chr(10))) FROM documents
        ), found AS (
            SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, bool_or(whole) AS whole
            FROM (SELECT doc_id, whole, {canonical("unit")} AS words FROM units) JOIN known USING (words)
            WHERE words <> '' GROUP BY doc_id
        )
        SELECT doc_id, coalesce(ids, '') AS license_ids, coalesce(whole, false) AS whole_document
        FROM documents LEFT JOIN found USING (doc_id)
    """
