"""Licence texts and notices found by digests of their canonical form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import ship

# Starts of words that count as equal, in the order they are replaced.
SPELLINGS = (
    ("licence", "license"),
    ("licensor", "license or"),
    ("sub license", "sublicense"),
    ("copyright holders", "copyright holder"),
    ("copyright owner", "copyright holder"),
    ("organis", "organiz"),
    ("favour", "favor"),
    ("judgement", "judgment"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("per cent", "percent"),
    ("wilful", "willful"),
    ("merchantibility", "merchantability"),
    ("https", "http"),
    ("version v", "version "),
)

# Short notices and whole licences as their owners publish them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
)

# Lines that name a copyright holder; everything in ASCII that is no
# letter, digit or line end; ends of lines with what surrounds them.
COPYRIGHT_LINE = (
    r"^[^a-z0-9\n]*(copyright[^a-z0-9\n]*(\(c\)|©|[0-9]{4}|by )|\(c\)|©)[^\n]*$"
)
PUNCTUATION = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]+"
LINE_END = r" *\n[ \n]*"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """A-Z in lower case, punctuation as one space, one spelling; a space before each line.

    Copyright lines go, as do empty lines. Characters beyond ASCII stay as they are.
    """
    out = F.concat(F.lit(" "), F.translate(text, CAPITALS, SMALL))
    out = F.regexp_replace(out, f"(?dm){COPYRIGHT_LINE}", "")
    out = F.regexp_replace(out, PUNCTUATION, " ")
    out = F.regexp_replace(out, LINE_END, "\n ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old}"), F.lit(f" {new}"))
    return out


def digest(canonical_text: Column) -> Column:
    """SHA-256 of the words, wherever the lines end; null where there are none."""
    flat = F.btrim(F.replace(canonical_text, F.lit("\n"), F.lit("")))
    return F.when(flat != "", F.sha2(flat.cast("binary"), 256))


def known(spark, licences: Iterable[tuple[str, str]] = NOTICES) -> DataFrame:
    """``digest``, ``licence`` of known texts; of equal texts the first name."""
    frame = spark.createDataFrame(list(licences), "licence string, text string")
    return (
        frame.select("licence", digest(canonical(F.col("text"))).alias("digest"))
        .filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("licence").alias("licence"))
    )


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``text_digest``, ``licence`` of the whole text, ``notices`` of its lines.

    A text is looked up as a whole and line by line; a licence of several lines must
    be the whole text. ``notices`` are the different licences found in lines, by name.
    Null texts and texts without words have no digest, licence or notice. Rows that
    repeat are kept; other columns are left out. Digests meet the known ones in a
    hash join of one narrow row for each different digest of a row.
    """
    named = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", canonical(F.col("text")).alias("_c")
    )
    lines = F.transform(F.split("_c", "\n"), digest)
    hashed = named.select("_row", "doc_id", digest(F.col("_c")).alias("text_digest"), lines.alias("_l"))
    units = hashed.select(
        "_row",
        "doc_id",
        "text_digest",
        F.explode_outer(F.array_distinct(F.array_append("_l", F.col("text_digest")))).alias("digest"),
    )
    whole = F.max(F.when(F.col("digest") == F.col("text_digest"), F.col("licence")))
    return (
        units.join(licences, "digest", "left")
        .groupBy("_row", "doc_id", "text_digest")
        .agg(whole.alias("licence"), F.array_sort(F.collect_set("licence")).alias("notices"))
        .drop("_row")
    )


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    """The canonical form in SQL."""
    out = f"' ' || translate({text}, '{CAPITALS}', '{SMALL}')"
    for pattern, new in ((f"(?m){COPYRIGHT_LINE}", "''"), (PUNCTUATION, "' '"), (LINE_END, "chr(10) || ' '")):
        out = f"regexp_replace({out}, {quoted(pattern)}, {new}, 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old}', ' {new}')"
    return out


def digest_sql(text: str) -> str:
    return f"(case when trim(replace({text}, chr(10), '')) <> '' then sha256(trim(replace({text}, chr(10), ''))) end)"


def scan_sql(licences: Iterable[tuple[str, str]] = NOTICES) -> str:
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licences)
    return f"""
with known as (
  select digest, min(licence) as licence
  from (select licence, {digest_sql("c")} as digest
        from (select licence, {canonical_sql("text")} as c from (values {values}) v(licence, text)))
  where digest is not null group by digest),
named as (select row_number() over () as r, doc_id, {canonical_sql("text")} as c from documents),
units as (
  select r, {digest_sql("line")} as digest
  from (select r, unnest(string_split(c, chr(10))) as line from named)
  union
  select r, {digest_sql("c")} from named),
found as (
  select r, list_sort(list(distinct licence)) as notices
  from units join known using (digest) group by r)
select n.doc_id, {digest_sql("n.c")} as text_digest, k.licence,
       coalesce(array_to_string(f.notices, ','), '') as notices
from named n left join known k on k.digest = {digest_sql("n.c")} left join found f on f.r = n.r
"""


ship(__name__)
