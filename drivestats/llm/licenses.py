"""Licence scan by canonical digests (operator 7); DataFrame functions only.

A text is made canonical (lower case, copyright lines dropped, equivalent
spellings made one, punctuation and white space as single blanks) and its
digest joined with the digests of known licence texts (published ones in full,
with and without title and appendix, and one-line notices). Both the whole document
and each of its lines are looked up, as notices stand in lines of their own.

Defined cases: null texts and texts without a letter or digit match nothing;
known texts with the same canonical form give the smallest licence id;
repeated rows are each reported; an empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (pattern, replacement), applied in this order to lower-case text.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("copyright owner", "copyright holder"),
    ("https:", "http:"),
    ("&", " and "),
]
#: Lines that name an owner or a year; wrapped lines that only speak of copyright stay.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|:|by |[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©)[^\n]*$"

# Published licence texts and notices.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
]
#: Published texts in ``license_texts``, and the title lines that are left out of some copies or, for short ones, put before the text.
FULL = {
    "Apache-2.0": ["Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD-3-Clause", "BSD License"],
    "CC0-1.0": ["Creative Commons Legal Code\nCC0 1.0 Universal"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"],
    "MPL-1.1": ["MOZILLA PUBLIC LICENSE\nVersion 1.1"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: Title lines of the short texts of ``KNOWN``.
TITLES = {"ISC": ["ISC License", "The ISC License", "ISC License (ISC)"], "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"]}
#: Lines after which some copies leave out how to apply the licence, and the line that others fill in there.
TERMS_END, PLACEHOLDER = r"(?m)^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$", r"(?m)^.*Copyright \[yyyy\] \[name of copyright owner\].*$"


def _variants(license_id: str, text: str, titles: list[str]) -> list[tuple[str, str]]:
    """The text as published copies have it: with and without its title, its appendix, and 'All rights reserved.' of the owner."""
    bodies = [text]
    for title in titles:
        spaced = r"\s*" + r"\s+".join(re.escape(w) for w in title.split()) + r"[\s-]*"
        if m := re.match(spaced, text):
            bodies.append(text[m.end() :])
    if re.search(TERMS_END, text):
        bodies += [b[: re.search(TERMS_END, b).end()] for b in list(bodies)]
        bodies += [b[: re.search(TERMS_END, b).start()] for b in list(bodies[: len(bodies) // 2])]
    if re.search(PLACEHOLDER, text):
        bodies += [re.sub(PLACEHOLDER, "", b) for b in list(bodies)]
    if len(text) < 2000:
        bodies = [f"{t}\n{r}\n{b}".strip() for b in bodies for t in ["", *titles] for r in ("", "All rights reserved.")]
    return [(license_id, b) for b in dict.fromkeys(bodies)]


def _published() -> list[tuple[str, str]]:
    out = []
    for license_id, titles in FULL.items():
        text = pkgutil.get_data(__package__, f"license_texts/{license_id}.txt").decode("utf-8")
        out += _variants(license_id, text, titles)
    for license_id, text in KNOWN:
        if license_id in TITLES and len(text) > 300:
            out += [v for v in _variants(license_id, text, TITLES[license_id]) if v[1] != text]
    return out


KNOWN += _published()


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for spelling, one in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(one))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def known_digests(licenses: DataFrame) -> DataFrame:
    """(digest, license_id) of ``licenses`` (license_id, text)."""
    made = licenses.select("license_id", canonical(F.col("text")).alias("c")).where("c != ''")
    return made.groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): digest, license_id of the whole text (or null), n_license_lines, line_licenses (ids, sorted, comma-joined)."""
    known = known_digests(licenses)
    t = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    whole = F.expr("IF(c != '', sha2(c, 256), NULL)")
    texts = t.withColumn("c", canonical(F.col("text"))).select("doc_id", "h", whole.alias("digest"))
    lines = t.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("c", canonical(F.col("line"))).where("c != ''").select("doc_id", "h", "line_no", F.sha2("c", 256).alias("digest"))
    found = lines.join(known, "digest").select("doc_id", "h", "line_no", "license_id").distinct()
    found = found.groupBy("doc_id", "h").agg(F.count("*").alias("n"), F.concat_ws(",", F.array_sort(F.collect_set("license_id"))).alias("ids"))
    found = found.withColumnsRenamed({"doc_id": "of_doc", "h": "of_h"})
    out = texts.join(known, "digest", "left").join(found, F.expr("doc_id <=> of_doc AND h = of_h"), "left")
    return out.select("doc_id", "digest", "license_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_license_lines"), F.coalesce("ids", F.lit("")).alias("line_licenses"))


def _canonical_sql(column: str) -> str:
    out = f"regexp_replace(lower({column}), '{COPYRIGHT_LINE}', ' ', 'g')"
    for spelling, one in SPELLINGS:
        out = f"replace({out}, '{spelling}', '{one}')"
    return f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def oracle() -> str:
    values = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    return f"""
WITH raw(license_id, text) AS (VALUES {values}),
known AS (SELECT sha256({_canonical_sql('text')}) AS digest, min(license_id) AS license_id FROM raw GROUP BY 1),
t AS (SELECT row_number() OVER () AS r, doc_id, text, {_canonical_sql('text')} AS c FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t),
f AS (SELECT r, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids FROM l JOIN known ON sha256({_canonical_sql('line')}) = digest GROUP BY r),
d AS (SELECT r, doc_id, CASE WHEN c != '' THEN sha256(c) END AS digest FROM t)
SELECT doc_id, d.digest, license_id, coalesce(n, 0) AS n_license_lines, coalesce(ids, '') AS line_licenses
FROM d LEFT JOIN known ON d.digest = known.digest LEFT JOIN f USING (r)
"""
