"""Licence scan: normalised whole texts are hash-joined to the digests of known licences.

Only Spark SQL functions. The canonical form lower-cases, drops copyright lines,
unifies equivalent spellings and turns everything but letters and digits into single
spaces; its SHA-256 is the join key. Whole texts are looked up, and so is every whole
line, where one-line licence statements stand.
"""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Clause that BSD-3-Clause has before the last paragraph.
BSD3 = BSD2.replace(
    "\n\nTHIS SOFTWARE",
    "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE",
)
#: Files with the whole texts: licence -> (family, where the text begins behind its heading, where an appendix begins).
TEXTS = {
    "0BSD": ("permissive", "Permission to use", None),
    "Apache-2.0": ("permissive", "TERMS AND CONDITIONS FOR USE", "APPENDIX: How to apply"),
    "Artistic-1.0-Perl": ("permissive", "Preamble", None),
    "BSD-3-Clause": ("permissive", "Redistribution and use", None),
    "CC0-1.0": ("permissive", "Statement of Purpose", None),
    "GFDL-1.2": ("copyleft", "0. PREAMBLE", "ADDENDUM: How to use"),
    "GFDL-1.3": ("copyleft", "0. PREAMBLE", "ADDENDUM: How to use"),
    "GPL-1.0": ("copyleft", "Preamble", "Appendix: How to Apply"),
    "GPL-2.0": ("copyleft", "Preamble", "How to Apply These Terms to Your New"),
    "GPL-3.0": ("copyleft", "Preamble", "How to Apply These Terms to Your New"),
    "LGPL-2.0": ("copyleft", "Preamble", "How to Apply These Terms to Your New"),
    "LGPL-2.1": ("copyleft", "Preamble", "How to Apply These Terms to Your New"),
    "LGPL-3.0": ("copyleft", "This version of the GNU Lesser", None),
    "MPL-1.1": ("copyleft", "1. Definitions", "EXHIBIT A -Mozilla"),
    "MPL-2.0": ("copyleft", "1. Definitions", "Exhibit A - Source Code Form"),
    "Unlicense": ("permissive", "This is free and unencumbered", None),
    "Zlib": ("permissive", "This software is provided", None),
}
END_LINE = "END OF TERMS AND CONDITIONS"
#: The GNU licences' address over the years; a text with the first is known with each.
ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? +MA +02110-1301,? +USA")
ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "675 Mass Ave, Cambridge, MA 02139, USA",
)


def _forms(body: str, begin: str, appendix: str | None) -> set[str]:
    """The text as published, without its heading, without its appendix and the line before it, and with other addresses."""
    starts = [body, body[body.index(begin) :]]
    if appendix:
        short = [t[: t.index(appendix)] for t in starts]
        starts += short + [t[: t.index(END_LINE)] for t in short if END_LINE in t]
    links = [t.replace(found, kept) for t in starts for found, kept in (("http://", "https://"), ("https://", "http://"))]
    starts = {*starts, *links}
    return starts | {ADDRESS.sub(address, t) for t, address in product(starts, ADDRESSES)}


def _whole() -> list[tuple[str, str, str]]:
    folder = Path(__file__).parent / "license_texts"
    return [
        (name, family, form)
        for name, (family, begin, appendix) in TEXTS.items()
        for form in sorted(_forms((folder / f"{name}.txt").read_text(encoding="utf-8"), begin, appendix))
    ]


#: Fixed values: (licence, family, known text).
KNOWN = (
    ("MIT", "permissive", MIT),
    ("MIT", "permissive", "MIT License\n" + MIT),
    ("MIT", "permissive", "The MIT License (MIT)\n" + MIT),
    ("ISC", "permissive", ISC),
    ("ISC", "permissive", "ISC License\n" + ISC),
    ("BSD-2-Clause", "permissive", BSD2),
    ("BSD-2-Clause", "permissive", "BSD 2-Clause License\n" + BSD2),
    ("BSD-3-Clause", "permissive", BSD3),
    ("BSD-3-Clause", "permissive", "BSD 3-Clause License\n" + BSD3),
    *_whole(),
    ("MIT", "permissive", "Released under the MIT License."),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0."),
    ("MIT", "permissive", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "permissive", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "copyleft", "SPDX-License-Identifier: GPL-3.0-only"),
)
#: Equivalent spellings, (as found, as kept), applied in this order to lower-case words one space apart.
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("copyright owner", "copyright holder"),
)
#: A notice names a year, or a blank to fill in, or bears the sign; other lines that begin with the word are terms.
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[\[<{(]?(?:[0-9]{4}|yyyy|year))|(?:\(c\)|©)[ \t]*(?:copyright[ \t]*)?[\[<{(]?(?:[0-9]{4}|yyyy|year)|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower-case words one space apart, without notices, in one spelling; line breaks inside terms do not matter."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, OTHER, " "))
    for found, kept in SPELLINGS:
        out = F.replace(out, F.lit(found), F.lit(kept))
    return out


def digest(text: Column) -> Column:
    """Digest of the canonical form; NULL if nothing is left of it."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def known_digests(spark, known=KNOWN) -> DataFrame:
    """(digest, license_id, family): as many rows as the list has entries, which bounds the broadcast."""
    rows = spark.createDataFrame(list(known), "license_id string, family string, body string")
    return rows.select(digest(F.col("body")).alias("digest"), "license_id", "family").groupBy("digest").agg(F.min("license_id").alias("license_id"), F.min("family").alias("family"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=KNOWN) -> DataFrame:
    """One row per document: doc_id, text_digest, license_id, family, line_licenses.

    ``license_id`` and ``family`` are of the licence whose known text the whole
    document equals in canonical form, else NULL. ``line_licenses`` are the licences
    stated by whole lines, distinct and sorted. NULL, empty and sign-only texts have no
    digest and no licence. Repeated documents give repeated rows; an empty table none.
    The list of known texts is a constant of the program, so its broadcast is bounded.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    single = [k for k in known if "\n" not in k[2]]
    lines = F.split(text, "\n")
    if all("license" in k[2].lower() for k in single):
        lines = F.filter(lines, lambda line: F.lower(line).rlike("licen[cs]e"))  # no other line can equal a known one
    pairs = [F.lit(x) for row in known_digests(spark, single).collect() for x in (row["digest"], row["license_id"])]
    by_digest = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    stated = F.transform(lines, lambda line: by_digest[digest(line)])
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        digest(text).alias("text_digest"),
        F.array_sort(F.array_distinct(F.array_compact(stated))).alias("line_licenses"),
    )
    whole = F.broadcast(known_digests(spark, known).withColumnRenamed("digest", "text_digest"))
    return rows.join(whole, "text_digest", "left").select("doc_id", "text_digest", "license_id", "family", "line_licenses")


def _sql() -> str:
    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def form(text: str) -> str:
        out = f"regexp_replace(lower({text}), {quoted(COPYRIGHT_LINE)}, ' ', 'g')"
        out = f"trim(regexp_replace({out}, {quoted(OTHER)}, ' ', 'g'))"
        for found, kept in SPELLINGS:
            out = f"replace({out}, {quoted(found)}, {quoted(kept)})"
        return out

    values = ", ".join("(" + ", ".join(map(quoted, k)) + ")" for k in KNOWN)
    return f"""
WITH known AS (SELECT sha256({form("body")}) AS h, min(license_id) AS license_id, min(family) AS family, bool_or(NOT contains(body, chr(10))) AS single
               FROM (VALUES {values}) AS k(license_id, family, body) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS text, {form("coalesce(text, '')")} AS form FROM documents),
line AS (SELECT doc_id, sha256({form("line")}) AS h FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE contains(lower(line), 'licen')),
named AS (SELECT doc_id, list_sort(list_distinct(list(license_id))) AS found FROM line JOIN known USING (h) WHERE single GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN form <> '' THEN sha256(form) END AS text_digest, license_id, family, coalesce(array_to_string(found, ','), '') AS line_licenses
FROM d LEFT JOIN known ON form <> '' AND known.h = sha256(form) LEFT JOIN named USING (doc_id)
"""


SQL = _sql()
