"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case, copyright notices dropped, punctuation
and line breaks to single spaces, equivalent spellings to one of them. A notice is a line
with the word copyright (or its sign) and a year, a sign or a holder's name; a body line
that only begins with the word stays. A notice that shares its lines with the licence is
cut, whatever its length and form, from the word copyright at the start (after a title) to
the words with which a known text opens; so wrapping does not matter. The SHA-256 of the
whole form is joined with the digests of known licences. The same is done for every line,
so that one-line notices inside other text are found too.

The table of known digests is small by nature; it is broadcast when it has at most
``broadcast_rows`` rows and otherwise joined in the ordinary way. Lines are exploded and
joined inside one stage, and only one row per text and its matches are shuffled.

Defined results: null, empty and wordless texts match nothing; a licence that occurs
several times is listed once; an empty table of licences matches nothing.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

# -- Fixed values ---------------------------------------------------------------

#: Spellings that count as equal, as in the public matching guidelines for licences.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "centre": "center", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "licence": "license", "licenced": "licensed", "licences": "licenses", "merchantibility": "merchantability",
    "modelled": "modeled", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Name and text; several texts may stand for one licence.
KNOWN = [
    ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT),
    ("ISC", ISC), ("ISC", "ISC License\n" + ISC), ("Zlib", ZLIB), ("Zlib", "zlib License\n" + ZLIB),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("MIT", "Released under the MIT License"),
]
BSD_TERMS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2, BSD_3 = BSD_TERMS + BSD_END, BSD_TERMS + BSD_THIRD + BSD_END

KNOWN += [
    ("BSD-2-Clause", BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2),
    ("BSD-3-Clause", BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
]
#: A line that is a copyright notice has a year or a sign after the word, or says all rights reserved,
_BEFORE = r"^[^\p{L}\p{N}(©]*"
SIGNED = (_BEFORE + r"(?:(?i:copyright)\s*(?:(?i:\(c\))|©|\d{4}\b)|(?i:\(c\))\s*(?:\d{4}\b|(?i:copyright)\b)|©"
          r"|(?i:all rights reserved)[^\p{L}\p{N}]*$)")
#: or a holder's name, which is none of the words that follow in running text.
NAMED = _BEFORE + r"Copyright\s+(?:by\s+)?\p{Lu}"
UNNAMED = _BEFORE + r"Copyright\s+(?:by\s+)?(?:Notice|Holder|Owner|Law|Act|Licen[cs]e)s?\b"
#: How the known texts begin; a notice that has no line of its own ends there.
OPENINGS = r"(?:permission is hereby granted|permission to use|this software is provided|redistribution and use)"
#: In a canonical text: a notice of any length before a known text, after a title if there is one.
LEADING = r"^((?:\w+ ){0,5}?license (?:mit )?)?(?:copyright|c|\d{4}) .*?\b(" + OPENINGS + r")\b"
#: A text that can hold such a notice.
MARKED = r"(?i)copyright|\(c\)|©"
# -------------------------------------------------------------------------------

_ANY_SPELLING = r"\b(" + "|".join(SPELLINGS) + r")\b"


def canonical(line: Column) -> Column:
    """Canonical form of a line or a text."""
    low = F.lower(line)
    plain = F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))
    one = plain
    for spelling, kept in SPELLINGS.items():
        one = F.regexp_replace(one, rf"\b{spelling}\b", kept)
    return F.when(plain.rlike(_ANY_SPELLING), one).otherwise(plain)


def is_notice(line: Column) -> Column:
    """Whether a line is a copyright notice."""
    return line.rlike(SIGNED) | (line.rlike(NAMED) & ~line.rlike(UNNAMED))


def opened() -> str:
    """A pattern for texts in which a known text begins, however they are wrapped."""
    return "(?i)" + OPENINGS.replace(" ", r"\s+")


def forms(text: Column) -> Column:
    """Canonical forms: the text without its notice lines, the text without a leading notice
    that shares lines with it (or empty), then every line; empty lines dropped."""
    lines = F.array_remove(F.transform(F.split(text, r"\r\n|\r|\n"), lambda line: F.when(
        is_notice(line), F.lit("")).otherwise(canonical(line))), "")
    joined = F.when(text.rlike(opened()) & text.rlike(MARKED),
                    F.regexp_replace(canonical(text), LEADING, "$1$2")).otherwise("")
    return F.concat(F.array(F.array_join(lines, " "), joined), lines)


def from_folder(folder: str) -> list[tuple[str, str]]:
    """Name and text of the licences kept as files in a folder the driver can read."""
    return [(path.stem, path.read_text("utf-8")) for path in sorted(Path(folder).iterdir()) if path.is_file()]


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest) of known texts, by default all of this module; a text may have several names."""
    table = spark.createDataFrame(KNOWN if texts is None else texts, "license string, text string")
    return table.select("license", F.sha2(forms(F.col("text"))[0], 256).alias("digest")).distinct()


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         broadcast_rows: int = 100_000) -> DataFrame:
    """One row per document: id, whole (licences that are the entire text), lines (licences of lines)."""
    if known.limit(broadcast_rows + 1).count() <= broadcast_rows:
        known = F.broadcast(known)
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").alias("id"),
                       forms(text_of(text_col)).alias("forms"))
    each = rows.select("row_id", "id", F.posexplode("forms").alias("at", "form")).withColumn(
        "digest", F.when(F.col("form") != "", F.sha2("form", 256)))
    met = each.join(known, "digest", "left").where(F.col("license").isNotNull() | (F.col("at") == 0))
    names = lambda where: F.sort_array(F.collect_set(F.when(where, F.col("license"))))
    return met.groupBy("row_id").agg(
        F.first("id").alias("id"), names(F.col("at") <= 1).alias("whole"), names(F.col("at") > 1).alias("lines"))
