"""Licence texts found by the digest of their canonical form.

DataFrame functions only.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlib.llm.common import quoted

# Spellings that count as the same.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("recognised", "recognized"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    ("&", "and"),
)

# Licence texts and notices, without their copyright lines.
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted"""
_SHORT = (
    ("MIT", f"{_MIT_GRANT}\n{_WARRANTY}"),
    ("MIT", f"MIT License\n{_MIT_GRANT}\n{_WARRANTY}"),
    ("MIT", f"The MIT License (MIT)\n{_MIT_GRANT}\n{_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice "
            f"appear in all copies.\n{_ISC_WARRANTY}"),
    ("ISC", f"ISC License\n{_ISC_GRANT}, provided that the above copyright notice and this "
            f"permission notice appear in all copies.\n{_ISC_WARRANTY}"),
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n{_BSD_WARRANTY}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_HEAD}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n{_BSD_THIRD}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_HEAD}\n{_BSD_THIRD}\n{_BSD_WARRANTY}"),
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
)
# Licence files as published, by the name of the licence.
_FILES = Path(__file__).parent / "license_texts"
# Long licences tell how to apply them after this line; copies often leave that out.
_LAST = "END OF TERMS AND CONDITIONS"


def _from_files() -> tuple[tuple[str, str], ...]:
    """Each file whole, and up to the end of its terms."""
    found = []
    for path in sorted(_FILES.glob("*.txt")):
        body = path.read_text(encoding="utf-8")
        found.append((path.stem, body))
        terms, last, _ = body.partition(_LAST)
        if last:
            found.append((path.stem, terms + last))
            found.append((path.stem, terms))
    return tuple(found)


TEXTS = (*_SHORT, *_from_files())
KNOWN = (*TEXTS, *NOTICES)

# Punctuation, control characters and blanks, of lower-case text.
_GAPS = "[\\x00-/:-`{-\\x7f“”‘’„«»–—…©®™ ]+"
# A line that only says whose the copyright is.
_COPYRIGHT = r"^[\x00-/:-`{-\x7f]*(copyright|©|\(c\))([^a-z]|$).*$"


def canonical_lines(text: Column) -> Column:
    """Lines of a text in canonical form: lower case, one spelling, single blanks for
    punctuation; copyright lines and lines without a letter or digit are left out."""
    folded = F.lower(text)
    for other, usual in SPELLINGS:
        folded = F.replace(folded, F.lit(other), F.lit(usual))
    lines = F.filter(F.split(folded, "\n"), lambda x: ~x.rlike(_COPYRIGHT))
    bare = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, _GAPS, " ")))
    return F.filter(bare, lambda x: x != "")


def digest(lines: Column) -> Column:
    """Of a whole text in canonical form; where its lines break does not matter."""
    return F.sha2(F.array_join(lines, " "), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest``, ``license`` of each known text: a row for each, so it may be broadcast."""
    rows = spark.createDataFrame(list(known), "license string, body string")
    found = rows.select(digest(canonical_lines(F.col("body"))).alias("digest"), "license")
    return found.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``digest``, ``license``, ``notices`` of every row: the digest of the whole text in
    canonical form, the licence whose text it is, and the licences that single lines of it are
    the whole text or notice of, in order and comma-joined.

    ``license`` is null and ``notices`` empty where there are none. A null text counts as empty; an
    empty one has the digest of nothing, which no licence has. Rows that repeat an id keep
    their own results. ``known`` (``digest``, ``license``) has one row per known text and is broadcast;
    documents are not shuffled.
    """
    body = F.coalesce(quoted(text).cast("string"), F.lit(""))
    lines = docs.select(
        quoted(id).cast("long").alias("doc_id"), canonical_lines(body).alias("lines")
    )
    digests = lines.select(
        "doc_id",
        digest(F.col("lines")).alias("digest"),
        F.transform("lines", lambda x: F.sha2(x, 256)).alias("line_digests"),
    )
    whole = digests.join(F.broadcast(known), "digest", "left")
    # the known digests as one map: a hash lookup for each line, where a join would need a row
    # for each line and a shuffle to bring a document's lines together again
    table = known.agg(
        F.map_from_entries(F.collect_list(F.struct("digest", "license"))).alias("by_digest")
    )
    found = whole.withColumn("by_digest", table.scalar())
    notices = F.filter(
        F.transform("line_digests", lambda d: F.try_element_at("by_digest", d)),
        lambda x: x.isNotNull(),
    )
    return found.select(
        "doc_id",
        "digest",
        "license",
        F.array_join(F.array_sort(F.array_distinct(notices)), ",").alias("notices"),
    )
