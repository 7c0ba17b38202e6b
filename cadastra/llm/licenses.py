"""Licence scans by canonical digest.

A text is made canonical line by line: copyright lines go, letters are lower-cased, runs of other characters than
letters and digits become one space, and equivalent spellings are made one. The SHA-256 of the canonical text is hash-joined
with the digests of known licences; the digests of single lines are joined with those of known notices.

Defined results: null and empty texts, and texts of copyright lines and punctuation only, have no digest and
no licence; repeated rows each get their row; if two known texts have one digest the smaller id stands;
an empty catalogue finds nothing; columns with clashing names in the input are not read.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import text_of

COPYRIGHT_LINE = (
    r"^[^\p{L}\p{N}(©]*((copyright|©|\(c\))[ \t]*(\(c\)|©|<year>|\[year\]|\[yyyy\]|[0-9]{4})|all rights reserved[^\p{L}\p{N}]*$)"
)
SEPARATORS = r"[^\p{L}\p{N}]+"

#: Spellings that count as equal, applied in this order to words with a space on either side.
SPELLINGS = (
    ("licence", "license"),
    ("licenc", "licens"),
    ("isation", "ization"),
    ("ise ", "ize "),
    ("ised ", "ized "),
    ("ising ", "izing "),
    ("our ", "or "),
    ("tre ", "ter "),
    ("ogue ", "og "),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("fulfilment", "fulfillment"),
    ("wilful", "willful"),
    (" per cent ", " percent "),
    (" non commercial ", " noncommercial "),
    (" sub license ", " sublicense "),
    (" copyright owner ", " copyright holder "),
    (" https ", " http "),
)

MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

ZERO_BSD_BODY = ISC_BODY.replace(
    ", provided that the above copyright notice and this permission notice appear in all copies", ""
)

ZLIB_BODY = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Whole licence texts by SPDX id, each with its customary titles (empty: none).
LICENSES = (
    ("MIT", ("", "MIT License", "The MIT License", "The MIT License (MIT)"), MIT_BODY),
    ("ISC", ("", "ISC License"), ISC_BODY),
    ("0BSD", ("", "BSD Zero Clause License", "Zero-Clause BSD"), ZERO_BSD_BODY),
    ("Zlib", ("", "zlib License"), ZLIB_BODY),
)

#: Longer whole texts, a JSON object (license, text) per line: variants that differ in title, numbering or appendix have each a line.
TEXTS = Path(__file__).with_suffix(".jsonl")

#: One-line notices by SPDX id.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)


def known_texts() -> list[tuple[str, str, str]]:
    """(kind, id, text): ``license`` for whole texts, ``notice`` for lines."""
    whole = [("license", name, f"{title}\n\n{body}".strip()) for name, titles, body in LICENSES for title in titles]
    rows = map(json.loads, filter(None, TEXTS.read_text("utf-8").split("\n")))
    whole += [("license", row["license"], row["text"]) for row in rows]
    return whole + [("notice", name, line) for name, line in NOTICES]


def canonical_line(line: Column) -> Column:
    lowered = F.lower(line)
    words = F.concat(F.lit(" "), F.regexp_replace(lowered, SEPARATORS, " "), F.lit(" "))
    words = F.regexp_replace(words, " +", " ")
    for spelling, standard in SPELLINGS:
        words = F.replace(words, F.lit(spelling), F.lit(standard))
    return F.when(lowered.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(F.btrim(words))


def canonical_lines(text: Column) -> Column:
    """The canonical lines that are not empty."""
    return F.filter(F.transform(F.split(text, r"\r\n|\n|\r", -1), canonical_line), lambda x: x != "")


def digest_of(canonical: Column) -> Column:
    return F.when(canonical != "", F.sha2(canonical, 256))


def catalogue(spark: SparkSession, texts: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(kind, digest, license): the digests of known texts."""
    rows = spark.createDataFrame(
        known_texts() if texts is None else texts, "kind string, license string, text string"
    )
    canonical = F.array_join(canonical_lines(F.col("text")), " ")
    digests = rows.select("kind", digest_of(canonical).alias("digest"), "license").where("digest IS NOT NULL")
    return digests.groupBy("kind", "digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license, notices): the licence a whole text is, and the ids of the notices among its lines.

    How the digests are joined is left to Spark, which knows the size of the catalogue."""
    lines = docs.select("doc_id", F.sha2(text_of(), 256).alias("part"), canonical_lines(text_of()).alias("lines"))
    notices = known.where("kind = 'notice'").select(F.col("digest").alias("known"), "license")
    hashed = lines.select(
        "doc_id", "part", F.explode(F.array_distinct(F.transform("lines", lambda x: F.sha2(x, 256)))).alias("line")
    )
    found = (
        hashed.join(notices, F.col("line") == F.col("known"))
        .groupBy("doc_id", "part")
        .agg(F.array_sort(F.collect_set("license")).alias("notices"))
        .select(F.col("doc_id").alias("_id"), F.col("part").alias("_part"), "notices")
    )
    whole = lines.select("doc_id", "part", digest_of(F.array_join("lines", " ")).alias("digest"))
    licenses = known.where("kind = 'license'").select(F.col("digest").alias("known"), "license")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part"))
    none = F.array().cast("array<string>")
    return (
        whole.join(licenses, F.col("digest") == F.col("known"), "left")
        .join(found, same, "left")
        .select("doc_id", "digest", "license", F.coalesce("notices", none).alias("notices"))
    )
