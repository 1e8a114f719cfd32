"""Licences and licence notices found by digests of whole normalised texts.

A text is normalised so that copies which mean the same read the same: A-Z lower case, copyright statements (to the end of
their line, or to the words that begin the terms) and lines that only reserve all rights gone, quotes, dashes and other punctuation and all white space one space, and
equivalent spellings made equal. Its digest is then joined with those of known texts. Three
kinds of text are looked up: each document as a whole, each of its lines, and each block of lines between blank lines,
so that a notice may be wrapped. All joins are equalities with the table of known digests, which is broadcast only while small.

Lines that match are few; they are gathered per document from the matches alone.

Cases: a null or blank text, and one without anything but copyright lines, matches nothing; texts of any length are
normalised whole; repeated rows match alike, and rows that share an id but not a text are told apart by their
digest; a line or block found twice counts once in ``notices``; two known texts with one digest are both reported, joined by
"+"; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Known texts are broadcast up to so many rows, some 20 MB.
BROADCAST_TEXTS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that begin a licence's terms; a copyright statement ends before them, or with its line.
_STARTS = (r"everyone\s+is|permission\s+(?:is|to)\b|redistribution\s+and|licen[cs]ed\s+under|all\s+rights\s+reserved|"
           r"this\s+(?:is\s+free|program|library|software|file|work|license)\b")
#: A sign alone may be a clause's letter, so a year is asked for; after the word, a sign, a year or "by".
_TO_END = rf"[^\n]*?(?=\n|\z|{_STARTS})"
_COPYRIGHT_LINE = (
    rf"copyright[ \t:]*(?:\(c\)|©|\d{{4}}|by\b){_TO_END}|"
    rf"(?m:^)[ \t#*/;%-]*(?:(?:\(c\)|©)[ \t]*(?:copyright[ \t]*)?\d{{4}}{_TO_END}|all rights reserved[ \t.*/]*(?m:\r?$))")
_NOT_WORD = r"[^\p{L}\p{N}+]+"

#: Equivalent spellings, after case and punctuation are gone.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("sub licence", "sublicense"), ("non commercial", "noncommercial"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("behaviour", "behavior"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("judgement", "judgment"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("organise", "organize"), ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("copyright owner", "copyright holder"), ("per cent", "percent"), ("v 2", "version 2"),
    ("v 3", "version 3"), ("http", "https"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details. You should have received a copy of the GNU General Public License along with this program.
If not, see <https://www.gnu.org/licenses/>."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_END = "\nFor more information, please refer to <https://unlicense.org>"

#: Licences and notices by SPDX id, texts as published. Names and forms of one-line notices.
TEXTS = (("MIT", _MIT), ("ISC", _ISC), ("Apache-2.0", _APACHE), ("GPL-3.0-or-later", _GPL3),
         ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
         ("Unlicense", _UNLICENSE + _UNLICENSE_END), ("Unlicense", _UNLICENSE))
#: Full texts as published, in files named by SPDX id; what follows the end of the terms may be missing in a copy.
FILES = Path(__file__).parent / "license_texts"
_END = "END OF TERMS AND CONDITIONS"
TITLES = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)")),
    ("ISC", ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License")),
    ("Unlicense", ("The Unlicense", "Unlicense")),
)
NAMES = (
    ("MIT", "the MIT License"), ("ISC", "the ISC License"), ("Apache-2.0", "the Apache License, Version 2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"), ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"), ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"), ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"), ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
)
FORMS = (
    "Licensed under {}.", "Released under {}.", "Distributed under {}.", "Published under {}.",
    "This work is licensed under {}.", "This project is licensed under {}.", "This software is licensed under {}.",
    "This software is released under {}.", "This program is licensed under {}.", "Available under {}.",
)


def known_texts(spark: SparkSession) -> DataFrame:
    """(license, text): whole licences, those with a title also with it, and one-line notices of each."""
    whole = list(TEXTS)
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        # The terms end before or with this line.
        terms, end, _ = text.partition(_END)
        whole += [(path.stem, t) for t in dict.fromkeys((text, terms, terms + end))]
    # Copies often have each paragraph on one line.
    whole += [(spdx, re.sub(r"(?<!\n)\n(?![ \t]*\n)[ \t]*", " ", text)) for spdx, text in list(whole)]
    # Clauses of BSD texts come with numbers or with other marks.
    whole += [(spdx, re.sub(r"(?m)^\d\. ", "- ", text)) for spdx, text in TEXTS if spdx.startswith("BSD")]
    titles = dict(TITLES)
    whole += [(spdx, f"{title}\n\n{text}") for spdx, text in list(whole) for title in titles.get(spdx, ())]
    notices = [(spdx, form.format(name)) for spdx, name in NAMES for form in FORMS]
    return spark.createDataFrame([*whole, *notices], "license string, text string")


def normal(text: Column) -> Column:
    """A text without case, copyright lines, punctuation and variant spellings; null for a null."""
    def without_statements(lower: Column) -> Column:
        marked = F.contains(lower, F.lit("copyright")) | F.contains(lower, F.lit("(c)")) | F.contains(lower, F.lit("©")) | (
            F.contains(lower, F.lit("all rights reserved")))
        return F.when(marked, F.regexp_replace(lower, _COPYRIGHT_LINE, " ")).otherwise(lower)

    # By way of an array, so that the text is lowered once.
    lower = F.transform(F.array(F.translate(text, _UPPER, _LOWER)), without_statements)
    words = F.regexp_replace(F.get(lower, F.lit(0)), _NOT_WORD, " ")
    spelt = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    for variant, usual in SPELLINGS:
        spelt = F.replace(spelt, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return F.trim(spelt)


def digest(text: Column) -> Column:
    """Digest of a normalised text; null for a null."""
    return F.sha2(normal(text), 256)


def scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, license, notices.

    ``license`` is that of the known text the whole document equals, else null; ``notices`` the sorted licences of
    the lines and blocks of lines that equal known texts.
    """
    nothing = F.col("_known") == F.sha2(F.lit(""), 256)
    table = known.select("license", digest(F.col("text")).alias("_known")).filter(~nothing).groupBy("_known").agg(
        F.array_join(F.array_sort(F.collect_set("license")), "+").alias("license"))
    if table.count() <= BROADCAST_TEXTS:
        table = F.broadcast(table)
    given = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    own = F.xxhash64("text").alias("_own")
    # Digests are made below the generator: the join's filter on its key stays above it and makes none again.
    blocks = F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda block: F.contains(block, F.lit("\n")))
    pieces = F.concat(F.split("text", "\n"), blocks)
    lines = given.select("doc_id", own, F.explode(F.transform(pieces, digest)).alias("_known"))
    hits = lines.join(table, "_known")
    notices = hits.groupBy("doc_id", "_own").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    notices = notices.withColumnsRenamed({"doc_id": "_doc", "_own": "_of"})
    whole = given.select("doc_id", own, digest(F.col("text")).alias("_known")).join(table, "_known", "left")
    joined = whole.join(notices, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_of")), "left")
    return joined.select(
        "doc_id", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
