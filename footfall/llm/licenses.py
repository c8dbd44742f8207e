"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case, without copyright lines and punctuation, with
one spelling for words that have several. What is compared is always a whole unit: the whole
document, one to ``most`` consecutive paragraphs of it (as many as the longest known licence
has), or one line. The unit's digest is joined with the digests of the known licences.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, whole_text

# Spellings taken as the same, the second one being the canonical one.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("unauthorised", "unauthorized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("judgement", "judgment"),
    ("noncommercial", "non commercial"),
    ("noninfringement", "non infringement"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("https", "http"),
)

# Names of licences as notices write them, by SPDX identifier.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "0BSD": ("Zero-Clause BSD License", "0BSD"),
    "Zlib": ("zlib License", "Zlib"),
    "Unlicense": ("Unlicense",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL-2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
}
FRAMES = (
    "Licensed under {}",
    "Licensed under the {}",
    "Released under {}",
    "Released under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "License: {}",
    "SPDX-License-Identifier: {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This work is licensed under a {}",
    "This project is licensed under the {}",
    "This software is licensed under the {}",
    "This program is licensed under the {}",
    "This file is licensed under the {}",
)
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")

_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ANY_PURPOSE = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

{}

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_NOTICE_STAYS = ", provided that the above copyright notice and this permission notice appear in all copies"

# Titles that the full texts carry, or go without.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}


def _clauses(n: int) -> list[str]:
    """The text of n conditions, numbered or as a plain list."""
    return [
        _REDISTRIBUTION.format("\n\n".join(mark.format(k) + c for k, c in enumerate(_CONDITIONS[:n], 1)))
        for mark in ("{}. ", "")
    ]


# Public licence texts, without their titles.
BODIES = (
    ("MIT", _GRANT),
    ("0BSD", _ANY_PURPOSE.format("")),
    ("ISC", _ANY_PURPOSE.format(_NOTICE_STAYS)),
    *(("BSD-2-Clause", text) for text in _clauses(2)),
    *(("BSD-3-Clause", text) for text in _clauses(3)),
    ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("Apache-2.0", _APACHE_HEADER),
)
FULL_TEXTS = (
    *BODIES,
    *((name, f"{title}\n\n{text}") for name, text in BODIES for title in TITLES.get(name, ())),
)

# Letters that a marker has at least, so that few other texts hold it.
MARKER_LETTERS = 5


def known_licenses() -> list[tuple[str, str]]:
    """(SPDX identifier, text) of every known notice and licence."""
    names = {k: list(v) for k, v in NAMES.items()}
    for kind in CC_KINDS:
        for version in CC_VERSIONS:
            long = "-".join(CC_PARTS[p] for p in kind.split("-"))
            where = "International" if version == "4.0" else "Unported"
            names[f"CC-{kind}-{version}"] = [
                f"CC {kind} {version}",
                f"CC-{kind}-{version}",
                f"Creative Commons {long} {version}",
                f"Creative Commons {long} {version} {where} License",
            ]
    notices = [(k, frame.format(n)) for k, v in names.items() for n in v for frame in FRAMES]
    return [*notices, *FULL_TEXTS]


def _stem(word: str) -> str:
    """What any text holds in lower case whose canonical form has the word: the letters that all
    spellings of the word begin with. Empty if there is a spelling of several words."""
    stem = word
    for old, kept in SPELLINGS:
        if word in kept.split():
            if " " in old or " " in kept:
                return ""
            stem = commonprefix([stem, old])
    return stem


def markers(canonical_texts: list[str]) -> list[str]:
    """Strings one of which every text holds, in lower case, whose canonical form is one of the
    given ones. They are chosen to be few: each time the stem that most texts still without one
    hold, the longest of these. A text without a stem of MARKER_LETTERS letters gives the empty
    string, which all texts hold."""
    left = []
    for text in set(canonical_texts):
        stems = {_stem(w) for w in text.split() if w.isascii() and w.isalpha()}
        left.append({s for s in stems if len(s) >= MARKER_LETTERS})
    if not left or not all(left):
        return [""]
    chosen = []
    while left:
        held = Counter(s for stems in left for s in stems)
        chosen.append(max(held, key=lambda s: (held[s], len(s), s)))
        left = [stems for stems in left if chosen[-1] not in stems]
    return chosen


def canonical(text: Column) -> Column:
    """Canonical text; line breaks stay, so that lines and paragraphs can be told apart."""
    out = F.lower(F.regexp_replace(text, r"\r\n?", "\n"))
    out = F.regexp_replace(
        out, r"(?m)^[^\p{L}\p{N}©(\n]*(?:copyright|©|\(c\))[ \t]*(?:\(c\)|©|\d|by ).*$|^[^\p{L}\n]*all rights reserved\W*?$", ""
    )
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    out = F.regexp_replace(out, r"(?m)^ +| +$", "")
    out = F.regexp_replace(out, r"\b(?:version|ver|v) ?(?=\d)", "v")
    spelled = dict(SPELLINGS)
    for old in sorted(spelled, key=lambda x: " " in x):  # words first, then phrases of them
        out = F.regexp_replace(out, rf"\b{old}\b", spelled[old])
    return out


def _paragraphs(text: Column) -> Column:
    parts = F.transform(F.split(text, r"\n{2,}"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    return F.filter(parts, lambda p: p != "")


def _canonical_known(
    spark: SparkSession, known: list[tuple[str, str]], scratch: Scratch
) -> DataFrame:
    """(canon, license, paragraphs) of the known texts, a list that the caller holds."""
    rows = spark.createDataFrame(known, "license string, known string")
    parts = _paragraphs(canonical(F.col("known")))
    return scratch.write(
        rows.select(
            F.array_join(parts, " ").alias("canon"), "license", F.size(parts).alias("paragraphs")
        ).distinct()
    )


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, licenses (identifiers, sorted, comma-joined), n_units
    (matching lines and paragraph runs), whole (the whole text is a licence).

    Null texts are empty, and empty units match nothing. Rows that repeat identifier and text
    get equal results; an empty table gives an empty result. ``known`` gives (identifier, text) of
    the licences to look for. Texts that hold none of the ``markers`` of these can hold no
    licence and are not canonicalised.
    """
    scratch = Scratch(docs.sparkSession)
    listed = _canonical_known(docs.sparkSession, known_licenses() if known is None else known, scratch)
    most = listed.agg(F.max("paragraphs")).first()[0] or 1
    marks = markers([r.canon for r in listed.select("canon").collect()])  # as long as ``known``
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text")
    ).withColumn("key", F.xxhash64("id", "text"))
    low = F.lower("text")
    marked = rows.where(reduce(or_, [low.contains(m) for m in marks]))
    parts = marked.dropDuplicates(["key"]).select("key", canonical(F.col("text")).alias("canon"))
    parts = parts.select("key", F.split("canon", "\n").alias("lines"), _paragraphs(F.col("canon")).alias("parts"))
    n = F.size("parts")

    def run_of(at: Column, size: Column) -> Column:
        text = F.array_join(F.slice("parts", at, size), " ")
        return F.struct((size == n).alias("whole"), (at - 1).alias("at"), text.alias("unit"))

    sizes = F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(most)), F.lit(1)))
    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    runs = F.flatten(
        F.transform(
            sizes,
            lambda size: F.transform(
                F.filter(places, lambda at: at + size - 1 <= n), lambda at: run_of(at, size)
            ),
        )
    )
    lines = F.transform(
        F.filter("lines", lambda x: x != ""),
        lambda x: F.struct(F.lit(False).alias("whole"), F.lit(-1).alias("at"), x.alias("unit")),
    )
    whole = F.array(
        F.struct(F.lit(True).alias("whole"), F.lit(0).alias("at"), F.array_join("parts", " ").alias("unit"))
    )
    units = parts.select("key", F.explode(F.concat(runs, lines, whole)).alias("u")).where(
        F.col("u.unit") != ""
    )
    found = (
        units.select("key", "u.whole", "u.at", F.sha2("u.unit", 256).alias("digest"))
        .join(F.broadcast(listed.select(F.sha2("canon", 256).alias("digest"), "license")), "digest")
        .groupBy("key")
        .agg(
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.max("whole").alias("whole"),
            F.count_distinct("whole", "at", "digest").alias("n_units"),
        )
    )
    found = scratch.write(found)
    return rows.select("id", "key").join(found, "key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
        F.coalesce("whole", F.lit(False)).alias("whole"),
    )
