"""Licence scans: passages of normalised text against templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

# Public licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3-clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
# Whole licence texts, multi-line headers, and the openings of texts that run over pages; TEMPLATES are one-sentence notices.
_GRANT = "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BINARY = (
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_USE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_NO_WARRANTY = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not "
    "limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall the "
    "copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
    "(including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) "
    "however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) "
    "arising in any way out of the use of this software, even if advised of the possibility of such damage."
)
_GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published "
    "by the Free Software Foundation; either version {1} of the License, or (at your option) any later version. This program is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU {0}General Public License for more details."
)
_VERBATIM = " Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
TEXTS: tuple[tuple[str, str], ...] = (
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("bsd-2-clause", _USE + "1. " + _GRANT + "2. " + _BINARY + _NO_WARRANTY),
    (
        "bsd-3-clause",
        _USE + "1. " + _GRANT + "2. " + _BINARY + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. " + _NO_WARRANTY,
    ),
    ("gpl-2.0", _GNU.format("", "2")),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc." + _VERBATIM),
    ("gpl-3.0", _GNU.format("", "3")),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc." + _VERBATIM),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
    ("lgpl-3.0", _GNU.format("Lesser ", "3")),
    ("lgpl-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc." + _VERBATIM),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)
PASSAGES = "array<struct<less:double,license:string,short:int,first:int,last:int>>"
LETTERS = r"[^\p{L}\p{N}\n]+"


def normalised(text: Column) -> Column:
    """Lower case; what is no letter, digit or line end becomes one blank."""
    return F.regexp_replace(F.lower(text), LETTERS, " ")


def template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


@dataclass(frozen=True)
class Template:
    """A notice's distinct bigrams; a passage of `least` Dice has `need` of them and one of the words `clues`."""

    license: str
    pairs: tuple[str, ...]
    size: int  # bigrams, repeated ones too
    need: int
    clues: tuple[str, ...]


def template(license: str, text: str, least: float) -> Template:
    words = template_words(text)
    every = [f"{a} {b}" for a, b in zip(words, words[1:])]
    pairs = tuple(dict.fromkeys(every))
    # c common of b and k bigrams: c <= b, so 2c / (b + k) >= d takes c >= k * d / (2 - d).
    need = max(1, math.ceil(len(pairs) * least / (2 - least) - 1e-9))
    # Long words first, until those bigrams that have none of them are too few.
    clues: list[str] = []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(not set(p.split(" ")) & set(clues) for p in pairs) < need:
            break
        clues.append(word)
    return Template(license, pairs, len(every), need, tuple(clues))


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES + TEXTS,
    least: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, matches: array of line, license, dice for every passage with a Dice coefficient of `least`, in order.

    Passages are windows of a template's size, its 5/4 and its 3/2, from one of its bigrams to another, over the whole
    text with line ends as blanks, and single lines as a whole. Of passages that share words the best stays, ties go to
    the license first by name, then to the longer passage; `line` is that of the first word. A text needs
    d / (2 - d) of a template's bigrams to reach d, so windows are made only where it has that many. Null and
    empty texts and those of fewer than two words match nothing. Each row is judged by itself, so repeated rows give
    repeated results; an empty table gives no rows. Other columns are ignored.
    """
    known = [t for t in (template(name, body, least) for name, body in sorted(templates)) if t.pairs]
    every = sorted({p for t in known for p in t.pairs})
    clues = sorted({w for t in known for w in t.clues})
    lowered = F.lower(text_or_empty(text))
    # Most texts have no clue and aren't taken apart.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.when(reduce(or_, [F.contains(lowered, F.lit(w)) for w in clues]), normalised(lowered)).alias("t"))
    rows = rows.select("doc_id", "t", F.filter(F.split("t", r"[ \n]+"), lambda w: w != "").alias("w"))
    rows = rows.select("doc_id", "t", F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b)).alias("b"))
    rows = rows.select("doc_id", "t", "b", F.array_distinct(F.filter("b", lambda p: p.isin(every))).alias("own"))
    there = [F.size(F.array_intersect("own", F.array(*map(F.lit, t.pairs)))) >= t.need for t in known]
    rows = rows.select("doc_id", "t", "b", F.array(*there).alias("there"))
    rows = rows.select("doc_id", "there", *[F.when(F.exists("there", lambda x: x), F.col(c)).alias(c) for c in ("t", "b")])
    # Lines as first and last bigram; those of one word have none.
    counts = F.transform(F.split("t", "\n", -1), lambda x: F.size(F.filter(F.split(x, " "), lambda w: w != "")))
    rows = rows.withColumn("words", counts)
    begun = F.aggregate("words", F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    rows = rows.withColumn("begun", begun)
    lines = F.zip_with("begun", "words", lambda a, n: F.struct(a.alias("first"), (a + n - 2).alias("last")))
    rows = rows.withColumn("lines", F.filter(lines, lambda x: x["last"] >= x["first"]))

    def passages(t: Template, place: int) -> Column:
        pairs = F.array(*map(F.lit, t.pairs))
        at = F.filter(F.transform("b", lambda p, i: F.when(p.isin(list(t.pairs)), i)), lambda i: i.isNotNull())

        def windows(at: Column) -> Column:
            sizes = sorted({t.size, t.size * 5 // 4, t.size * 3 // 2})
            ends = F.array(*map(F.lit, sizes))
            return F.flatten(F.transform(at, lambda a: F.transform(
                F.filter(F.transform(ends, lambda n: F.filter(at, lambda z: (z >= a) & (z < a + n))), lambda z: F.size(z) >= t.need),
                lambda z: F.struct(a.alias("first"), F.element_at(z, -1).alias("last")),
            )))

        def judged(x: Column) -> Column:
            inside = F.array_distinct(F.slice("b", x["first"] + 1, x["last"] - x["first"] + 1))
            score = 2 * F.size(F.array_intersect(inside, pairs)) / (F.size(inside) + len(t.pairs))
            return F.struct((-score).alias("less"), F.lit(t.license).alias("license"), (x["first"] - x["last"]).alias("short"), x["first"].alias("first"), x["last"].alias("last"))

        # One element, so that the places of the bigrams are found once.
        found = F.flatten(F.transform(F.array(at), windows))
        whole = F.filter("lines", lambda x: x["last"] - x["first"] + 1 >= t.need)
        all_of = F.filter(F.transform(F.array_distinct(F.concat(found, whole)), judged), lambda x: x["less"] <= -least)
        return F.when(F.element_at("there", place), all_of).otherwise(F.array().cast(PASSAGES))

    parts = F.array(*(passages(t, i) for i, t in enumerate(known, 1)))
    best = F.aggregate(
        F.array_sort(F.flatten(parts)),
        F.array().cast(PASSAGES),
        # The last bigram ends in the word behind it.
        lambda acc, x: F.when(F.exists(acc, lambda y: (y["first"] <= x["last"] + 1) & (x["first"] <= y["last"] + 1)), acc).otherwise(F.concat(acc, F.array(x))),
    )
    rows = rows.withColumn("best", F.when(F.col("b").isNotNull(), best))
    ordered = F.array_sort(F.transform("best", lambda x: F.struct(x["first"].alias("first"), x["license"].alias("license"), (-x["less"]).alias("dice"))))
    return rows.select(
        "doc_id",
        F.coalesce(
            F.transform(
                ordered,
                # Of empty lines at one place the last one has begun; the array's end is no line.
                lambda x: F.struct(
                    F.size(F.filter(F.slice("begun", 1, F.size("words")), lambda a: a <= x["first"])).alias("line"), x["license"].alias("license"), x["dice"].alias("dice")
                ),
            ),
            F.array().cast("array<struct<line:int,license:string,dice:double>>"),
        ).alias("matches"),
    )


def license_digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m["line"].cast("string"), m["license"])), ",").alias("lines"),
        F.round(F.coalesce(F.array_max(F.col("matches.dice")), F.lit(0.0)), 6).alias("best_dice"),
    )
