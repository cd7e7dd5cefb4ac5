"""Licence scan: units of a text against licence templates by the Dice coefficient over word bigrams, in column expressions only.

A text's units are its lines, its paragraphs of several lines (runs of non-blank lines), the sentences of both and the whole text; units with the same bigrams
count once. Unit and template are normalised
alike (A-Z lower-cased, words are runs of letters, digits and non-ASCII characters) and compared as sets of word bigrams:
dice = 2 |A and B| / (|A| + |B|) >= ``LEAST``.

Pruning, all of it exact. Size: |A| must lie within LEAST / (2 - LEAST) and its inverse times |B|. Content: with these sizes at most
|B| - ceil(LEAST / (2 - LEAST) |B|) bigrams of the template may be missing, so one of any one more of them is in the unit; ``cover`` picks a few long
words that such bigrams contain, and units (first of all whole texts) without any cover word are not taken apart. Every
document is judged within its own row: nothing is shuffled, so no group can be hot.

Defined cases: null text -> no unit, no licence; units of fewer than two words have no bigram and match nothing; ties of the best licence
go to the first name; repeated rows each get a result; very long texts are whole units too; an empty table gives an empty result; other columns are kept by ``scan``
(``licences``, ``best_licence``, ``best_dice`` and ``n_matches`` are replaced).
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name
from .decontaminate import words

LEAST = 0.8
SENTENCE_END = r"[.!?][ \t\r\n]+"

# Notices and bodies of public licences, (name, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    (
        "ISC",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", BSD_HEAD := "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", BSD_ONE := "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-2-Clause", BSD_TWO := "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", BSD_THREE := "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    (
        "BSD-2-Clause",
        BSD_WARRANTY := "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("BSD-2-Clause", " ".join((BSD_HEAD, BSD_ONE, BSD_TWO, BSD_WARRANTY))),
    ("BSD-3-Clause", " ".join((BSD_HEAD, BSD_ONE, BSD_TWO, BSD_THREE, BSD_WARRANTY))),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    (
        "LGPL-3.0-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
)
#: Whole texts of more than one paragraph, for files that hold nothing else.
TEMPLATES += (("MIT", " ".join(t for n, t in TEMPLATES if n == "MIT" and len(t) > 400)), ("ISC", " ".join(t for n, t in TEMPLATES if n == "ISC")))

#: Words of everyday prose: a cover is made of others first.
COMMON = frozenset(
    "a above all alter altered an and any anyone appreciated are as at author be being binary but by can claim code conditions copies copy damages details direct distribute either even event express following for form forms free from further general "
    "have held hope if in included including international is it its kind law later level list loss made materials may means met mit more must name names neither no nor not notice of on option or origin original other out part particular permitted persons "
    "portions possibility possible prior product products profits program project promote provided public publish published purpose received related released remove required restriction retain rights see sell service shall should source special specific "
    "subject such terms that the this to under use used useful version way whether which will with without work written you".split()
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def size_bounds(size: int, least: float = LEAST) -> tuple[int, int]:
    """Sizes that a unit may have to reach least against a template of this size."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def cover(templates=TEMPLATES, least: float = LEAST) -> list[str]:
    """Words of which every unit that reaches least against a template contains one: those of everyday prose last."""
    chosen: set[str] = set()
    for _, text in templates:
        bigrams = [tuple(b.split()) for b in bigrams_of(text)]
        need = len(bigrams) - size_bounds(len(bigrams), least)[0] + 1
        open_ones = [b for b in bigrams if not chosen & set(b)]
        while len(bigrams) - len(open_ones) < need:
            best = min({w for b in open_ones for w in b}, key=lambda w: (w in COMMON, len(w) < 3, 0 if w in COMMON else -sum(w in b for b in open_ones), -len(w), w))
            chosen.add(best)
            open_ones = [b for b in open_ones if best not in b]
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))  # a word within another stands for it


def _has(text: Column, some: list[str]) -> Column:
    found = F.lit(False)
    for w in some:
        found = found | F.contains(text, F.lit(w))
    return found


def _bigrams(w: Column) -> Column:
    """The sorted set of bigrams of an array of words."""
    pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) >= 2, F.array_sort(F.array_distinct(pairs))).otherwise(F.array().cast("array<string>"))


def with_matches(docs: DataFrame, name: str, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """docs with name: array<struct<name, dice>> of the units' matches.

    Step by step, each in a column of its own: what a step uses several times is then worked out once.
    """
    some, steps = cover(templates, least), []

    def step(df: DataFrame, what: str, value: Column) -> DataFrame:
        steps.append(free_name([*docs.columns, *steps], what))
        return df.withColumn(steps[-1], value)

    sizes = [(n, bigrams_of(t)) for n, t in templates]
    bounds = [size_bounds(len(b), least) for _, b in sizes]
    listed = F.array(*(F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, b)).alias("b"), F.lit(low).alias("low"), F.lit(high).alias("high")) for (n, b), (low, high) in zip(sizes, bounds)))
    least_size, most_size = min(low for low, _ in bounds), max(high for _, high in bounds)
    d = step(docs, "lower", F.lower(F.coalesce("text", F.lit(""))))
    d = step(d, "known", _has(F.col(steps[0]), some))
    known = F.col(steps[1])
    d = step(d, "normal", F.when(known, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))).drop(steps[0])
    text = F.col(steps[2])
    with_cover = lambda units: F.filter(units, lambda u: _has(u, some))
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda p: F.contains(p, F.lit("\n")))
    d = step(d, "blocks", F.concat(with_cover(F.split(text, "\n")), with_cover(paragraphs)))
    blocks = F.col(steps[3])
    sentences = F.filter(F.flatten(F.transform(F.filter(blocks, lambda u: F.regexp_like(u, F.lit(SENTENCE_END))), lambda u: F.split(u, SENTENCE_END))), lambda u: _has(u, some))
    d = step(d, "units", F.array_distinct(F.concat(blocks, sentences, F.array(text)))).drop(steps[3])
    d = step(d, "words", F.transform(F.col(steps[4]), words)).drop(steps[4])
    # a set has no fewer bigrams than distinct words less one, and no more than words
    fitting = F.filter(F.col(steps[5]), lambda w: (F.size(w) > least_size) & (F.size(F.array_distinct(w)) - 1 <= most_size))
    d = step(d, "sets", F.array_distinct(F.transform(fitting, _bigrams))).drop(steps[5])

    def against(b):
        fit = F.filter(listed, lambda t: (F.size(b) >= t["low"]) & (F.size(b) <= t["high"]))
        dice = F.transform(fit, lambda t: F.struct(t["name"].alias("name"), F.round(2.0 * F.size(F.array_intersect(b, t["b"])) / (F.size(b) + F.size(t["b"])), 6).alias("dice")))
        return F.filter(dice, lambda m: m["dice"] >= least)

    none = F.array().cast("array<struct<name:string,dice:double>>")
    return d.select(*docs.columns, F.coalesce(F.flatten(F.transform(F.col(steps[6]), against)), none).alias(name))


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """All columns of docs, then n_matches long, licences string (names sorted, comma-joined), best_licence string and best_dice double."""
    docs = docs.drop("n_matches", "licences", "best_licence", "best_dice")
    found = free_name(docs.columns, "matches")
    m = with_matches(docs, found, templates, least)
    best = F.array_sort(F.transform(found, lambda x: F.struct((-x["dice"]).alias("worse"), x["name"].alias("name"), x["dice"].alias("dice"))))
    first = F.get(best, F.lit(0))
    return m.select(
        *docs.columns, F.size(found).cast("long").alias("n_matches"), F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda x: x["name"])))).alias("licences"),
        first["name"].alias("best_licence"), F.coalesce(first["dice"], F.lit(0.0)).alias("best_dice"),
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WORDS = "list_filter(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH t0(name, body) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(b)})" for n, b in TEMPLATES)}),
t1 AS (SELECT name, row_number() OVER () AS k, {_WORDS.format("body")} AS w FROM t0),
t AS (SELECT name, k, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM t1),
u9 AS (
  SELECT doc_id, x, list_concat(string_split(x, chr(10)), list_filter(string_split_regex(x, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10)))) AS blocks
  FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents)
),
u0 AS (
  SELECT doc_id, unnest(list_distinct(list_concat(blocks, flatten(list_transform(blocks, lambda k: string_split_regex(k, '[.!?][ \\t\\r\\n]+'))), [x]))) AS u FROM u9
),
u1 AS (SELECT doc_id, {_WORDS.format("u")} AS w FROM u0),
u AS (SELECT DISTINCT doc_id, list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS b FROM u1 WHERE len(w) >= 2),
m AS (
  SELECT doc_id, name, round(2.0::DOUBLE * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)), 6) AS dice
  FROM u JOIN t ON list_has_any(u.b, t.b)
),
g AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS best FROM m WHERE dice >= {LEAST} GROUP BY doc_id
),
f AS (SELECT m.doc_id, min(name) AS name FROM m JOIN g ON m.doc_id = g.doc_id AND m.dice = g.best GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(names, '') AS licences, f.name AS best_licence, coalesce(best, 0.0)::DOUBLE AS best_dice
FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN f USING (doc_id)
"""
