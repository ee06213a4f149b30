"""License scans in DataFrame functions alone.

A text's units are the text itself, its paragraphs (parted by blank lines), its lines, and for every template all windows of as many words
as it has, so that a notice is found within a longer line and when it is wrapped within a longer paragraph. Units are normalised (A-Z lower-cased,
every run of other characters than a-z and 0-9 made one blank) and compared to every template by the Dice coefficient over their sets of
word bigrams (a single word counts as a bigram with nothing; a template of one word has no windows). Bounds prune, none of which changes the result:
Dice can reach `threshold` only if the sets' sizes differ by at most a factor (2 - threshold) / threshold, and only if a share of
threshold / (2 - threshold) of the template's bigrams is met. A unit is a run of the text's words, so a text that meets fewer of a template's
bigrams as a whole has no unit like it; and a window is compared only where that many bigrams of the template stand within its length.

Defined cases: null and empty texts, and texts without a unit like a template, have licenses, license and widest null and dice 0; equal coefficients
go to the alphabetically first license; repeated rows get equal results; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
# Short public notices, standard headers and texts of common licenses.
TEMPLATES = {
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
    "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations "
    "under the License.",
    "bsd-2-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsd-3-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission. "
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and "
    "this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
    "Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
    "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))


def _words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.translate({c: c + 32 for c in range(65, 91)})).split()


def _bigrams_of(text: str) -> list[str]:
    words = _words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or {f"{w} " for w in words})


def bigrams(words: Column) -> Column:
    """The bigrams of an array of words in order, repeats included."""
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, pairs).otherwise(F.array(F.concat(words[0], F.lit(" "))))


def units(text: Column) -> Column:
    return F.array_distinct(F.concat(F.array(text), F.split(text, "\\n[ \\t\\r]*\\n"), F.split(text, "\\n")))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _listed(grams: list[str]) -> Column:
    """Bigrams as a constant array, in one literal (a literal of each would cost a call to the JVM)."""
    return F.split(F.lit("\n".join(grams)), "\n")


class _Template:
    """A template with its distinct bigrams, its length in words and the bounds that follow from the threshold."""

    def __init__(self, name: str, text: str, threshold: float) -> None:
        self.name, self.grams, self.n_words = name, _bigrams_of(text), len(_words_of(text))
        factor = (2 - threshold) / threshold
        self.least, self.most = math.ceil(len(self.grams) / factor - 1e-9), math.floor(len(self.grams) * factor + 1e-9)
        self.met = max(1, self.least)

    def shared(self, grams: Column) -> Column:
        return F.size(F.array_intersect(grams, _listed(self.grams)))

    def score(self, unit: Column) -> Column:
        """dice, license and shared bigrams of a unit's distinct bigrams."""
        return _bound(self.shared(unit), lambda n: F.struct((2.0 * n / (F.size(unit) + len(self.grams))).alias("dice"), F.lit(self.name).alias("license"), n.alias("shared")))

    def windows(self, grams: Column) -> Column:
        """The scores of all windows with enough of the template's bigrams, given the text's bigrams in order."""
        width = self.n_words - 1

        def starts(hits: Column) -> Column:
            runs = F.transform(hits, lambda first, k: F.struct(first.alias("first"), F.get(hits, k + (self.met - 1)).alias("last")))
            close = F.filter(runs, lambda r: r.last - r.first < width)
            return F.array_distinct(F.flatten(F.transform(close, lambda r: F.sequence(F.greatest(F.lit(1), r.last - (width - 1)), F.least(r.first, F.size(grams) - (width - 1))))))

        places = F.transform(grams, lambda g, k: F.when(g.isin(self.grams), k + 1))
        found = _bound(F.filter(places, F.isnotnull), starts)
        return F.transform(found, lambda s: _bound(F.array_distinct(F.slice(grams, s, width)), self.score))


_SCORES = "array<struct<dice: double, license: string, shared: int>>"


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license and dice of the best unit of every row; n_units, the distinct texts, paragraphs and lines that reach the threshold; licenses, all
    whose template a unit reaches, by name with commas; widest, the one of these that shares the most bigrams (then the highest coefficient, then by name)."""
    known = [t for name, body in sorted(templates.items()) if (t := _Template(name, body, threshold)).grams]
    every = sorted({g for t in known for g in t.grams})
    none = F.array().cast(_SCORES)

    worded = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).select("doc_id", "text", F.split(normalised(F.col("text")), " ").alias("words"))
    # A unit of one word has a bigram of its own, which the text as a whole has not.
    alone = F.transform("words", lambda w: F.concat(w, F.lit(" "))) if any(t.n_words == 1 for t in known) else F.array().cast("array<string>")
    paired = worded.select("doc_id", "text", bigrams(F.col("words")).alias("grams"), alone.alias("alone"))
    met = paired.select("doc_id", "text", "grams", F.array_intersect(F.concat("grams", "alone"), _listed(every)).alias("met"))
    names = F.array(*[F.when(t.shared(F.col("met")) >= t.met, F.lit(t.name)) for t in known]).cast("array<string>")
    likely = met.select("doc_id", "text", "grams", F.when(F.size("met") > 0, F.filter(names, F.isnotnull)).otherwise(F.array().cast("array<string>")).alias("likely"))

    def like(t: _Template) -> Column:
        return F.array_contains("likely", t.name)

    def reaching(scores: Column) -> Column:
        return F.filter(scores, lambda x: x.dice >= threshold)

    def of_unit(unit: Column) -> Column:
        return reaching(F.array(*[F.when(like(t) & F.size(unit).between(t.least, t.most), t.score(unit)) for t in known]).cast(_SCORES))

    parts = F.filter(F.array_distinct(F.transform(units(F.col("text")), normalised)), lambda u: u != "")
    by_unit = F.filter(F.transform(parts, lambda u: _bound(F.array_distinct(bigrams(F.split(u, " "))), of_unit)), lambda scores: F.size(scores) > 0)

    by_window = [F.when(like(t) & (F.size("grams") >= t.n_words - 1), reaching(t.windows(F.col("grams")))).otherwise(none) for t in known if t.n_words > 1]
    any_likely = F.size("likely") > 0
    scored = likely.select(
        "doc_id", F.when(any_likely, by_unit).otherwise(F.array().cast(f"array<{_SCORES}>")).alias("by_unit"), F.when(any_likely, F.concat(none, *by_window)).otherwise(none).alias("by_window")
    )
    found = scored.select("doc_id", F.size("by_unit").cast("long").alias("n_units"), F.concat(F.flatten("by_unit"), "by_window").alias("found"))
    top = F.array_min(F.transform("found", lambda x: F.struct((-x.dice).alias("less"), x.license.alias("license"))))
    widest = F.array_min(F.transform("found", lambda x: F.struct((-x.shared).alias("fewer"), (-x.dice).alias("less"), x.license.alias("license"))))
    best = found.select("doc_id", top.alias("top"), "n_units", F.array_sort(F.array_distinct(F.transform("found", lambda x: x.license))).alias("all"), widest.alias("widest"))
    return best.select(
        "doc_id", F.col("top.license").alias("license"), F.coalesce(-F.col("top.less"), F.lit(0.0)).alias("dice"), "n_units",
        F.when(F.size("all") > 0, F.array_join("all", ",")).alias("licenses"), F.col("widest.license").alias("widest"),
    )


def oracle_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan for DuckDB: every unit against every template, and every window of the texts that meet the template's share of bigrams."""
    rows = ", ".join(f"('{name}', {len(_words_of(t))}, [{', '.join(repr(g) for g in _bigrams_of(t))}])" for name, t in sorted(templates.items()))
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    pairs = "CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [w[1] || ' '] END"
    score = "2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice, len(list_intersect(g, grams)) AS shared"
    return f"""
    WITH templates(license, n, grams) AS (VALUES {rows}),
    docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    units AS (
        SELECT DISTINCT r, trim(regexp_replace({lower.format('u')}, '[^a-z0-9]+', ' ', 'g')) AS unit
        FROM (SELECT r, unnest(list_concat([text], regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), string_split(text, chr(10)))) AS u FROM docs)
    ),
    words AS (SELECT r, unit, string_split(unit, ' ') AS w FROM units WHERE unit <> ''),
    grams AS (SELECT r, unit, list_distinct({pairs}) AS g FROM words),
    by_unit AS (SELECT r, unit, license, {score} FROM grams, templates),
    texts AS (SELECT r, string_split(trim(regexp_replace({lower.format('text')}, '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM docs),
    ordered AS (SELECT r, {pairs} AS o FROM texts),
    likely AS (
        SELECT r, o, license, n, grams FROM ordered, templates
        WHERE n > 1 AND len(o) >= n - 1 AND len(list_intersect(list_distinct(o), grams)) >= len(grams) * {threshold} / (2 - {threshold}) - 1e-9
    ),
    places AS (SELECT r, license, n, grams, o, unnest(range(1, len(o) - n + 3)) AS s FROM likely),
    windows AS (SELECT r, license, grams, list_distinct(list_slice(o, s, s + n - 2)) AS g FROM places),
    by_window AS (SELECT r, license, {score} FROM windows),
    found AS (SELECT r, license, dice, shared FROM by_unit WHERE dice >= {threshold} UNION ALL SELECT r, license, dice, shared FROM by_window WHERE dice >= {threshold}),
    top AS (
        SELECT r, max(dice) AS dice, arg_min(license, struct_pack(d := -dice, l := license)) AS license, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
            arg_min(license, struct_pack(s := -shared, d := -dice, l := license)) AS widest
        FROM found GROUP BY r
    ),
    counted AS (SELECT r, count(DISTINCT unit) AS n FROM by_unit WHERE dice >= {threshold} GROUP BY r)
    SELECT doc_id, top.license, coalesce(top.dice, 0.0::DOUBLE) AS dice, coalesce(counted.n, 0)::BIGINT AS n_units, licenses, widest
    FROM docs LEFT JOIN top USING (r) LEFT JOIN counted USING (r)
    """
