"""License scans: whole texts against licence notices and passages by the Dice coefficient over word bigrams.

Normalised, a text is its lower-case runs of letters and digits; its bigrams are pairs of neighbours.
`scan_texts` compares every window of the text with every template: with b distinct bigrams in the
template, only windows of at most b * (2 - t) / t bigrams that share at least b * t / (2 - t) of them
can reach the coefficient t. The best window starts and ends at a bigram of the template. A place
starts windows only if that many bigrams of the template follow within the size bound, so most texts
are done after one look-up per bigram. From such a place one pass over the window gives the coefficient
at every end: a bigram is new to a window if its last place before lies ahead of the window's start.
The work is linear in the text, and exact. Texts without one of the templates' anchor words are left
out before bigrams are made; enough bigrams of every template touch one, so no match is lost.

`scan` compares lines and sentences only.

All work is within the row: no shuffle, no join. Null and empty texts, and texts of one word, have no
match. Ties go to the template that comes first. Repeated rows each get their result. Extra columns
stay; those named like a column of the result are replaced by it. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.basics import bound

THRESHOLD = 0.8
#: Notices as projects commonly write them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

_AS_IS = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
#: Licence texts and headers that run over many lines; long licences by their openings and grants.
FULL_TEXTS: tuple[tuple[str, str], ...] = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("Apache-2.0", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. Licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the License."),
    ("Apache-2.0", "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users."),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software. Contributor Version means the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)


def bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def anchors(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which a unit must hold one to reach the threshold with any template; chosen greedily."""
    chosen: list[str] = []
    for _, text in templates:
        left = bigrams(text)
        spare = ceil(len(left) * threshold / (2 - threshold) - 1e-9) - 1  # so many bigrams may lie beside the anchors
        left = [g for g in left if not set(g.split()) & set(chosen)]
        while len(left) > spare:
            touched = {w: sum(w in g.split() for g in left) for g in left for w in g.split() if len(w) > 1}
            word = max(touched, key=lambda w: (touched[w] * min(len(w), 8) ** 2, w))  # long words are rare ones
            chosen.append(word)
            left = [g for g in left if word not in g.split()]
    return chosen


def units(text: Column) -> Column:
    """Lines, and sentences of lines."""
    sentences = F.split(F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\n"), "\n")
    return F.array_distinct(F.concat(F.split(text, "\n"), sentences))


def normal(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))


def unit_bigrams(unit: Column) -> Column:
    def made(words: Column) -> Column:
        return F.when(F.size(words) > 1, F.array_distinct(F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))))).otherwise(F.array().cast("array<string>"))

    return bound(F.split(normal(unit), " "), made)


def best_template(unit: Column, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Struct (dice, place, license) of the best template within the size bounds that reaches the threshold, or null."""
    known = F.array(*(F.struct(F.lit(-k).alias("place"), F.lit(name).alias("license"), F.array(*map(F.lit, grams)).alias("grams")) for k, (name, grams) in enumerate((n, bigrams(t)) for n, t in templates)))
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9

    def scored(own: Column) -> Column:
        a = F.size(own)
        near = F.filter(known, lambda t: F.size(t["grams"]).between(a * low, a * high))
        made = F.transform(near, lambda t: F.struct((2.0 * F.size(F.array_intersect(own, t["grams"])) / (a + F.size(t["grams"]))).alias("dice"), t["place"].alias("place"), t["license"].alias("license")))
        return F.array_max(F.filter(made, lambda m: m["dice"] >= threshold))

    return bound(unit_bigrams(unit), scored)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_matches (units that match), license and dice of the best match (null without one), licenses (all found, sorted)."""
    words = anchors(templates, threshold)
    text = F.coalesce(F.col("text"), F.lit(""))
    some = F.lower(text)
    hit = bound(some, lambda t: _any(t, words))
    held = F.filter(units(text), lambda u: bound(F.lower(u), lambda x: _any(x, words)))
    matches = F.filter(F.transform(held, lambda u: best_template(u, templates, threshold)), lambda m: m.isNotNull())
    empty = F.array().cast("array<struct<dice:double,place:int,license:string>>")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_matches", "license", "dice", "licenses")]
    found = docs.select(*kept, F.when(hit, matches).otherwise(empty).alias("_license_matches"))
    top = F.array_max("_license_matches")
    return found.select(
        *kept,
        F.size("_license_matches").cast("long").alias("n_matches"),
        top["license"].alias("license"),
        top["dice"].alias("dice"),
        F.array_sort(F.array_distinct(F.transform("_license_matches", lambda m: m["license"]))).alias("licenses"),
    )


def _reach(template: list[str], threshold: float) -> tuple[int, int]:
    """The least number of shared bigrams and the longest window by which a template can reach the threshold."""
    b = len(template)
    return ceil(b * threshold / (2 - threshold) - 1e-9), int(b * (2 - threshold) / threshold + 1e-9)


def _among(name: str, grams: list[str]) -> str:
    """SQL for membership in a list of bigrams, which hold only letters, digits and spaces; parsed at once, not one call each."""
    return f"{name} in ({', '.join(map(repr, grams))})"


def _starts(template: list[str], threshold: float) -> Column:
    """Places of a template's bigrams that enough others follow within the longest window."""
    need, span = _reach(template, threshold)
    own = f"transform(filter(_hits, h -> {_among('h.gram', template)}), h -> h.at)"
    return F.expr(f"get(transform(array({own}), own -> filter(own, (at, j) -> get(own, j + {need - 1}) - at < {span})), 0)")


def _before(grams: Column) -> Column:
    """For every bigram the place of the same bigram before it, -1 for none: neighbours after a sort."""

    def found(ordered: Column) -> Column:
        def last(g: Column, i: Column) -> Column:
            prior = F.get(ordered, i - 1)
            return F.struct(g["at"].alias("at"), F.when(prior["gram"] == g["gram"], prior["at"]).otherwise(-1).alias("before"))

        return F.transform(F.array_sort(F.transform(ordered, last)), lambda g: g["before"])

    return bound(F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at")))), found)


def _window_dice(k: int, template: list[str], threshold: float) -> Column:
    """Best coefficient of the windows that begin at the starts of template k, null below the threshold."""
    b, (_, span) = len(template), _reach(template, threshold)
    new = "if(g.before < s, 1, 0)"
    step = f"""struct(
        acc.own + {new} as own,
        acc.shared + if(g.held, {new}, 0) as shared,
        if(g.held, greatest(acc.best, 2D * (acc.shared + {new}) / (acc.own + {new} + {b})), acc.best) as best)"""
    from_start = f"aggregate(slice(marked, s + 1, {span}), struct(0 as own, 0 as shared, 0D as best), (acc, g) -> {step}, acc -> acc.best)"
    best = f"array_max(filter(transform(get(_starts, {k}), s -> {from_start}), d -> d >= {threshold}D))"
    marks = f"transform(_grams, (g, i) -> struct(get(_before, i) as before, {_among('g', template)} as held))"
    return F.expr(f"if(size(get(_starts, {k})) > 0, get(transform(array({marks}), marked -> {best}), 0), null)")


def scan_texts(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES + FULL_TEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_matches (templates that some window matches), license and dice of the best window (null without one), licenses (all found, sorted).

    Notices may be wrapped over lines or stand within longer sentences.
    """
    known = [bigrams(t) for _, t in templates]
    words = anchors(templates, threshold)
    some = list(dict.fromkeys(g for grams in known for g in grams))
    no_grams, no_match = F.array().cast("array<string>"), F.array().cast("array<struct<dice:double,place:int,license:string>>")

    def pairs(words: Column) -> Column:
        return F.when(F.size(words) > 1, F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))).otherwise(no_grams)

    def grams(text: Column) -> Column:
        return F.when(_any(text, words), bound(F.split(normal(text), " "), pairs)).otherwise(no_grams)

    # One projection per step: each is read several times by the next, so none is computed twice.
    kept = [c for c in docs.columns if c.lower() not in ("n_matches", "license", "dice", "licenses")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), bound(F.lower(F.coalesce(F.col("text"), F.lit(""))), grams).alias("_grams"))
    hits = rows.withColumn("_hits", F.expr(f"filter(transform(_grams, (g, i) -> struct(g as gram, i as at)), h -> {_among('h.gram', some)})"))
    begun = hits.select("_row", "_grams", F.array(*(_starts(own, threshold) for own in known)).alias("_starts"))
    begins = F.exists("_starts", lambda s: F.size(s) > 0)
    placed = begun.withColumns({"_before": F.when(begins, _before(F.col("_grams"))), "_any": begins})
    made = (
        F.struct(_window_dice(k, own, threshold).alias("dice"), F.lit(-k).alias("place"), F.lit(name).alias("license"))
        for k, (own, (name, _)) in enumerate(zip(known, templates))
    )
    out = placed.select("_row", F.when(F.col("_any"), F.filter(F.array(*made), lambda m: m["dice"].isNotNull())).otherwise(no_match).alias("_found"))
    top = F.array_max("_found")
    return out.select(
        *(F.col("_row")[c].alias(c) for c in kept),
        F.size("_found").cast("long").alias("n_matches"),
        top["license"].alias("license"),
        top["dice"].alias("dice"),
        F.array_sort(F.array_distinct(F.transform("_found", lambda m: m["license"]))).alias("licenses"),
    )


def _any(text: Column, words: list[str]) -> Column:
    """Whether lower-case text holds one of the words; short ones as whole words, else they are in too many texts."""
    hit = F.lit(False)
    for w in words:
        alone = rf"{w}(?![\p{{L}}\p{{N}}])(?<![\p{{L}}\p{{N}}]{w})"
        hit = hit | (F.contains(text, F.lit(w)) if len(w) > 3 else F.rlike(text, F.lit(alone)))
    return hit
