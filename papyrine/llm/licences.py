"""Licence scans: texts compared with licence templates by the Dice coefficient of their word bigrams.

Texts are normalised (lower case, everything but letters a-z, digits and line breaks a blank). Every line and every block
between blank lines is a unit. A unit of n and a template of m bigrams can reach a coefficient of s only if n lies between
s/(2-s) and (2-s)/s times m: other templates are never compared. All of it is column expressions within the row.

Licences that span lines or blocks, or stand inside a paragraph, are found as runs of neighbouring segments (lines, cut again
where a sentence ends). Of runs that overlap only the best one counts. Three bounds, none of which loses a run that counts,
keep them few: a text without a template's rarer words cannot share enough with it; a first or last segment that shares less
than half the threshold is better left out; and a run shares at most what its segments do, each with its seam to the next.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Coefficient from which a unit is taken for a licence.
THRESHOLD = 0.8

#: Notices and short licences in their published wording.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "cc0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "bsd-line": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
}


def template_bigrams(text: str) -> list[str]:
    """Word bigrams, the k-th of its kind marked with k: as sets, such lists meet as often as bags would."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    seen: Counter = Counter()
    out = []
    for pair in map(" ".join, zip(words, words[1:], strict=False)):
        seen[pair] += 1
        out.append(f"{pair} {seen[pair]}")
    return out


def size_bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach the threshold with a template of ``size``."""
    fits = [n for n in range(1, 2 * int(size / threshold) + 2) if 2 * min(n, size) >= threshold * (n + size)]
    return fits[0], fits[-1]


def gate_words(own: list[str], threshold: float = THRESHOLD) -> set[str]:
    """Words of which a text must hold one to reach the threshold with a template of the bigrams ``own``, long ones first."""
    pairs = [set(pair.split()[:2]) for pair in own]
    # Bigrams without any of the words are too few: the fewest that can do are threshold / (2 - threshold) of the template.
    few = threshold / (2 - threshold) * len(pairs) - 1e-9
    words: set[str] = set()
    while len(left := [pair for pair in pairs if not pair & words]) >= few:
        free = Counter(w for pair in left for w in pair)
        words.add(max(free, key=lambda w: (len(w) >= 6, free[w], len(w), w)))
    return words


def plain(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^A-Za-z0-9\n]+", " "))


def units(text: Column) -> Column:
    """Every line and block of a plain text, each once."""
    lines = F.split(text, "\n")
    blocks = F.transform(F.split(text, "\n *\n[ \n]*"), lambda b: F.replace(b, F.lit("\n"), F.lit(" ")))
    return F.array_distinct(F.transform(F.concat(lines, blocks), lambda u: F.trim(F.regexp_replace(u, " +", " "))))


def segments(text: Column) -> Column:
    """The words of every line and sentence of a text as it came, in order; those without words are left out."""
    lines = F.split(plain(F.regexp_replace(text, r"[.!?:;][\"')\]]*\s", "\n")), "\n")
    return F.filter(F.transform(lines, lambda s: F.split(F.trim(s), " ")), lambda w: F.get(w, F.lit(0)) != "")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: written out, a lambda would compute it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bigrams(words: Column) -> Column:
    pairs = F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat(F.get(words, i), F.lit(" "), w),
    )

    def numbered(own: Column) -> Column:
        def nth(p: Column, i: Column) -> Column:
            return F.concat(p, F.lit(" "), F.size(F.filter(F.slice(own, 1, i + 1), lambda q: q == p)).cast("string"))

        all_once = F.size(F.array_distinct(own)) == F.size(own)
        return F.when(all_once, F.transform(own, lambda p: F.concat(p, F.lit(" 1")))).otherwise(F.transform(own, nth))

    return _bound(pairs, numbered)


def _step(df: DataFrame, *kept: str, **made: Column) -> DataFrame:
    """doc_id, the columns ``kept`` and new ones, computed once: a generator stands between them and what reads them."""
    new = F.struct(*[value.alias(name) for name, value in made.items()])
    return df.select("doc_id", *kept, F.inline(F.array(new)))


#: Elements that one step of a running value copies at most: long texts cost linear time.
RUN_BLOCK = 256


def running(items: Column, zero: Column, add: Callable[[Column, Column], Column], kind: str) -> Column:
    """The folded value after each element of a column's array, of the SQL type ``kind``; arrays grow block by block."""

    def of_block(done: Column, at: Column) -> Column:
        def one(d: Column, item: Column) -> Column:
            return _bound(
                add(d["last"], item),
                lambda v: F.struct(v.alias("last"), F.concat(d["part"], F.array(v)).alias("part")),
            )

        none = F.struct(done["last"].alias("last"), F.array().cast(f"array<{kind}>").alias("part"))
        block = F.aggregate(F.slice(items, at + 1, F.lit(RUN_BLOCK)), none, one)
        return _bound(
            block,
            lambda d: F.struct(d["last"].alias("last"), F.concat(done["parts"], F.array(d["part"])).alias("parts")),
        )

    none = F.struct(zero.cast(kind).alias("last"), F.array().cast(f"array<array<{kind}>>").alias("parts"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(RUN_BLOCK))
    return F.aggregate(starts, none, of_block, lambda done: F.flatten(done["parts"]))


def near_gates(segs: Column, ahead: Column, back: Column, most: int) -> Column:
    """Of the segments from which a run of at most ``most`` + 1 words reaches one with a gate word: number, words before it and
    with it, its words and the word after it. ``ahead`` and ``back`` hold the words since the last such segment."""

    def one(seg: Column, i: Column) -> Column:
        stop = F.get(ahead, i)["stop"]
        return F.struct(
            i.alias("at"),
            (stop - F.size(seg["words"])).alias("start"),
            stop.alias("stop"),
            seg["words"].alias("words"),
            F.get(F.get(segs, i + 1)["words"], F.lit(0)).alias("after"),
            F.least(F.get(ahead, i)["since"], F.get(back, F.size(segs) - 1 - i)).alias("far"),
        )

    return F.filter(F.transform(segs, one), lambda s: s["far"] <= most)


def placed(hits: Column, upto: Column) -> Column:
    """Of each segment its number, the words before it and with it, the hits before it and with it, and its most hits."""
    return F.transform(
        hits,
        lambda h, i: F.struct(
            h["at"].alias("at"),
            h["start"].alias("start"),
            h["stop"].alias("stop"),
            F.zip_with(F.get(upto, i), h["own"], lambda a, b: a - b).alias("before"),
            F.get(upto, i).alias("upto"),
            F.array_max(h["own"]).alias("most"),
        ),
    )


def spans(places: Column, table: Column, most: int, threshold: float) -> Column:
    """first, last (numbers of segments) of the runs that can match a template and cannot be bettered by leaving out an end,
    an array for every first segment."""

    def from_first(edges: Column, first: Column, k: Column) -> Column:
        def can(last: Column) -> Column:
            n = last["stop"] - first["start"] - 1

            def fits(t: Column, i: Column) -> Column:
                shared = F.get(last["upto"], i) - F.get(first["before"], i)
                return n.between(t["least"], t["most"]) & (shared * 2 >= (n + F.size(t["own"])) * threshold - 1e-9)

            return F.exists(F.transform(table, fits), lambda fit: fit)

        # Every segment holds a word: a run of most + 1 words has no more segments.
        later = F.filter(F.slice(edges, k + 1, F.lit(most + 1)), lambda e: e["stop"] - first["start"] - 1 <= most)
        found = F.transform(
            F.filter(later, can), lambda last: F.struct(first["at"].alias("first"), last["at"].alias("last"))
        )
        return F.when(shares(first, 0), found).otherwise(F.array().cast("array<struct<first: int, last: int>>"))

    def shares(p: Column, seam: int) -> Column:
        return p["most"] + seam >= (p["stop"] - p["start"]) * (threshold / 2) - 1e-9

    own = F.filter(places, lambda p: shares(p, 1))  # of a last segment the seam before it counts, not that to the next
    starts = _bound(own, lambda edges: F.transform(edges, lambda first, k: from_first(edges, first, k)))
    return F.filter(starts, lambda found: F.size(found) > 0)


def outstanding(starts: Column) -> Column:
    """Of runs (first, last, best; an array per first segment, in order) those that no overlapping run betters: by
    coefficient, then the shorter, then the first. A run is held against those that begin within a run's length."""

    def betters(other: Column, run: Column) -> Column:
        overlap = (other["first"] <= run["last"]) & (run["first"] <= other["last"])
        a, b = [F.struct(r["best"]["dice"], -r["best"]["unit_bigrams"], -r["first"], -r["last"]) for r in (other, run)]
        return overlap & (a > b)

    def of_first(runs: Column, k: Column, reach: Column) -> Column:
        around = F.slice(starts, F.greatest(k + 1 - reach, F.lit(1)), 2 * reach + 1)
        return _bound(
            F.flatten(around), lambda others: F.filter(runs, lambda run: ~F.exists(others, lambda o: betters(o, run)))
        )

    longest = F.array_max(F.transform(F.flatten(starts), lambda r: r["last"] - r["first"]))
    kept = _bound(F.coalesce(longest, F.lit(0)), lambda reach: F.transform(starts, lambda r, k: of_first(r, k, reach)))
    return F.flatten(kept)


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_units, licence, dice, shared, unit_bigrams, template_bigrams for every row.

    The best match (largest coefficient, then the template's name) and the number of units that match some template: lines,
    blocks, and runs of segments that are neither of them and better than every line, block or run that overlaps them;
    without a match n_units is 0 and the rest null. Null texts hold no units, a unit of one word no bigrams. Repeated rows
    and null ids are rows like any other; nothing is shuffled.
    """
    known = {name: template_bigrams(text) for name, text in templates.items()}
    bounds = {name: size_bounds(len(own), threshold) for name, own in known.items()}
    least, most = min(a for a, _ in bounds.values()), max(b for _, b in bounds.values())
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.array(*map(F.lit, own)).alias("own"),
                F.lit(bounds[name][0]).alias("least"),
                F.lit(bounds[name][1]).alias("most"),
            )
            for name, own in sorted(known.items())
        ]
    )
    every = sorted({pair for own in known.values() for pair in own})
    gates = sorted(set().union(*[gate_words(own, threshold) for own in known.values()]))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    # A text without a gate word holds no match at all, nor does a line, block or run without one.
    gate = rf"(?i)(?<![A-Za-z0-9])(?:{'|'.join(gates)})(?![A-Za-z0-9])"
    rows = _step(rows, text=F.when(F.col("text").rlike(gate), F.col("text")).otherwise(""))
    rows = _step(rows, "text", plain=plain(F.col("text")))

    def holds_gate(words: Column) -> Column:
        return F.exists(words, lambda w: w.isin(gates))

    def may_match(unit: Column) -> Column:
        return _bound(F.split(unit, " "), lambda w: (F.size(w) - 1).between(least, most) & holds_gate(w))

    marked = F.transform(segments(F.col("text")), lambda w: F.struct(w.alias("words"), holds_gate(w).alias("gated")))
    rows = _step(rows, units=F.filter(units(F.col("plain")), may_match), segs=marked)

    def since(far: Column, seg: Column) -> Column:
        return F.when(seg["gated"], 0).otherwise(F.least(far + F.size(seg["words"]), F.lit(most + 1)))

    def add(done: Column, seg: Column) -> Column:
        stop = done["stop"] + F.size(seg["words"])
        return F.struct(stop.alias("stop"), since(done["since"], seg).alias("since"))

    none = F.struct(F.lit(0).alias("stop"), F.lit(most + 1).alias("since"))
    ahead = running(F.col("segs"), none, add, "struct<stop: int, since: int>")
    rows = _step(rows, "units", "segs", turned=F.reverse("segs"), ahead=ahead)
    rows = _step(rows, "units", "segs", "ahead", back=running(F.col("turned"), F.lit(most + 1), since, "int"))
    rows = _step(rows, "units", "segs", near=near_gates(F.col("segs"), F.col("ahead"), F.col("back"), most))
    no_hits = F.array_repeat(F.lit(0), len(known))

    def with_hits(s: Column) -> Column:
        words = F.when(s["after"].isNull(), s["words"]).otherwise(F.concat(s["words"], F.array(s["after"])))
        own = _bound(
            F.filter(bigrams(words), lambda p: p.isin(every)),
            lambda seen: F.when(F.size(seen) == 0, no_hits).otherwise(
                F.transform(table, lambda t: F.size(F.array_intersect(t["own"], seen)))
            ),
        )
        return F.struct(s["at"].alias("at"), s["start"].alias("start"), s["stop"].alias("stop"), own.alias("own"))

    rows = _step(rows, "units", "segs", hits=F.transform("near", with_hits))
    upto = running(
        F.col("hits"), no_hits, lambda done, h: F.zip_with(done, h["own"], lambda a, b: a + b), "array<int>"
    )
    rows = _step(rows, "units", "segs", "hits", upto=upto)
    rows = _step(rows, "units", "segs", places=placed(F.col("hits"), F.col("upto")))
    rows = _step(rows, "units", "segs", spans=spans(F.col("places"), table, most, threshold))

    def compared(unit: Column) -> Column:
        n = F.size(unit)
        fitting = F.filter(table, lambda t: n.between(t["least"], t["most"]))

        def one(t: Column) -> Column:
            return _bound(F.size(F.array_intersect(unit, t["own"])), lambda shared: F.struct(
                (F.lit(2.0) * shared / (n + F.size(t["own"]))).alias("dice"),
                t["name"].alias("licence"),
                shared.cast("long").alias("shared"),
                n.cast("long").alias("unit_bigrams"),
                F.size(t["own"]).cast("long").alias("template_bigrams"),
            ))

        return F.filter(F.transform(fitting, one), lambda m: m["dice"] >= threshold)

    def best(matches: Column) -> Column:
        return F.array_sort(
            matches,
            lambda a, b: F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1))
            .when(a["licence"] != b["licence"], F.when(a["licence"] < b["licence"], -1).otherwise(1))
            .when(a["unit_bigrams"] != b["unit_bigrams"], F.when(a["unit_bigrams"] < b["unit_bigrams"], -1).otherwise(1))
            .otherwise(0),
        )

    def of_words(words: Column) -> Column:
        return _bound(bigrams(words), compared)

    def run(span: Column) -> Column:
        own = F.transform(F.slice("segs", span["first"] + 1, span["last"] - span["first"] + 1), lambda g: g["words"])
        return _bound(
            F.flatten(own),
            lambda words: F.struct(
                span["first"].alias("first"),
                span["last"].alias("last"),
                F.array_join(words, " ").alias("unit"),
                F.get(best(of_words(words)), F.lit(0)).alias("best"),
            ),
        )

    def matching(found: Column) -> Column:
        return F.filter(F.transform(found, run), lambda r: r["best"].isNotNull())

    runs = F.filter(F.transform("spans", matching), lambda found: F.size(found) > 0)
    rows = _step(rows, "units", runs=runs)
    # Lines and blocks are among the runs, so as to better others; a unit counts once, whatever it was found as.
    rows = _step(rows, units=F.array_union("units", F.transform(outstanding(F.col("runs")), lambda r: r["unit"])))
    matches = F.transform("units", lambda u: of_words(F.split(u, " ")))
    matched = _step(rows, matches=F.filter(matches, lambda m: F.size(m) > 0))
    better = best(F.flatten("matches"))
    found = F.struct(F.size("matches").cast("long").alias("n_units"), F.get(better, F.lit(0)).alias("best"))
    fields = ["licence", "dice", "shared", "unit_bigrams", "template_bigrams"]
    return _step(matched, found=found).select("doc_id", "found.n_units", *[f"found.best.{f}" for f in fields])


def scan_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan of ``documents`` in DuckDB's SQL: all runs of the texts with a gate word, and joins within the text."""
    known = {n: template_bigrams(t) for n, t in templates.items()}
    rows = ", ".join(f"('{n}', {own!r}::varchar[])" for n, own in known.items())
    bounds = [size_bounds(len(own), threshold) for own in known.values()]
    least, most = min(a for a, _ in bounds), max(b for _, b in bounds)
    gates = sorted(set().union(*[gate_words(own, threshold) for own in known.values()]))
    return f"""
with template(licence, own) as (values {rows}),
plain as (
  select doc_id, lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\\n]+', ' ', 'g')) as t
  from documents),
line as (
  select distinct doc_id, string_split(trim(regexp_replace(u, ' +', ' ', 'g'), ' '), ' ') as w
  from (select doc_id, unnest(list_concat(string_split(t, chr(10)),
          list_transform(string_split_regex(t, '\\n *\\n[ \\n]*'), lambda b: replace(b, chr(10), ' ')))) as u from plain)),
cut as (
  select doc_id, list_filter(list_transform(string_split(lower(regexp_replace(regexp_replace(coalesce(text, ''),
    '[.!?:;]["'')\\]]*[\\x20\\x09-\\x0D]', chr(10), 'g'), '[^A-Za-z0-9\\n]+', ' ', 'g')), chr(10)),
    lambda s: string_split(trim(s, ' '), ' ')), lambda w: w[1] <> '') as s
  from documents),
first as (
  select doc_id, s, unnest(range(1, len(s) + 1)) as a from cut where list_has_any(flatten(s), {gates!r}::varchar[])),
ends as (select doc_id, s, a, unnest(range(a, least(len(s), a + {most}) + 1)) as b from first),
run as (
  select doc_id, a, b, flatten(s[a:b]) as w from ends
  where len(flatten(s[a:b])) - 1 between {least} and {most} and list_has_any(flatten(s[a:b]), {gates!r}::varchar[])),
unit as (
  select distinct doc_id, w from (select doc_id, w from line union all select doc_id, w from run)
  where len(w) - 1 between {least} and {most}),
pairs as (
  select doc_id, w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as p from unit),
made as (
  select doc_id, w, list_transform(range(1, len(p) + 1),
    lambda i: p[i] || ' ' || len(list_filter(p[1:i], lambda q: q = p[i]))::varchar) as own
  from pairs),
matched as (
  select doc_id, w, licence, len(list_intersect(made.own, template.own)) as shared,
    len(made.own) as unit_bigrams, len(template.own) as template_bigrams,
    2.0::double * shared / (unit_bigrams + template_bigrams) as dice
  from made, template
  where 2.0::double * least(unit_bigrams, template_bigrams) / (unit_bigrams + template_bigrams) >= {threshold}
    and 2.0::double * len(list_intersect(made.own, template.own)) / (len(made.own) + len(template.own)) >= {threshold}),
run_dice as (
  select r.doc_id, a, b, r.w, max(dice) as dice, len(r.w) as n
  from run r join matched m on r.doc_id = m.doc_id and r.w = m.w group by r.doc_id, a, b, r.w),
standing as (
  select distinct doc_id, w from run_dice r where not exists (
    select 1 from run_dice o where o.doc_id = r.doc_id and o.a <= r.b and r.a <= o.b
      and (o.dice, -o.n, -o.a, -o.b) > (r.dice, -r.n, -r.a, -r.b))),
counted as (
  select m.* from matched m semi join (select doc_id, w from line union select doc_id, w from standing) k
    on m.doc_id = k.doc_id and m.w = k.w),
best as (
  select doc_id, count(distinct w) as n_units,
    first(struct_pack(licence := licence, dice := dice, shared := shared, unit_bigrams := unit_bigrams,
      template_bigrams := template_bigrams) order by dice desc, licence, unit_bigrams) as b
  from counted group by doc_id)
select d.doc_id, coalesce(n_units, 0) as n_units, b.licence as licence, b.dice as dice, b.shared::bigint as shared,
  b.unit_bigrams::bigint as unit_bigrams, b.template_bigrams::bigint as template_bigrams
from documents d left join best using (doc_id)"""
