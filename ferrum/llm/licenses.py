"""License scans: Dice coefficient over word bigrams between text units and licence templates.

Native: one projection of DataFrame functions, without a shuffle, a join or Python on the executors.

The units of a text are the text itself, its blocks (parts between blank lines) and its lines. A unit
is normalised (lower case, everything but a-z and 0-9 becomes a space) and turned into its set of word
bigrams. Pruning, none of which loses a match at ``threshold`` t:

- Dice >= t needs ``t / (2 - t)`` of the template's bigrams in the unit, so where every template has
  fewer bigrams than that without an anchor word, a unit without any anchor word cannot match. The
  templates are checked for this when the module is loaded.
- the sizes of the two sets must lie within ``t / (2 - t)`` of each other; a template outside these
  bounds is not compared.

A licence need not be exactly one such unit: it may stand in several blocks, straight above code or inside
a line. So each template is also compared with windows of the normalised words of the whole text, whatever
its line breaks. Windows are placed by hits, which are bigrams that hold an anchor word and stand once in the
template: a hit says where the template would begin and end. A window has the template's number of words, or
goes on to the least or the greatest end that the hits in reach say, as far as the size bounds allow. A start
whose hits are too few to reach ``t`` is not tried. A window that lies for more than half in that of a longer
template is part of it; a template that a unit holds is answered by the unit.

Defined results: null and empty texts and texts without a match have no licence (empty list, null best,
0.0); a tie in the best Dice goes to the template that stands first in ``TEMPLATES``; repeated rows are
answered one by one; extra columns are not looked at.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Public licence notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "gpl-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}
#: Words of which every template is full.
ANCHORS = (
    "license", "licensed", "licenses", "copyright", "permission", "permissions", "software", "warranty", "warranties",
    "gnu", "mozilla", "mpl", "cc", "mit", "public", "version", "distribute", "distributed", "redistribute", "copy", "copies",
    "free", "use", "modify", "source", "obtain", "express", "implied", "notice", "conditions", "liable", "granted",
    "liability", "merchantability", "noninfringement", "sublicense", "furnished", "limitation", "publish", "damages")


def _pairs(text: str) -> list[str]:
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def _bigrams(text: str) -> list[str]:
    return list(dict.fromkeys(_pairs(text)))


def _hits(text: str) -> list[str]:
    """The bigrams of a template in order, "" in place of those that do not tell where they stand."""
    pairs = _pairs(text)
    return [g if set(g.split()) & set(ANCHORS) and pairs.count(g) == 1 else "" for g in pairs]


def _least_hits(text: str, threshold: float) -> int:
    """Number of different hits without which no window reaches ``threshold``."""
    grams = _bigrams(text)
    others = len(grams) - sum(g != "" for g in _hits(text))
    return math.ceil(threshold / (2 - threshold) * len(grams) - 1e-9) - others


def check_anchors(threshold: float = THRESHOLD) -> None:
    """Raise unless a unit without an anchor word stays under ``threshold`` with every template."""
    for name, text in TEMPLATES.items():
        grams = _bigrams(text)
        bare = sum(not set(g.split()) & set(ANCHORS) for g in grams)
        if bare >= threshold / (2 - threshold) * len(grams):
            raise ValueError(f"{name}: {bare} of {len(grams)} bigrams have no anchor word")
        if _least_hits(text, threshold) < 1:
            raise ValueError(f"{name}: too few bigrams say where the template begins")


check_anchors()


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def _grams(words: Column) -> Column:
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))


def _distinct_grams(words: Column) -> Column:
    return F.array_distinct(_grams(words))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(words: Column, threshold: float) -> Column:
    """Structs (dice, -place, name, from, to) of the windows of a text's words that reach a template."""
    ratio = threshold / (2 - threshold)
    every = sorted({g for text in TEMPLATES.values() for g in _hits(text)} - {""})

    def against(place: int, name: str, text: str, hits: Column, grams: Column) -> Column:
        own, marks, long = _bigrams(text), _hits(text), len(_pairs(text))
        most = int(long / ratio)
        hits = F.filter(hits, lambda h: h["gram"].isin(sorted({*marks} - {""})))
        at = F.filter(F.transform(hits, lambda h: F.struct(
            h["at"].alias("at"), (h["at"] - F.array_position(F.array(*map(F.lit, marks)), h["gram"]).cast("int") + 1).alias("from"),
            h["gram"].alias("gram"))), lambda h: h["from"] <= h["at"])

        def spans(s: Column, at: Column) -> Column:
            """The windows that begin where a hit says. A text position has one hit, so those in reach are few."""
            h, before = s["from"], F.greatest(s["i"] - long, F.lit(0))
            near = F.filter(F.slice(at, before + 1, F.lit(long + most + 1)), lambda o: o["at"].between(h, h + most - 1))
            ends = lambda near: F.filter(F.transform(near, lambda o: o["from"] + long), lambda e: e.between(h + int(ratio * long), h + most))
            enough = lambda near: F.size(F.array_distinct(F.transform(near, lambda o: o["gram"]))) >= _least_hits(text, threshold)
            again = F.exists(F.slice(at, before + 1, s["i"] - before), lambda o: o["from"] == h)
            return F.when(~again, _bound(near, lambda near: F.when(enough(near), F.array_distinct(F.transform(
                F.array(h + long, F.coalesce(F.array_min(ends(near)), h + long), F.coalesce(F.array_max(ends(near)), h + long)),
                lambda e: F.struct(F.greatest(h, F.lit(0)).alias("from"), F.least(e, F.size(grams)).alias("to")))))))

        def rated(s: Column) -> Column:
            g = F.array_distinct(F.slice(grams, s["from"] + 1, F.greatest(s["to"] - s["from"], F.lit(0))))
            dice = _bound(g, lambda g: 2.0 * F.size(F.array_intersect(g, F.array(*map(F.lit, own)))) / (F.size(g) + len(own)))
            return F.struct(dice.alias("dice"), F.lit(-place).alias("place"), F.lit(name).alias("name"), s["from"].alias("from"), s["to"].alias("to"))

        starts = lambda at: F.transform(at, lambda h, i: F.struct(h["from"].alias("from"), i.alias("i")))
        found = _bound(at, lambda at: F.when(F.size(at) >= _least_hits(text, threshold), F.flatten(F.filter(
            F.transform(starts(at), lambda s: spans(s, at)), lambda x: x.isNotNull()))))
        none = F.array().cast("array<struct<from:int,to:int>>")
        return F.filter(F.transform(F.coalesce(found, none), rated), lambda m: m["dice"] >= threshold)

    def of(grams: Column) -> Column:
        hits = F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("at"), g.alias("gram"))), lambda h: h["gram"].isin(every))
        return _bound(hits, lambda hits: F.flatten(F.array(*[
            against(k, name, text, hits, grams) for k, (name, text) in enumerate(TEMPLATES.items())])))

    def alone(found: Column) -> Column:
        inside = lambda x, y: 2 * (F.least(x["to"], y["to"]) - F.greatest(x["from"], y["from"])) > x["to"] - x["from"]
        return F.filter(found, lambda x: ~F.exists(found, lambda y: (y["place"] != x["place"]) & (y["to"] - y["from"] > x["to"] - x["from"]) & inside(x, y)))

    return _bound(_bound(_grams(words), of), alone)


def _matches(unit_words: Column, threshold: float) -> Column:
    """Structs (dice, -place, name) of the templates that a unit's words reach."""
    grams = _distinct_grams(unit_words)
    ratio = threshold / (2 - threshold)

    def against(g: Column) -> Column:
        found = []
        for place, (name, text) in enumerate(TEMPLATES.items()):
            own = _bigrams(text)
            fits = F.size(g).between(F.lit(ratio * len(own)), F.lit(len(own) / ratio))
            shared = F.size(F.array_intersect(g, F.array(*map(F.lit, own))))
            dice = F.when(fits, 2.0 * shared / (F.size(g) + len(own))).otherwise(0.0)
            found.append(F.struct(dice.alias("dice"), F.lit(-place).alias("place"), F.lit(name).alias("name")))
        return F.filter(F.array(*found), lambda m: m["dice"] >= threshold)

    return F.flatten(F.transform(F.array(grams), against))


def scan(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_units, licenses, best_license and best_dice of every row of ``docs``.

    ``n_units`` is the number of distinct units with a match, and one for each template that only a window holds.
    """
    check_anchors(threshold)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    anchor = "(?i)(?<![a-z0-9])(" + "|".join(ANCHORS) + ")(?![a-z0-9])"
    units = F.array_distinct(F.concat(F.array(body), F.split(body, "\n[\\x20\\t\\r]*\n"), F.split(body, "\n")))
    units = F.when(body.rlike(anchor), F.filter(units, lambda u: u.rlike(anchor)))
    found = F.filter(F.transform(F.array_distinct(F.transform(units, _words)), lambda w: _matches(w, threshold)), lambda m: F.size(m) > 0)
    found = F.coalesce(found, F.array().cast("array<array<struct<dice:double,place:int,name:string>>>"))
    windows = F.coalesce(F.when(body.rlike(anchor), _bound(_words(body), lambda w: _windows(w, threshold))),
                         F.array().cast("array<struct<dice:double,place:int,name:string,from:int,to:int>>"))

    def only_in_windows(windows: Column) -> Column:
        """One match, the best, of each template that no unit holds."""
        held = F.transform(F.flatten(F.col("in_units")), lambda m: m["name"])
        left = F.filter(F.transform(windows, lambda m: F.struct(m["dice"].alias("dice"), m["place"].alias("place"), m["name"].alias("name"))),
                        lambda m: ~F.array_contains(held, m["name"]))
        return F.transform(F.filter(left, lambda m: ~F.exists(left, lambda o: (o["place"] == m["place"]) & (o["dice"] > m["dice"]))), lambda m: F.array(m))

    found_in = docs.select(F.col("doc_id"), found.alias("in_units"), windows.alias("in_windows"))
    best = F.array_max(F.flatten(F.col("found")))
    whole = F.concat(F.col("in_units"), F.array_distinct(only_in_windows(F.col("in_windows"))))
    return found_in.select("doc_id", whole.alias("found")).select(
        "doc_id", F.size("found").cast("long").alias("n_units"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(F.flatten(F.col("found")), lambda m: m["name"]))), ",").alias("licenses"),
        best["name"].alias("best_license"), F.round(F.coalesce(best["dice"], F.lit(0.0)), 6).alias("best_dice"))


def oracle(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``scan`` over the units, without the anchor pruning and without the windows."""
    values = ",\n    ".join(f"({i}, '{n}', [{', '.join(repr(g) for g in _bigrams(t))}])" for i, (n, t) in enumerate(TEMPLATES.items()))
    return f"""
WITH templates(place, name, grams) AS (VALUES
    {values}),
units AS (SELECT DISTINCT doc_id, trim(regexp_replace(lower(u), '[^a-z0-9]+', ' ', 'g')) AS u FROM (
    SELECT doc_id, unnest(list_concat([t], regexp_split_to_array(t, '\\n[\\x20\\t\\r]*\\n'), string_split(t, chr(10)))) AS u
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))),
words AS (SELECT doc_id, u, string_split(u, ' ') AS w FROM units),
grams AS (SELECT doc_id, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words),
hits AS (SELECT doc_id, u, place, name, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
    FROM grams JOIN templates ON len(g) BETWEEN {threshold / (2 - threshold)} * len(grams) AND len(grams) / {threshold / (2 - threshold)}),
good AS (SELECT * FROM hits WHERE dice >= {threshold}),
found AS (SELECT doc_id, count(DISTINCT u) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
    arg_max(name, dice * 1000 - place * 1e-9) AS best_license, round(max(dice)::DOUBLE, 6) AS best_dice FROM good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licenses, '') AS licenses, best_license,
    coalesce(best_dice, 0.0)::DOUBLE AS best_dice
FROM documents d LEFT JOIN found USING (doc_id)"""
