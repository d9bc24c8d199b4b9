"""Licence scan: lines and whole texts against licence templates by the Dice coefficient of word bigrams.

Text is normalised (lower case, everything but letters and digits parts words). Units are the lines of a text and,
if it has several, the text as a whole (line 0). Sizes prune first: a unit of `u` distinct bigrams can
reach the coefficient `t` with a template of `v` only if `v * t / (2 - t) <= u <= v * (2 - t) / t`. As a
unit has at most one bigram per word less one, most prose never gets its bigrams made.

Units without any of a few long words of the templates are passed over as well (`telling_words`: no match can lack them all).

All in one projection per row: no shuffle, no join, no Python. Templates are a short fixed list in the plan
(at most `MAX_TEMPLATES`).

Defined results: NULL and empty texts match nothing; of templates equally near to a unit the first in the list counts; rows
are independent, so repeated rows repeat their result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind

DICE = 0.8
MAX_TEMPLATES = 200

#: Notices and short licence texts as published.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
)


def normalised(text: Column) -> Column:
    """Words parted by one space, lines by a line feed."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]++", " ")


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a template, by the same rule."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bounds(v: int, dice: float) -> tuple[float, float]:
    return v * dice / (2 - dice) - 1e-9, v * (2 - dice) / dice + 1e-9


def telling_words(grams: list[str], dice: float) -> list[str]:
    """Long words of which any text near the template has at least one.

    A unit at the coefficient lacks at most `v - v * t / (2 - t)` of the template's bigrams, so it has one of any larger set.
    """
    lacking = len(grams) - bounds(len(grams), dice)[0]
    chosen: list[str] = []
    while sum(any(w in chosen for w in g.split()) for g in grams) <= lacking:
        left = {w for g in grams for w in g.split()} - set(chosen)
        chosen.append(max(left, key=lambda w: (len(w), w)))
    return chosen


def _bigrams(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return F.array_distinct(pairs)


def _best(unit: Column, grams: list[tuple[str, list[str]]], dice: float) -> Column:
    """Struct of the nearest template that reaches `dice`, else NULL."""
    def score(b: Column, i: int, name: str, t: list[str]) -> Column:
        lo, hi = bounds(len(t), dice)
        both = F.size(F.array_intersect(b, F.array(*map(F.lit, t))))
        value = 2.0 * both / (F.size(b) + F.lit(len(t)))
        near = F.struct(value.alias("dice"), F.lit(-i).alias("order"), F.lit(name).alias("licence"))
        return F.when(F.size(b).between(F.lit(lo), F.lit(hi)), F.when(value >= dice - 1e-9, near))

    return bind(
        _bigrams(unit),
        lambda b: F.array_max(F.array_compact(F.array(*[score(b, i, n, t) for i, (n, t) in enumerate(grams)]))),
    )


def licences(text: Column, templates: tuple[tuple[str, str], ...] = TEMPLATES, dice: float = DICE) -> Column:
    """Array of `line, licence, dice` in the order of the lines; line 0 is the whole text."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates, not {len(templates)}")
    grams = [(name, template_bigrams(t)) for name, t in templates]
    # Many words can still be few bigrams, so of the two bounds only the lower one holds for words.
    short = F.lit(int(min(bounds(len(t), dice)[0] for _, t in grams)) + 2)
    told = F.array(*map(F.lit, sorted({w for _, t in grams for w in telling_words(t, dice)})))

    def unit(line: Column, number: Column) -> Column:
        words = F.split(F.btrim(line), r"\s+", -1)
        hit = bind(words, lambda w: F.when((F.size(w) >= short) & F.arrays_overlap(w, told), _best(w, grams, dice)))
        return bind(hit, lambda h: F.when(h.isNotNull(), F.struct(number.alias("line"), h["licence"].alias("licence"), h["dice"].alias("dice"))))

    def units(n: Column) -> Column:
        lines = bind(F.split(n, "\n", -1), lambda x: F.transform(x, lambda line, i: unit(line, i + 1)))
        whole = F.when(F.contains(n, F.lit("\n")), unit(F.replace(n, F.lit("\n"), F.lit(" ")), F.lit(0)))
        return F.array_compact(F.concat(F.array(whole), lines))

    return bind(normalised(text), units)


def licence_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """`doc_id, n_found, licence, found` of each row: number of matches, licence of the first, all matches."""
    found = docs.select(F.col(doc_id).alias("doc_id"), licences(F.col(text), **options).alias("found"))
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_found"), F.get("found", F.lit(0))["licence"].alias("licence"), "found")
