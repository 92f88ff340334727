"""Licence scan: a trained paragraph classifier, confirmed against templates.

A paragraph is a line, or the words around a line break: as many on either side
as the longest template has, across further breaks but not across a line without
words.  So a notice of a template's length that is wrapped over lines lies in one
paragraph whole.  Word uni-, bi- and trigrams are the sparse features of a
multinomial logistic regression over licence families and a class for everything
else.  The model is trained here, on templates below under seeded word drops, cuts
and joins, and on paragraphs that only mention licensing.  The probability is
calibrated by a temperature fitted on held-out variants, and a family below
``least`` is unknown.  A prediction counts once the paragraph also shares enough
n-grams with a template of that family.

Every paragraph is scored but those that lack the model's ``deciding_words``: the
weights of all n-grams that they may hold, added up, cannot make one a licence.
Texts without any of them are dropped by one pattern before they are split.

The main path is DataFrame functions only.  A document is split, scored and
compared with the templates in one pass where it is read; the model's tables are
constants of the plan (their size is fixed by the templates), and nothing is
shuffled, joined or written.

Defined cases: null, empty and word-less texts have no paragraph; every
document gets one row, long texts are read whole, and an empty table gives no
rows.  Extra columns are ignored.  Family is null where nothing was confirmed and
``unknown`` where a paragraph reads as a licence but no family is certain.
Repeated rows get a row each.  Ties go to the first family in order.  Around a
break, a family counts where no line in reach is confirmed as it, and once per
document; unknown counts where no line in reach reads as a licence, and once.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

OTHER, UNKNOWN = "other", "unknown"
# Notices by which public licences are commonly stated.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal, no rights reserved.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under the Creative Commons CC0 public domain dedication.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying or redistribution is prohibited.",
        "This document is proprietary and confidential.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
}
# Paragraphs with the same words that state no licence.
MENTIONS = (
    "The driver showed a license to the officer at the gate.",
    "You need a fishing licence before the season opens.",
    "Poetic license allows the author to bend the facts.",
    "The city granted a liquor license to the new restaurant.",
    "A license plate was found near the public road.",
    "The general public license office opens at nine.",
    "Researchers at MIT released a new study under the direction of the institute.",
    "The Apache helicopter was released under the command of the general.",
    "Permission was granted for the meeting in the public square.",
    "The warranty of the car covers any kind of damage.",
    "Copyright law protects authors and their work.",
    "The rights of every person are reserved to the people.",
    "He was licensed to practice medicine in the state.",
    "They asked for permission to copy the files of the court.",
    "The licensed dealer sells and services tractors.",
    "The free software movement started at a university.",
    "This is a public domain of knowledge and the source of many stories.",
    "Which license should I choose for my own project?",
)
# Frequent words of English, German, French and Spanish; alone they speak for no licence, which the classifier learns from paragraphs of them.
COMMON = (
    "the of and in to a is that it be for as with by are this not or all from on at an was his her they you have had which we can if has but "
    "their there been one who will would when no more my so up out them then she he its into than any only other some may these two do now over "
    "such our me most after use work new also could many where well own how first between must each same part made while because even should "
    "der die und das ist nicht mit von ein eine zu den im auf sich des dem le la les et un une est pas dans que pour avec sur el los las y en una es con para por"
)
_WORD = "[a-z0-9]+"


@dataclass(frozen=True)
class LicenseParams:
    order: int = 3
    variants: int = 20
    rounds: int = 200
    rate: float = 2.0
    decay: float = 1e-4
    least: float = 0.5
    licence: float = 0.6
    confirm: float = 0.6
    seed: int = 13


def _grams(text: str, order: int) -> list[str]:
    words = re.findall(_WORD, text.lower())
    return sorted({" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)})


@dataclass(frozen=True)
class LicenseModel:
    families: tuple[str, ...]
    bias: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    temperature: float


def _variants(p: LicenseParams) -> list[tuple[str, str]]:
    rng = np.random.default_rng(p.seed)
    filler, common = re.findall(_WORD, " ".join(MENTIONS).lower()), COMMON.split()
    near = filler + common
    out = []
    for family, texts in [*TEMPLATES.items(), (OTHER, MENTIONS)]:
        for text in texts:
            words = re.findall(_WORD, text.lower())
            out.append((family, text))
            for _ in range(p.variants * (1 if family != OTHER else 3)):
                kept = [w for w in words if rng.random() > 0.06] or words
                extra = list(rng.choice(near, rng.integers(0, 12)))
                cut = int(rng.integers(0, len(extra) + 1))
                out.append((family, " ".join([*extra[:cut], *kept, *extra[cut:]])))
    for _ in range(8 * p.variants):
        out.append((OTHER, " ".join(rng.choice(filler, rng.integers(3, 30)))))
    for _ in range(20 * p.variants):
        out.append((OTHER, " ".join(rng.choice(common, rng.integers(3, 60)))))
    return out


@lru_cache(maxsize=4)
def train(p: LicenseParams = LicenseParams()) -> LicenseModel:
    """Fits the classifier on the driver: a few thousand short paragraphs, whatever the corpus."""
    families = (*TEMPLATES, OTHER)
    data = _variants(p)
    vocabulary = {g: i for i, g in enumerate(sorted({g for texts in TEMPLATES.values() for t in texts for g in _grams(t, p.order)}))}
    x = np.zeros((len(data), len(vocabulary)), np.float32)
    for i, (_, text) in enumerate(data):
        own = [vocabulary[g] for g in _grams(text, p.order) if g in vocabulary]
        x[i, own] = 1
    y = np.array([families.index(f) for f, _ in data])
    rng = np.random.default_rng(p.seed + 1)
    test = rng.random(len(data)) < 0.25
    w, b = np.zeros((len(vocabulary), len(families))), np.zeros(len(families))
    one = np.eye(len(families))[y]
    # each class weighs the same, so that families with more templates are not preferred
    mass = (1 / np.bincount(y[~test], minlength=len(families)))[y[~test], None] / len(families)
    xt = x[~test]
    step_w, step_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(p.rounds):
        logits = xt @ w + b
        logits -= logits.max(1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(1, keepdims=True)
        g = (prob - one[~test]) * mass
        step_w = 0.9 * step_w - p.rate * (xt.T @ g + p.decay * w)
        step_b = 0.9 * step_b - p.rate * g.sum(0)
        w, b = w + step_w, b + step_b
    held = x[test] @ w + b

    def loss(t: float) -> float:
        z = held / t
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), y[test]]).mean())

    temperature = min(np.geomspace(0.25, 8, 60), key=loss)
    weights = {g: tuple(round(float(v), 6) for v in w[i]) for g, i in vocabulary.items()}
    return LicenseModel(families, tuple(round(float(v), 6) for v in b), weights, float(temperature))


@lru_cache(maxsize=4)
def deciding_words(p: LicenseParams = LicenseParams()) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The words that tell which paragraphs are certain to be of no family and not unknown either.

    They are all those without any of the first words, and those with only one of
    them that is not among the second.  Of the n-grams of the words that such a
    paragraph may hold, those that speak for a family are added up as if it held
    them all, family by family.  That bounds the odds of all families together
    against ``OTHER``.
    """
    model = train(p)
    grams = [set(g.split()) for g in model.weights]
    w = np.array(list(model.weights.values()))
    bias = np.array(model.bias)
    gain = np.maximum((w[:, :-1] - w[:, -1:]) / model.temperature, 0)
    base = (bias[:-1] - bias[-1]) / model.temperature
    most = min(p.least, p.licence, 0.5)
    limit = 0.99 * most / (1 - most)
    odds = lambda held: np.exp(base + gain[[g <= held for g in grams]].sum(0)).sum()
    common = COMMON.split()
    words = sorted(set().union(*grams))
    idle: set[str] = set()
    # frequent words are tried first, and leave room for one word more; neither changes the result
    for word in sorted(words, key=lambda x: (common.index(x) if x in common else len(common), x)):
        if odds(idle | {word}) < 0.1 * limit:
            idle.add(word)
    first = tuple(x for x in words if x not in idle)
    return first, tuple(x for x in first if odds(idle | {x}) >= limit)


def _any_of(words: tuple[str, ...]) -> str:
    """A pattern that finds any of the words, tried by their first letter."""
    first = sorted({w[0] for w in words})
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:" + "|".join(w[1:] for w in words if w[0] == c) + ")" for c in first) + ")(?![a-z0-9])"


def _constant(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _read(text: Column, p: LicenseParams, read: Callable[[Column], Column]) -> Column:
    """``read`` of the words of each paragraph that holds the deciding words: ``lines``, null where it gives none, and ``around: first, last, read``.

    All of it is null for a text without such words.
    """
    first, strong = deciding_words(p)
    one, two = _constant(strong, "array<string>"), _constant(first, "array<string>")
    hopeful = lambda words: F.arrays_overlap(words, one) | (F.size(F.array_intersect(words, two)) > 1)
    longest = max(len(re.findall(_WORD, t.lower())) for texts in TEMPLATES.values() for t in texts)
    reach = 2 * longest  # every line within a paragraph has a word, so at least half of this are words
    marks = lambda c: F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))

    def nearest(line: Column, before: Column, after: Column) -> Column:
        # the nearest words up to a line without words, with the marks between them
        before = F.regexp_replace(F.concat(F.array_join(before, " "), F.lit(" ")), r"(?s)^.*\n $|^.*\n (?=\n )", "")
        after = F.regexp_replace(F.concat(F.lit(" "), F.array_join(after, " ")), r"(?s)^ \n.*| \n(?= \n).*", "")
        before = F.regexp_extract(before, rf"(?<![a-z0-9])(?:[a-z0-9]++ (?:\n )*+){{0,{longest}}}+$", 0)
        after = F.regexp_extract(after, rf"^(?:(?: \n)*+ [a-z0-9]++){{0,{longest}}}+", 0)
        return F.struct(line.alias("line"), before.alias("before"), after.alias("after"))

    def of_breaks(flat: Column) -> Column:
        def around(at: Column, line: Column) -> Column:
            before = F.slice(flat, F.greatest(F.lit(1), at - reach), F.least(F.lit(reach), at - 1))
            return F.struct(line.alias("line"), before.alias("before"), F.slice(flat, at + 1, F.lit(reach)).alias("after"))

        def spanned(b: Column) -> Column:
            words = words_of(F.concat(b["before"], b["after"]))
            return F.struct((b["line"] - marks(b["before"])).alias("first"), (b["line"] + 1 + marks(b["after"])).alias("last"), words.alias("words"))

        breaks = F.filter(F.transform(flat, lambda w, i: F.when(w == "\n", i + 1)), lambda i: i.isNotNull())
        found = F.filter(F.transform(breaks, around), lambda b: hopeful(F.concat(b["before"], b["after"])))
        found = F.transform(found, lambda b: nearest(b["line"], b["before"], b["after"]))
        found = F.transform(F.filter(found, lambda b: (F.trim(b["before"]) != "") & (F.trim(b["after"]) != "")), spanned)
        found = F.filter(found, lambda b: hopeful(b["words"]))
        found = F.transform(found, lambda b: F.struct(b["first"].alias("first"), b["last"].alias("last"), read(b["words"]).alias("read")))
        return F.filter(found, lambda b: b["read"].isNotNull())

    def of_lines(lines: Column) -> Column:
        # a mark ends every line; two in a row are a line without words
        flat = F.flatten(F.transform(lines, lambda x: F.concat(x, F.array(F.lit("\n")))))
        flat = F.when(hopeful(F.flatten(lines)) & (F.size(lines) > 1), flat).otherwise(F.array().cast("array<string>"))
        return F.struct(F.transform(lines, lambda w: F.when(hopeful(w), read(w))).alias("lines"), let(flat, of_breaks).alias("around"))

    return F.when(F.lower(text).rlike(_any_of(first)), let(F.transform(F.split(text, "\\R"), words_of), of_lines))


def _paragraph_rows(docs: DataFrame, p: LicenseParams, id_col: str, text_col: str, read: Callable[[Column], Column]) -> DataFrame:
    def listed(v: Column) -> Column:
        lines = F.transform(v["lines"], lambda x, i: F.struct(i.alias("first"), i.alias("last"), x.alias("read")))
        return F.concat(F.filter(lines, lambda x: x["read"].isNotNull()), v["around"])

    found = let(_read(F.col(text_col).cast("string"), p, read), listed)
    # the outer form keeps the optimiser from evaluating the pass twice
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.inline_outer(found)).filter("first is not null")


def paragraphs(docs: DataFrame, p: LicenseParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs that hold the deciding words: ``doc_id, first, last, words``, the lines they are from and their words.

    Those of repeated rows repeat.  A line has ``first = last``.
    """
    return _paragraph_rows(docs, p, id_col, text_col, lambda words: F.array_join(words, " ")).withColumnRenamed("read", "words")


def _spans(words: Column, order: int) -> Column:
    """The distinct n-grams of an array of words."""
    return F.array_distinct(
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.lit(order)),
                lambda n: F.when(
                    F.size(words) >= n,
                    F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")),
                ).otherwise(F.array().cast("array<string>")),
            )
        )
    )


def _weights(model: LicenseModel) -> Callable[[Column], Column]:
    """The weights of an n-gram of the model.  A map is searched from end to end, so they are dealt to many small ones."""
    parts: list[dict[str, tuple[float, ...]]] = [{} for _ in range(64)]
    for g, w in model.weights.items():
        parts[zlib.crc32(g.encode()) % len(parts)][g] = w
    table = _constant(parts, "array<map<string,array<double>>>")
    return lambda g: F.element_at(F.get(table, (F.crc32(g.cast("binary")) % len(parts)).cast("int")), g)


def _classify(p: LicenseParams) -> Callable[[Column], Column]:
    """``family, probability, overlap, confirmed`` of a paragraph's words, null unless it is of a family or unknown."""
    model = train(p)
    families = model.families
    weights = _weights(model)
    of_template = {f: [[g for g in _grams(t, p.order) if " " in g or len(_grams(t, 1)) < 3] for t in texts] for f, texts in TEMPLATES.items()}
    templates = _constant(of_template, "map<string,array<array<string>>>")
    bias, names = _constant(model.bias, "array<double>"), _constant(families, "array<string>")

    def overlap(grams: Column, family: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(F.element_at(templates, family), lambda t: F.size(F.array_intersect(grams, t)) / F.size(t))), F.lit(0.0))

    def named(family: Column, probability: Column, licence: Column, share: Column) -> Column:
        sure = (family != OTHER) & (probability >= p.least) & (share >= p.confirm)
        found = F.struct(F.when(sure, family).otherwise(UNKNOWN).alias("family"), F.round(probability, 6).alias("probability"), F.round(share, 6).alias("overlap"), sure.alias("confirmed"))
        return F.when(sure | licence, found)

    def of_odds(grams: Column, z: Column, top: Column, e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
        licence = F.element_at(e, len(families)) / total <= 1 - p.licence
        odds = F.struct(F.element_at(names, F.array_position(z, top).cast("int")).alias("family"), (F.lit(1.0) / total).alias("probability"), licence.alias("licence"))
        # the templates are compared with the few that may be confirmed or unknown
        some = lambda x: x["licence"] | ((x["family"] != OTHER) & (x["probability"] >= p.least))
        return let(odds, lambda x: F.when(some(x), let(overlap(grams, x["family"]), lambda share: named(x["family"], x["probability"], x["licence"], share))))

    def of_grams(grams: Column) -> Column:
        known = F.filter(grams, lambda g: g.isin(list(model.weights)))
        sums = F.aggregate(known, F.array_repeat(F.lit(0.0), len(families)), lambda a, g: F.zip_with(a, weights(g), lambda x, y: x + y))
        logits = F.zip_with(sums, bias, lambda s, b: (s + b) / F.lit(model.temperature))
        return let(logits, lambda z: let(F.array_max(z), lambda top: let(F.transform(z, lambda v: F.exp(v - top)), lambda e: of_odds(grams, z, top, e))))

    return lambda words: let(_spans(words, p.order), of_grams)


def classify(docs: DataFrame, p: LicenseParams = LicenseParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The paragraphs that are of a family or unknown: ``doc_id, first, last, family, probability, overlap, confirmed``."""
    return _paragraph_rows(docs, p, id_col, text_col, _classify(p)).select("doc_id", "first", "last", "read.*")


def scan(docs: DataFrame, p: LicenseParams = LicenseParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, family, probability, families, paragraphs`` (the surest confirmed family first)."""

    def of_text(v: Column) -> Column:
        def told(b: Column) -> Column:
            # a line in reach that says the same
            reached = F.slice(v["lines"], b["first"] + 1, b["last"] - b["first"] + 1)
            return F.exists(reached, lambda x: x.isNotNull() & (~b["read"]["confirmed"] | (x["family"] == b["read"]["family"])))

        lines = F.transform(v["lines"], lambda x, i: F.struct(i.alias("first"), x.alias("read")))
        new = F.transform(F.filter(v["around"], lambda b: ~told(b)), lambda b: F.struct(b["first"].alias("first"), b["read"].alias("read")))
        return let(F.filter(lines, lambda x: x["read"].isNotNull()), lambda one: let(new, lambda more: summed(one, more)))

    def summed(one: Column, more: Column) -> Column:
        families = lambda x: F.array_distinct(F.transform(x, lambda b: b["read"]["family"]))
        order = lambda b: F.struct(b["read"]["confirmed"], b["read"]["probability"], b["read"]["overlap"], F.negative(b["first"]), b["read"]["family"].alias("family"))
        best = F.array_max(F.transform(F.concat(one, more), lambda b: F.struct(order(b).alias("order"), b["read"].alias("read"))))["read"]
        return F.struct(
            best["family"].alias("family"),
            best["probability"].alias("probability"),
            F.sort_array(families(F.concat(one, more))).alias("families"),
            (F.size(one) + F.size(families(more))).cast("long").alias("paragraphs"),
        )

    # a document is read in one pass where it lies: nothing is shuffled, joined or written
    found = F.array(let(_read(F.col(text_col).cast("string"), p, _classify(p)), lambda v: F.when(v.isNotNull(), of_text(v))))
    # a generator, so that the optimiser does not evaluate the pass once per column
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.explode_outer(found).alias("found")).select(
        "doc_id",
        "found.family",
        "found.probability",
        F.coalesce("found.families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("found.paragraphs", F.lit(0).cast("long")).alias("paragraphs"),
    )
