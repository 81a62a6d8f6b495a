"""Licence scans by a trained paragraph classifier.

A multinomial logistic regression over word 1- and 2-grams names a paragraph's
licence family; grams that ordinary paragraphs use often are no features, so
the weights are few and a paragraph without a feature needs no score. Notices
like a licence but like no known one are a class of their own, and
probabilities are calibrated on notices left out of the fit. A prediction is
confirmed by comparison with the family's templates.

A notice wrapped over lines is judged with its lines joined.

The scan is column expressions only: it runs in the scan's own stage without
Python, joins or shuffles. Only the fit, on a bounded sample, is done by the
driver.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Usual notices of each family (fixed values); "unknown" are notices of no known licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": ("Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses",
                   "Distributed under the Apache License, Version 2.0."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
                "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3"),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
                "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2"),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-3.0-or-later",
             "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    "agpl-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause", "Licensed under the 3-clause BSD license."),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work",
            "This is free and unencumbered software released into the public domain."),
    "unknown": ("All rights reserved. No part of this publication may be reproduced without permission.", "Licensed under the terms of the license agreement.",
                "This license is granted to the customer for internal use only.", "See the LICENSE file for the license terms.",
                "Use of this software is subject to the end user license agreement."),
}
NONE = "none"


class Model(NamedTuple):
    """``weights``: gram -> one number for each class; ``classes`` end with the
    class of ordinary paragraphs; ``temperature`` divides the scores;
    ``accept`` is the least probability of a known family."""
    classes: tuple[str, ...]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    accept: float


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def grams_of(words: Column) -> Column:
    """Distinct words and pairs of words that follow each other."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))))


def _grams(text: str) -> list[str]:
    w = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())
    return list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]))


def _variants(templates: dict[str, tuple[str, ...]], each: int, rng: np.random.Generator) -> list[tuple[str, str]]:
    """Templates as they are and with some words left out, repeated or cut off."""
    out = []
    for family, texts in templates.items():
        for text in texts:
            w = text.split()
            out.append((family, text))
            for _ in range(each):
                keep = [x for x in w if rng.random() > 0.08] or w
                if rng.random() < 0.3 and len(keep) > 8:
                    a = int(rng.integers(0, len(keep) - 7))
                    keep = keep[a:a + int(rng.integers(7, len(keep) + 1))]
                out.append((family, " ".join(keep)))
    return out


def _resembles(grams: Column, known: Column, templates: dict[str, tuple[str, ...]]) -> Column:
    """Whether a line has half of a template's grams, or most of its own grams
    (6 at least) are those of one template, as in a notice cut into lines."""
    parts = _literal([_grams(t) for texts in templates.values() for t in texts], "array<array<string>>")
    shared = F.transform(parts, lambda t: F.struct(F.size(F.array_intersect(t, known)).alias("n"), F.size(t).alias("of")))
    return F.exists(shared, lambda x: (x["n"] >= 0.5 * x["of"]) | ((x["n"] >= 6) & (x["n"] >= 0.6 * F.size(grams))))


def _ordinary(docs: DataFrame, text_col: str, id_col: str, templates: dict[str, tuple[str, ...]], vocabulary: list[str],
              sample: int, lines: int) -> list[list[str]]:
    """The vocabulary's grams in at most ``lines`` paragraphs, without notices
    and what resembles a template, of at most ``sample`` documents, the first
    by a hash of their id."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    known = F.array_distinct(F.from_json(F.lit(json.dumps(vocabulary)), "array<string>"))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).join(F.broadcast(ids), "id")
            .select("id", F.posexplode(F.split("t", "\n")).alias("at", "line"))
            .where(~F.col("line").rlike(r"(?i)licen[cs]|copyright|spdx|all rights reserved") & (F.trim("line") != ""))
            .select(F.xxhash64("line").alias("h"), "id", "at", grams_of(words_of(F.col("line"))).alias("all"))
            .select("h", "id", "at", "all", F.array_intersect(known, F.col("all")).alias("g"))
            .where(~_resembles(F.col("all"), F.col("g"), templates)).select("h", "id", "at", "g")
            .orderBy("h", "id", "at").limit(lines))
    return [r["g"] for r in rows.collect()]


def fit(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, sample: int = 400, lines: int = 3000, each: int = 30,
        often: float = 0.005, l2: float = 1e-3, steps: int = 300, seed: int = 11, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Fits on variants of the templates and a bounded sample of paragraphs
    (``sample`` documents, ``lines`` paragraphs). Grams in more than ``often``
    of those paragraphs, and pairs without a rarer word, are no features."""
    rng = np.random.default_rng(seed)
    notices = _variants(templates, each, rng)
    vocabulary = sorted({g for _, t in notices for g in _grams(t)})
    ordinary = _ordinary(docs, text_col, id_col, templates, vocabulary, sample, lines)
    seen: dict[str, int] = {}
    for grams in ordinary:
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
    rare = lambda g: seen.get(g, 0) <= often * max(1, len(ordinary)) and len(g) > 1
    features = [g for g in vocabulary if rare(g) and any(rare(w) for w in g.split())]
    column = {g: i for i, g in enumerate(features)}
    classes = (*templates, NONE)
    rows = [(classes.index(c), [column[g] for g in _grams(t) if g in column]) for c, t in notices]
    rows += [(len(classes) - 1, [column[g] for g in grams if g in column]) for grams in ordinary]
    rows += [(len(classes) - 1, [])] * 50  # a text without features is ordinary
    x, y = np.zeros((len(rows), len(features) + 1)), np.array([r[0] for r in rows])
    for i, (_, at) in enumerate(rows):
        x[i, at] = 1
    x[:, -1] = 1
    left_out = rng.random(len(rows)) < 0.2
    target, w = np.eye(len(classes))[y], np.zeros((x.shape[1], len(classes)))
    balance = (1 / np.bincount(y, minlength=len(classes)))[y][:, None] / len(classes)
    train = ~left_out
    velocity = np.zeros_like(w)
    for _ in range(steps):
        z = x[train] @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x[train].T @ ((p - target[train]) * balance[train]) + l2 / len(classes) * w
        velocity = 0.9 * velocity - 4.0 * g
        w += velocity
    z = x[left_out] @ w
    known = y[left_out] < len(classes) - 2

    def probabilities(t):
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.2, 5, 25)
    loss = [-np.log(np.maximum(probabilities(t)[np.arange(len(z)), y[left_out]], 1e-12)).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    right = probabilities(t)[np.arange(len(z)), y[left_out]][known]
    accept = float(np.clip(np.quantile(right, 0.02), 0.3, 0.9)) if len(right) else 0.5
    return Model(classes, {g: w[i].round(5).tolist() for g, i in column.items()}, w[-1].round(5).tolist(), t, accept)


def _literal(value, kind: str) -> Column:
    """A constant of a nested type; Catalyst folds it once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _reach(lines: Column, at: Column, words: int) -> Column:
    """How many lines a notice that begins in line ``at`` may take: the lines
    with words that follow, until they hold ``words`` words."""
    step = lambda a, line: F.when(
        a["open"], _let(F.size(words_of(line)), lambda n: F.struct(
            (a["k"] + (n > 0).cast("int")).alias("k"), (a["n"] + n).alias("n"), ((n > 0) & (a["n"] + n < words)).alias("open")))).otherwise(a)
    return F.aggregate(F.slice(lines, at + 2, words), F.struct(F.lit(1).alias("k"), F.lit(0).alias("n"), F.lit(True).alias("open")), step)["k"]


def scan_licenses(docs: DataFrame, model: Model, templates: dict[str, tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", least: float = 0.6) -> DataFrame:
    """One row for each paragraph with a licence notice: doc_id, paragraph
    (its first line, from 0), start (in characters), text, family,
    probability, similarity, confirmed.

    A paragraph is a line, or neighbouring lines without a blank one between
    them over which a notice is wrapped: joined they are confirmed, and more
    similar than any confirmed line among them. Such a window begins at a line
    with a feature; of windows that overlap the most similar and then the
    shortest is taken, and its lines have no rows of their own.

    ``family`` is the likeliest one, or "unknown" if its probability is under
    the model's limit; ``similarity`` is the largest share of a template's
    grams (of any family, for unknown ones) that the paragraph has, and
    ``confirmed`` tells a known family with ``least`` or more. Null or empty
    texts have no rows; null ids are kept; repeated rows give repeated rows;
    other columns are not read; an empty table gives an empty table.
    """
    n = len(model.classes)
    stems = sorted({w for g in model.weights for w in g.split() if w in model.weights})
    any_word = r"(?i)(?<![a-z0-9])(?:" + "|".join(s.replace(".", r"\.") for s in stems) + r")(?![a-z0-9])"
    # a notice is no longer than the longest template and a quarter for words put in
    reach = 5 * max((len(t.split()) for ts in templates.values() for t in ts), default=0) // 4 + 1
    weights = _literal(model.weights, "map<string,array<double>>")
    bias = _literal(model.bias, "array<double>")
    classes = _literal(list(model.classes), "array<string>")
    parts = _literal({f: [_grams(t) for t in texts] for f, texts in templates.items()}, "map<string,array<array<string>>>")

    def judged(grams: Column, at: Column, k: Column) -> Column:
        score = F.aggregate(F.array_intersect(F.map_keys(weights), grams), bias,
                            lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda a, b: a + b))
        share = lambda of: F.array_max(F.transform(of, lambda t: F.size(F.array_intersect(t, grams)) / F.size(t)))

        def named(x: Column) -> Column:
            family = F.when(x["p"] < model.accept, "unknown").otherwise(F.element_at(classes, x["best"].cast("int")))
            return F.when(x["best"] < n, _let(family, lambda f: _let(
                F.when(f == "unknown", share(F.flatten(F.map_values(parts)))).otherwise(share(F.element_at(parts, f))),
                lambda s: F.struct(at.alias("at"), k.alias("k"), f.alias("family"), x["p"].alias("probability"), s.alias("similarity"),
                                   ((f != "unknown") & (s >= least)).alias("confirmed")))))

        return _let(score, lambda s: _let(F.array_max(s), lambda top: _let(F.struct(
            F.array_position(s, top).alias("best"),
            (1 / F.aggregate(s, F.lit(0.0), lambda a, v: a + F.exp((v - top) / model.temperature))).alias("p")), named)))

    found = lambda of: F.filter(of, lambda x: x.isNotNull())
    text = lambda at, k, by: F.array_join(F.slice("lines", at + 1, k), by)
    docs = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"))
            .where(F.col("t").rlike(any_word)).select("doc_id", F.split("t", "\n").alias("lines")))
    docs = docs.withColumn("hits", F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(any_word), i)), lambda i: i.isNotNull()))
    docs = docs.withColumn("alone", found(F.transform("hits", lambda i: _let(
        grams_of(words_of(F.element_at("lines", i + 1))), lambda g: judged(g, i, F.lit(1))))))
    docs = docs.withColumn("solo", F.filter("alone", lambda x: x["confirmed"]))

    def windows(i: Column) -> Column:
        """The confirmed windows of two or more lines that begin at line i."""
        def window(first: Column, k: Column) -> Column:
            rest = F.slice(words_of(text(i + 1, k - 1, " ")), 1, reach)
            return _let(grams_of(F.concat(first, rest)), lambda g: judged(g, i, k))

        def more(x: Column) -> Column:  # than its lines
            return ~F.exists("solo", lambda s: (x["at"] <= s["at"]) & (s["at"] < x["at"] + x["k"]) & (s["similarity"] >= x["similarity"]))

        whole = F.array_min(F.transform(F.filter("solo", lambda s: (s["at"] >= i) & (s["similarity"] >= 1)), lambda s: s["at"]))
        most = _let(whole, lambda stop: F.when(stop == i, 1).otherwise(F.least(_reach(F.col("lines"), i, reach), stop - i)))
        return _let(most, lambda m: F.when(m > 1, _let(words_of(F.element_at("lines", i + 1)), lambda w: _let(
            F.slice(w, F.greatest(F.size(w) - reach, F.lit(0)) + 1, reach), lambda first: F.filter(
                F.transform(F.sequence(F.lit(2), m), lambda k: window(first, k)), lambda x: x.isNotNull() & x["confirmed"] & more(x)))))
            .otherwise(F.filter(F.slice("alone", 1, 0), lambda x: x.isNotNull())))

    def better(acc: Column, x: Column) -> Column:
        """Windows come by first line; one that overlaps the last replaces it or goes."""
        last = F.get(acc, F.size(acc) - 1)
        wins = (x["similarity"] > last["similarity"]) | (x["similarity"] == last["similarity"]) & (x["k"] < last["k"])
        return (F.when((F.size(acc) == 0) | (last["at"] + last["k"] <= x["at"]), F.concat(acc, F.array(x)))
                .when(wins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(x))).otherwise(acc))

    docs = docs.withColumn("wrapped", F.flatten(F.transform("hits", windows)))
    docs = docs.withColumn("wrapped", F.when(F.size("wrapped") > 0, F.aggregate("wrapped", F.slice("wrapped", 1, 0), better)).otherwise(F.col("wrapped")))
    rows = F.concat("wrapped", F.filter("alone", lambda x: ~F.exists("wrapped", lambda w: (w["at"] <= x["at"]) & (x["at"] < w["at"] + w["k"]))))
    rows = docs.select("doc_id", "lines", F.explode(rows).alias("x"))
    start = F.aggregate(F.slice("lines", 1, F.col("x.at")), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return rows.select("doc_id", F.col("x.at").alias("paragraph"), start.alias("start"), text(F.col("x.at"), F.col("x.k"), "\n").alias("text"),
                       "x.family", "x.probability", "x.similarity", "x.confirmed")


def license_paragraphs(docs: DataFrame) -> DataFrame:
    """The thin query: the notices of all documents."""
    return scan_licenses(docs, fit(docs))
