"""Licence notices by a trained paragraph classifier (DataFrame and SQL functions,
with Spark ML for the fit).

Paragraphs are lines; notices wrapped over lines of a block (up to a line without
words) are found by comparing the templates with each line and the words after it. Features are word n-grams (1 to 3 words, lower-cased runs of
a-z and 0-9) of the notices, whatever the corpus holds. A
multinomial logistic regression with L1 penalty learns the families from the
notices and their shortened variants, against ordinary paragraphs of at most
``NEGATIVE_DOCS`` documents in hash order (a documented bound). A prediction is
confirmed when enough word pairs of one of the family's notices stand in the
paragraph; licence-like paragraphs that are not confirmed, or whose probability is below the
level that no held-out ordinary paragraph reaches, are of the class ``unknown``.

Every paragraph of every whole text is judged, most of them by two exact shortcuts. The
words of a notice are split in weak and strong ones: even a paragraph with all weak words and
every n-gram of them could not leave the class ``none``, by the sum of the weights that speak
for each family. And a text that has CONFIRM of a notice's word pairs must have one of its
telling pairs, since fewer than that share of the pairs are left out of them. Texts
without a strong word and without a word of a telling pair have no notice.

Defined results: NULL, empty and blank texts have no notices; repeated rows each
give theirs; equal notices in one text are rows of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lines_of, stored

# Notices of common licences.
NOTICES: dict[str, list[str]] = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has dedicated all copyright and related rights to the public domain."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License."],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

NEGATIVE_DOCS = 400
CONFIRM = 0.6
LONGEST = 2 * max(len(re.findall(r"[a-z0-9]+", t.lower())) for texts in NOTICES.values() for t in texts)
# common words, which say little about a notice; only the choice of what to look for first depends on them
PLAIN = frozenset("a all an and any are as at be by following for from free has have in is it its may no not of on or other person that the this to under use was with without you".split())
NONE = "none"


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _grams(words: list[str], sizes: tuple[int, ...] = (1, 2, 3)) -> list[str]:
    return sorted({" ".join(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)})


def _plain(word: str) -> bool:
    return word in PLAIN


def telling_pairs() -> list[str]:
    """Of each notice the word pairs without its plainest ones, of which fewer are left out
    than CONFIRM asks for: whatever is confirmed has one of the others."""
    out = set()
    for texts in NOTICES.values():
        for text in texts:
            pairs = sorted(_grams(_words(text), (2,)), key=lambda p: (-sum(map(_plain, p.split())), len(p), p))
            out.update(pairs[math.ceil(CONFIRM * len(pairs) - 1e-9) - 1:])
    return sorted(out)


def telling_words() -> list[str]:
    """Of each telling pair the less plain word."""
    return sorted({min(p.split(), key=lambda w: (_plain(w), -len(w), w)) for p in telling_pairs()})


def strong_words(m: Model) -> list[str]:
    """Words of the features without a weak set: with all weak words and all n-grams of them
    a paragraph's probability of ``none`` stays above one half."""
    for_family = [[max(0.0, x - none) for x, none in zip(row, m.weights[0])] for row in m.weights[1:]]
    by_word: dict[str, list[float]] = {}
    for i, feature in enumerate(m.features):
        # an n-gram's weights stand with its least plain word: without it there is no such n-gram
        word = min(feature.split(), key=lambda w: (_plain(w), -len(w), w))
        own = by_word.setdefault(word, [0.0] * len(for_family))
        for c, gain in enumerate(for_family):
            own[c] += gain[i]
    margins = [b - m.intercepts[0] for b in m.intercepts[1:]]
    strong = []
    for word, gains in sorted(by_word.items(), key=lambda x: (not _plain(x[0]), max(x[1], default=0.0), x[0])):
        more = [a + b for a, b in zip(margins, gains)]
        if sum(math.exp(min(x, 50.0)) for x in more) < 0.99:
            margins = more
        else:
            strong.append(word)
    return sorted(strong)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def grams(w: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Distinct n-grams of a word array column."""

    def of(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *[w[i + k] for k in range(n)]))
        return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[w if n == 1 else of(n) for n in sizes]))


def _variants() -> list[tuple[str, str]]:
    """(family, text): every notice, and it without each of its words in turn."""
    out = []
    for family, texts in NOTICES.items():
        for text in texts:
            w = _words(text)
            out += [(family, " ".join(w))] * max(4, len(w) // 2)
            if len(w) > 4:
                out += [(family, " ".join(w[:i] + w[i + 1:])) for i in range(len(w))]
    return out


@dataclass(frozen=True)
class Model:
    classes: list[str]  # the first is "none"
    features: list[str]
    weights: list[list[float]]  # class x feature
    intercepts: list[float]
    level: float  # least probability of a named family


def paragraphs(docs: DataFrame) -> DataFrame:
    """Lines as word arrays ``w`` (comment marks are no words), each with ``tail``, the
    words that follow it in its block, as many as a notice can have. Blocks end at lines
    without words. ``row`` tells repeated rows apart."""
    lines = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.transform(lines_of(F.col("text")), words).alias("ws"))

    def following(i: Column) -> Column:
        after = F.slice("ws", i + 1, LONGEST)  # lines of a block have a word or more
        end = F.array_position(F.transform(after, F.size), 0)
        return F.slice(F.flatten(F.when(end > 0, F.slice(after, F.lit(1), end.cast("int") - 1)).otherwise(after)), 1, LONGEST)

    at = F.transform(F.sequence(F.lit(1), F.size("ws")), lambda i: F.struct(F.element_at("ws", i).alias("w"), following(i).alias("tail")))
    return lines.select("row", "doc_id", F.posexplode(at).alias("paragraph", "at")).select("row", "doc_id", "paragraph", "at.w", "at.tail")


def fit(docs: DataFrame) -> Model:
    spark = docs.sparkSession
    notices = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("line")) for f, t in _variants()])
    positives = spark.range(1).select(F.inline(notices)).select("family", words(F.col("line")).alias("w"))
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(NEGATIVE_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")  # at most NEGATIVE_DOCS ids
    ordinary = stored(paragraphs(sample).select("w").withColumn("like", _likeness(grams(F.col("w"), (2,)))), "license-negatives")
    ordinary = ordinary.filter(F.size("w") > 0)
    ordinary = ordinary.filter("like < 0.5").select(F.lit(NONE).alias("family"), "w")
    features = sorted({g for texts in NOTICES.values() for t in texts for g in _grams(_words(t))})
    classes = [NONE, *sorted(NOTICES)]
    place = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))])
    held = F.pmod(F.xxhash64("w"), F.lit(4)) == 0
    known = F.array(*map(F.lit, features))
    # written first: the optimizer would move the n-grams into the loop over the features
    rows = stored(positives.union(ordinary).withColumn("g", F.array_intersect(grams(F.col("w")), known)), "license-grams").select(
        place[F.col("family")].alias("label"), held.alias("held"),
        array_to_vector(F.transform(known, lambda x: F.array_contains("g", x).cast("double"))).alias("features"))
    rows = stored(rows, "license-training")
    lr = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=1.0, maxIter=60, standardization=False)
    model = lr.fit(rows.filter(~F.col("held") | (F.col("label") > 0)))
    worst = model.transform(rows.filter(F.col("held") & (F.col("label") == 0))).select((1 - F.element_at(vector_to_array(F.col("probability")), 1)).alias("p")).agg(F.max("p")).first()[0]
    matrix = model.coefficientMatrix.toArray().tolist()
    found = len(matrix)  # classes without a row in the sample come last and have no weights
    return Model(classes[:found], features, matrix, model.interceptVector.toArray().tolist(), min(0.95, max(0.5, worst or 0.0)))


def _templates(family: str | None = None) -> list[list[str]]:
    return [_grams(_words(t), (2,)) for f, texts in NOTICES.items() if family in (None, f) for t in texts]


def _likeness(pairs: Column, family: str | None = None) -> Column:
    """Largest share of a notice's word pairs found in the paragraph."""
    return F.greatest(F.lit(0.0), *[
        F.size(F.array_intersect(pairs, F.array(*map(F.lit, t)))) / F.lit(len(t)) for t in _templates(family)])


def _margins(w: Column, m: Model) -> tuple[Column, Column]:
    """Features ``at`` of a paragraph of the words ``w``, and the classes' margins from column ``at``."""
    known = F.array(*map(F.lit, m.features))
    at = F.transform(F.array_intersect(grams(w), known), lambda g: F.array_position(known, g).cast("int"))

    def margin(weights: list[float], intercept: float) -> Column:
        return F.aggregate("at", F.lit(intercept), lambda a, i: a + F.element_at(F.array(*map(F.lit, weights)), i))

    return at, F.array(*[margin(w, b) for w, b in zip(m.weights, m.intercepts, strict=True)])


def _probabilities(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("e", F.transform("m", lambda x: F.exp(x - F.array_max("m"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("p", F.transform("e", lambda x: x / total))


def _wrapped(rows: DataFrame, m: Model) -> DataFrame:
    """Notices that only stand in several lines together: rows for each of their lines but the last."""
    rows = rows.filter(F.size("tail") > 0).filter(F.arrays_overlap(grams(F.concat("w", "tail"), (2,)), F.array(*map(F.lit, telling_pairs()))))
    rows = stored(rows.drop("m"), "license-near").withColumn("pairs", grams(F.concat("w", "tail"), (2,)))
    both = F.array(*[_likeness(F.col("pairs"), c) for c in m.classes[1:]])
    rows = stored(rows.withColumn("both", both).filter(F.array_max("both") >= CONFIRM).drop("pairs"), "license-windows")
    for name, w in (("alone", "w"), ("after", "tail")):
        rows = rows.withColumn("pairs", grams(F.col(w), (2,))).withColumn(name, F.array(*[_likeness(F.col("pairs"), c) for c in m.classes[1:]]))
    # a family counts when the line alone is no notice of it and adds to what follows
    fits = F.transform("both", lambda x, i: F.when((x >= CONFIRM) & (F.col("alone")[i] < CONFIRM) & (F.col("after")[i] < x), x).otherwise(0.0))
    rows = rows.withColumn("similarity", F.array_max(fits)).withColumn("place", F.array_position(fits, F.array_max(fits)).cast("int"))
    rows = rows.filter(F.col("similarity") > 0).withColumn("w", F.concat("w", "tail"))
    rows = stored(rows.select("row", "doc_id", "paragraph", "w", "similarity", "place"), "license-wrapped")
    at, margins = _margins(F.col("w"), m)
    rows = _probabilities(rows.withColumn("at", at).withColumn("m", margins))
    return rows.select("row", "doc_id", "paragraph", F.element_at(F.array(*map(F.lit, m.classes[1:])), F.col("place")).alias("family"),
                       F.element_at("p", F.col("place") + 1).alias("probability"), "similarity", F.size("w").alias("n_words"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per licence notice: doc_id, paragraph (its first line's number from 0), family
    (or ``unknown``), probability, similarity, n_words (of a wrapped notice: its first
    line's and those after it that were compared)."""
    m = model or fit(docs)
    strong, telling = strong_words(m), telling_words()
    anchors = F.array(*map(F.lit, telling))
    # a text without these words has no notice
    near = docs.filter(F.arrays_overlap(words(F.col("text")), F.array(*map(F.lit, sorted({*strong, *telling})))))
    tail = F.when((F.size("w") > 0) & (F.arrays_overlap("w", anchors) | F.arrays_overlap("tail", anchors)), F.col("tail"))
    rows = paragraphs(near).withColumn("tail", tail).filter(
        F.arrays_overlap("w", F.array(*map(F.lit, strong)).cast("array<string>")) | (F.size("tail") > 0))
    at, margins = _margins(F.col("w"), m)
    # written: the filter below would otherwise repeat the n-grams for every margin
    stored_rows = stored(rows.withColumn("at", at).select("row", "doc_id", "paragraph", "w", "tail", margins.alias("m")), "license-margins")
    rows = _probabilities(stored_rows).filter(F.col("p")[0] < 0.5)
    families = F.slice("p", 2, len(m.classes) - 1)
    rows = rows.withColumn("probability", F.array_max(families))
    best = F.element_at(F.array(*map(F.lit, m.classes[1:])), F.array_position(families, F.col("probability")).cast("int"))
    rows = rows.withColumn("family", best).withColumn("pairs", grams(F.col("w"), (2,)))
    similarity = F.lit(0.0)
    for c in m.classes[1:]:
        similarity = F.when(F.col("family") == c, _likeness(F.col("pairs"), c)).otherwise(similarity)
    rows = rows.withColumn("similarity", similarity)
    sure = (F.col("probability") >= m.level) & (F.col("similarity") >= CONFIRM)
    rows = rows.select("row", "doc_id", "paragraph", F.when(sure, F.col("family")).otherwise("unknown").alias("family"), "probability",
                       "similarity", F.size("w").alias("n_words"), F.lit(False).alias("wrapped"))
    rows = rows.unionByName(_wrapped(stored_rows, m).withColumn("wrapped", F.lit(True)))
    before = Window.partitionBy("row").orderBy("paragraph").rangeBetween(-1, -1)
    here = Window.partitionBy("row", "paragraph")
    last = F.max(F.when(F.col("wrapped"), F.col("family"))).over(before)
    rows = rows.withColumn("last", last).withColumn("starts", F.max("wrapped").over(here))
    # the first line stands for a wrapped notice; its lines are no unknown ones besides
    rows = rows.filter(F.when(F.col("wrapped"), F.coalesce(F.col("last") != F.col("family"), F.lit(True))).otherwise(
        (F.col("family") != "unknown") | (F.col("last").isNull() & ~F.col("starts"))))
    return rows.select("doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"),
                       F.round("similarity", 6).alias("similarity"), F.col("n_words").cast("long").alias("n_words"))
