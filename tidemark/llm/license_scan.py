"""License scan: a trained classifier of paragraphs' word windows, confirmed by comparison with templates.

A softmax regression over sparse word bigrams and trigrams tells licence families and `unknown`
apart. It sees windows of `WINDOWS` words that begin with one of the templates' word runs, so that a
paragraph that names two licences gives both, and a long one is judged where it speaks of licences.
It is trained here: the positives are windows of variants of each family's templates (words dropped,
cut short, set in running text of the corpus), the negatives windows of a bounded sample of the
corpus's own paragraphs (`max_background`, those with the smallest hash; the only part that doesn't see
all rows). One fifth of the rows calibrates: a temperature makes the probabilities fit, and a family
must reach a probability that no window of that fifth's whole paragraphs had for any family.

Scanning streams whole texts. A paragraph is a line; one without any of the model's word runs has
the score of `unknown`, and is passed over. Of overlapping windows the one that holds most of the word
pairs of its family's template counts, then the shorter, the likelier and the earlier one. A
prediction is confirmed if its window holds enough of these pairs.

Defined results: one row per paragraph and family that the classifier finds in it; NULL, empty and
unlicensed texts give none, nor does an empty table; texts and paragraphs of any length are taken whole.
Ties go to the earlier family in order of names; repeated rows and lines each give their own; ids are
passed on, and only the two named columns are read, whatever others are called.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BACKGROUND = 4_000
# Words of the windows, and windows of one background paragraph that train the model.
WINDOWS = (6, 12, 32)
TRAINED = 8
VARIANTS = 60
CONFIRMED = 0.6
UNKNOWN = "unknown"
TOKEN = r"[^\W_]+(?:[.\-][^\W_]+)*"

# Statements by which documents name their licence, by family.
TEMPLATES = {
    "all-rights-reserved": ("All rights reserved.", "No part of this publication may be reproduced without prior written permission."),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "bsd": (
        "This source code is licensed under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc0": ("This work is dedicated to the public domain under CC0 1.0 Universal.", "No rights reserved, released under CC0 1.0."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "mit": (
        "Released under the MIT License.", "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
}


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def runs(words: list[str]) -> set[tuple]:
    return {*zip(words, words[1:]), *zip(words, words[1:], words[2:])}


def pairs(words: list[str]) -> set[tuple]:
    return {*zip(words, words[1:])}


def similarity(words: list[str], template: str) -> float:
    """Share of the template's word pairs that the words hold."""
    own = pairs(tokens(template))
    return len(own & pairs(words)) / len(own)


def hits(words: list[str], vocabulary: dict) -> list[tuple[int, int, int]]:
    """(from, to, number) of the known word runs, in order."""
    out = []
    for n in (2, 3):
        out += [(i, i + n, vocabulary[run]) for i, run in enumerate(zip(*(words[k:] for k in range(n)))) if run in vocabulary]
    return sorted(out)


def windows(found: list[tuple[int, int, int]]) -> list[tuple[int, int, frozenset]]:
    """(from, to, runs): the known runs of each window that begins with one, from the first to the last
    word that they cover; windows with the same runs in the same place once."""
    out = {}
    for k, (start, _, _) in enumerate(found):
        if k and found[k - 1][0] == start:
            continue
        for size in WINDOWS:
            inside, end, j = set(), start, k
            while j < len(found) and found[j][0] < start + size:
                if found[j][1] <= start + size:
                    inside.add(found[j][2])
                    end = max(end, found[j][1])
                j += 1
            if inside:
                out[start, end] = frozenset(inside)
    return [(start, end, inside) for (start, end), inside in out.items()]


def _variants(background: list[list[str]], rng: random.Random):
    """(words, family) for training; background words are woven around the statements."""
    for family, templates in TEMPLATES.items():
        for template in templates:
            base = tokens(template)
            for k in range(VARIANTS):
                words = list(base) if k % 3 == 0 else [w for w in base if rng.random() > 0.1]
                if k % 3 == 2 and len(base) > 8:
                    start = rng.randrange(0, len(words) // 3 + 1)
                    words = words[start:start + max(5, 2 * len(words) // 3)]
                if background and k % 2:
                    around = rng.choice(background)
                    cut = rng.randint(0, len(around))
                    words = around[max(0, cut - 12):cut] + words + around[cut:cut + 12]
                yield words, family


def fit(paragraphs: list[str], seed: int = 7) -> dict:
    """Train and calibrate on background paragraphs and template variants."""
    rng = random.Random(seed)
    texts = [tokens(p) for p in paragraphs]
    # Paragraphs that hold half of a template are no background.
    background = [w for w in texts if w and all(similarity(w, t) < 0.5 for ts in TEMPLATES.values() for t in ts)]
    classes = [*sorted(TEMPLATES), UNKNOWN]
    by_family = {f: set().union(*(runs(tokens(t)) for t in ts)) for f, ts in TEMPLATES.items()}
    vocabulary = {run: k for k, run in enumerate(sorted(set().union(*by_family.values())))}
    # Runs that only one family has tell a window of its statement from one of common words.
    own = {f: {vocabulary[r] for r in rs if sum(r in other for other in by_family.values()) == 1} for f, rs in by_family.items()}
    order = list(range(len(background)))
    rng.shuffle(order)
    apart = [background[k] for k in order[::5]]
    rows = [(inside, f) for words, f in _variants(background, rng) for *_, inside in windows(hits(words, vocabulary)) if inside & own[f]]
    for k in order:
        some = [inside for *_, inside in windows(hits(background[k], vocabulary))]
        rows += [(inside, UNKNOWN) for inside in (some if len(some) <= TRAINED else rng.sample(some, TRAINED))]
    rows += [(frozenset(), UNKNOWN)] * 20
    x = np.zeros((len(rows), len(vocabulary) + 1), dtype=np.float64)
    x[:, -1] = 1.0
    for k, (inside, _) in enumerate(rows):
        x[k, list(inside)] = 1.0
    y = np.array([classes.index(c) for _, c in rows])
    order = list(range(len(rows)))
    rng.shuffle(order)
    held = np.zeros(len(rows), dtype=bool)
    held[order[::5]] = True

    def probabilities(features, w, temperature=1.0):
        z = features @ w / temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    train, target = x[~held], np.eye(len(classes))[y[~held]]
    # Every class weighs the same, whatever the size of the background.
    weight = (1 / np.maximum(1, target.sum(axis=0)))[y[~held]][:, None]
    w, speed = np.zeros((x.shape[1], len(classes))), np.zeros((x.shape[1], len(classes)))
    for _ in range(400):
        gradient = train.T @ (weight * (probabilities(train, w) - target)) + 1e-4 * w
        speed = 0.9 * speed - 0.5 * gradient
        w = w + speed
    grid = [2.0 ** (k / 4) for k in range(-16, 9)]
    right = lambda t: np.log(probabilities(x[held], w, t)[np.arange(held.sum()), y[held]] + 1e-12).mean()
    temperature = max(grid, key=right)
    model = {"classes": classes, "vocabulary": vocabulary, "weights": w / temperature, "least": 0.5}
    seen = {inside for words in apart for *_, inside in windows(hits(words, vocabulary))}
    highest = max((probability for inside in seen for family, probability in [_judge(inside, model)] if family != UNKNOWN), default=0.0)
    return model | {"least": min(0.99, max(0.5, highest + 1e-6))}


def _judge(inside: frozenset, model: dict) -> tuple[str, float]:
    """The likeliest class of a window and its probability."""
    z = model["weights"][list(inside)].sum(axis=0) + model["weights"][-1]
    z = np.exp(z - z.max())
    z /= z.sum()
    best = int(z.argmax())
    return model["classes"][best], float(z[best])


def classify(words: list[str], model: dict) -> list[tuple[str, float, str, float]]:
    """(family, probability, template, similarity) of each licence that a paragraph's words name."""
    candidates = []
    for start, end, inside in windows(hits(words, model["vocabulary"])):
        family, probability = _judge(inside, model)
        if family != UNKNOWN and probability >= model["least"]:
            shares = [similarity(words[start:end], t) for t in TEMPLATES[family]]
            best = int(np.argmax(shares))
            candidates.append((-shares[best], end - start, -probability, start, family, best))
    taken, out = [], {}
    for share, size, probability, start, family, best in sorted(candidates):
        if all(start + size <= a or b <= start for a, b in taken):
            taken.append((start, start + size))
            out.setdefault(family, (family, -probability, f"{family}-{best + 1}", -share))
    return [out[f] for f in sorted(out)]


def background_sample(docs: DataFrame, text: str = "text", count: int = MAX_BACKGROUND) -> list[str]:
    """Up to `count` paragraphs: of documents spread over all, the one with the smallest hash."""
    body = docs.select(F.col(f"`{text}`").alias("text")).where("trim(text) <> ''")
    total = body.count()
    cut = -(2**63) + min(2**64 - 1, 2**64 * 3 * count // (2 * max(1, total)))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    first = F.array_min(F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("line"))))
    # Copies have one hash and one paragraph; they are merged before anything moves.
    picked = body.where(F.xxhash64("text") <= cut).select(first.alias("p")).select("p.h", "p.line").groupBy("h", "line").count()
    return [r["line"] for r in picked.orderBy("h", "line").limit(count).collect()]


def scan(docs: DataFrame, model: dict, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, paragraph, start, length, family, probability, template, similarity, confirmed)."""
    firsts = {run[:2] for run in model["vocabulary"]}

    def find(batches):
        for batch in batches:
            out = []
            for key, body in zip(batch["key"], batch["text"]):
                at = 0
                for number, line in enumerate((body or "").split("\n")):
                    words = tokens(line)
                    if not firsts.isdisjoint(zip(words, words[1:])):
                        for family, probability, template, share in classify(words, model):
                            out.append((key, number, at, len(line), family, probability, template, share, share >= CONFIRMED))
                    at += len(line) + 1
            yield pd.DataFrame(out, columns=["key", "paragraph", "start", "length", "family", "probability", "template", "similarity", "confirmed"])

    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    found = source.mapInPandas(
        find, "key string, paragraph int, start bigint, length bigint, family string, probability double, "
        "template string, similarity double, confirmed boolean",
    )
    return found.select(F.col("key").cast(docs.schema[id_column].dataType).alias(id_column), *found.columns[1:])


def license_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", max_background: int = MAX_BACKGROUND) -> DataFrame:
    """Train on the documents' own background, then scan all of them."""
    return scan(docs, fit(background_sample(docs, text, max_background)), id_column, text)
