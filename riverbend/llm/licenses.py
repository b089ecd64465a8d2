"""Licence notices in texts: a trained paragraph classifier, confirmed by templates.

A notice stands on one line or is wrapped over consecutive lines that all have words; punctuation such as comment marks
is no word, and ``LINE_MARKS`` at the start of a line aren't read.  Every line is judged whole.  Besides, spans of words
that cross a line break are proposed where enough word pairs of one template lie near each other, and are judged by the
same rules.  Where notices share words, the one that holds more pairs stays, and one family's are joined.

Softmax regression over hashed word 1-, 2- and 3-grams tells licence families from ``unknown``.
It is fitted on variants of the templates below, with words lost and words of the corpus around them, against
paragraphs of a bounded corpus sample, torn templates and everyday sentences about licences.  A fifth of these is held
out: on it the logits' temperature is chosen by likelihood and then the least probability of a family by ``FALSE_RATE``
of the unknown.  A paragraph of a family must also hold enough of the word pairs of one of the family's templates.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_words, ship
from .decontaminate import words

FEATURES = 1 << 15
ORDERS = 3
#: Variants of each template, and how many different texts, with how many lines, lend paragraphs at most.
VARIANTS, TRAIN_DOCS, TRAIN_LINES = 40, 400, 20_000
FALSE_RATE = 0.001
#: Share of a template's word pairs that a paragraph must hold.
CONFIRMED = 0.6
#: Most words of a span over lines, in words of its template.
REACH = 2
#: Comment marks that are words.
LINE_MARKS = ("dnl", "rem")
TEXT_BYTES = 4 << 20

#: Short notices as they are usually written.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT"),
    "reserved": (
        "All rights reserved.",
        "Copyright by the authors. All rights reserved. No part of this work may be reproduced without permission."),
}
FAMILIES = ("unknown", *TEMPLATES)
EVERYDAY = (
    "You need a driving licence to rent a car.", "She reserved a table for all of us.", "The general public may enter.",
    "The version of the story that he told was under the table.", "Free of charge, the museum opens at nine.",
    "All rights and duties of members follow from the statutes.", "A fishing license is issued by the county.",
    "The commons were open to all creative people.", "This program begins at eight and is free.")


def grams(hashed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, hashed feature) of all 1-, 2- and 3-grams."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    rows, features = [], []
    for order in range(1, ORDERS + 1):
        n = max(len(hashed) - order + 1, 0)
        h = np.full(n, np.uint64(order), np.uint64)
        for k in range(order):
            h = (h ^ hashed[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        inside = owner[:n] == owner[order - 1:order - 1 + n]
        rows.append(owner[:n][inside])
        features.append((h[inside] >> np.uint64(40)).astype(np.int64) % FEATURES)
    return np.concatenate(rows), np.concatenate(features)


@dataclass
class Classifier:
    weight: np.ndarray  # feature, family
    base: np.ndarray
    temperature: float
    least: float

    def logits(self, hashed: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.of_grams(*grams(hashed, offsets), len(offsets) - 1)

    def of_grams(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
        out = np.stack([np.bincount(rows, self.weight[features, k], n) for k in range(len(FAMILIES))], axis=1)
        return out / size[:, None] + self.base

    def probabilities(self, hashed: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(hashed, offsets) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pairs(texts: list[str]) -> list[set[tuple[int, int]]]:
    hashed, offsets = words(pa.array(texts, pa.string()))
    own = [hashed[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [set(zip(w[:-1], w[1:], strict=True)) for w in own]


@lru_cache(1)
def template_pairs() -> dict[str, list[set[tuple[int, int]]]]:
    return {family: _pairs(list(templates)) for family, templates in TEMPLATES.items()}


def _pair_keys(hashed: np.ndarray) -> np.ndarray:
    """A hash for every pair of consecutive words."""
    h = (hashed[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ hashed[1:]
    return h * np.uint64(0xC2B2AE3D27D4EB4F) ^ h >> np.uint64(29)


@lru_cache(1)
def template_keys() -> list[np.ndarray]:
    """The sorted pair keys of every template."""
    hashed, offsets = words(pa.array([t for templates in TEMPLATES.values() for t in templates]))
    return [np.unique(_pair_keys(hashed[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def similarity(own: set[tuple[int, int]], family: str) -> float:
    """The largest share of a template's word pairs that a paragraph holds, over the family's templates."""
    return max(len(t & own) / len(t) for t in template_pairs()[family])


def _piece(own: set[tuple[int, int]]) -> bool:
    """Whether a line looks like a part of a wrapped notice, which is no example of ordinary text."""
    return bool(own) and max(len(t & own) for family in template_pairs().values() for t in family) >= CONFIRMED * len(own)


def _examples(paragraphs: list[str], rnd: random.Random) -> tuple[list[str], list[int]]:
    pool = [w for p in paragraphs for w in p.split()] or ["the"]
    some = lambda most: " ".join(rnd.choices(pool, k=rnd.randint(0, most)))
    texts, labels = [], []
    for number, (_, templates) in enumerate(TEMPLATES.items(), 1):
        for template in templates:
            for k in range(VARIANTS):
                tokens = template.split()
                if k and len(tokens) > 4:
                    tokens = [w for w in tokens if rnd.random() > 0.08]
                text = " ".join(tokens)
                if k % 3 == 1:
                    text = f"{some(8)} {text} {some(8)}"
                texts.append(text.upper() if k % 10 == 9 else text)
                labels.append(number)
                if k % 4 == 0:  # torn: a third of the words, in another order
                    torn = rnd.sample(template.split(), max(1, len(template.split()) // 3))
                    texts.append(f"{some(10)} {' '.join(torn)} {some(10)}")
                    labels.append(0)
    ordinary = [p for p in (*paragraphs, *EVERYDAY * 5) if p.strip()]
    for p, own in zip(ordinary, _pairs(ordinary), strict=True):
        if max(similarity(own, f) for f in TEMPLATES) < CONFIRMED and not _piece(own):
            texts.append(p)
            labels.append(0)
    return texts, labels


def fit(paragraphs: list[str], seed: int = 5, steps: int = 120) -> Classifier:
    """Fit and calibrate on the templates' variants and on ordinary paragraphs."""
    rnd = random.Random(seed)
    texts, labels = _examples(paragraphs, rnd)
    order = rnd.sample(range(len(texts)), len(texts))
    held = order[:len(order) // 5]
    hashed, offsets = words(pa.array([texts[i] for i in order[len(held):]]))
    y = np.array([labels[i] for i in order[len(held):]])
    rows, features = grams(hashed, offsets)
    value = 1 / np.sqrt(np.bincount(rows, minlength=len(y)))[rows]
    each = 1 / np.bincount(y, minlength=len(FAMILIES))[y] / len(FAMILIES)
    model = Classifier(np.zeros((FEATURES, len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, 0.0)
    first, second = np.zeros((2, FEATURES, len(FAMILIES)))
    target = np.eye(len(FAMILIES))[y]
    for t in range(1, steps + 1):
        wrong = (_softmax(model.of_grams(rows, features, len(y))) - target) * each[:, None]
        slope = np.stack([np.bincount(features, wrong[rows, k] * value, FEATURES) for k in range(len(FAMILIES))], axis=1)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        model.weight = model.weight - 0.2 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-7)
        model.base = model.base - 2 * wrong.sum(axis=0)
    model.weight = model.weight.astype(np.float32)
    truth = np.array([labels[i] for i in held])
    logits = model.logits(*words(pa.array([texts[i] for i in held])))
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in (0.25, 0.5, 1.0, 2.0, 4.0, 8.0)}
    model.temperature = min(loss, key=loss.get)
    unknown = _softmax(logits / model.temperature)[truth == 0]
    model.least = float(max(0.5, np.quantile(unknown[:, 1:].max(axis=1), 1 - FALSE_RATE))) if len(unknown) else 0.5
    return model


def train(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Classifier:
    """Fit with paragraphs of ``train_docs`` different texts at most, ``TRAIN_LINES`` lines at most; of both the ones with
    the least hashes, so that copies count once and what is drawn doesn't hang on the order of rows."""
    base = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    share = int(min(1, 1.2 * train_docs / max(base.count(), 1)) * (1 << 40)) + 1
    drawn = base.withColumn("h", F.xxhash64("text")).where(F.pmod(F.xxhash64("h"), F.lit(1 << 40)) < share)
    drawn = drawn.groupBy("h").agg(F.first("text").alias("text")).orderBy("h").limit(train_docs)
    lines = drawn.select(F.explode(F.split("text", "\n")).alias("line")).distinct().orderBy(F.xxhash64("line"), "line").limit(TRAIN_LINES)
    return fit(sorted(lines.toArrow()["line"].to_pylist()))


@dataclass
class Notice:
    line: int
    last_line: int
    family: str
    probability: float
    similarity: float
    held: int  # word pairs of the template
    begin: int  # words from the first to the last of these
    end: int


def _notice(hashed: np.ndarray, begin: int, family: str, probability: float) -> Notice | None:
    """The words, which start at ``begin``, as a notice of the family, or None where they don't hold enough of a template."""
    pairs = list(zip(hashed[:-1].tolist(), hashed[1:].tolist(), strict=True))
    own = set(pairs)
    best = max(template_pairs()[family], key=lambda t: (len(t & own) / len(t), len(t)))
    alike = len(best & own) / len(best)
    if alike < CONFIRMED:
        return None
    places = [k for k, p in enumerate(pairs) if p in best]
    return Notice(0, 0, family, probability, alike, len(best & own), begin + places[0], begin + places[-1] + 2)


def _judge(model: Classifier, hashed: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, float]]:
    """(text, family, probability) where the classifier tells a family."""
    chance = model.probabilities(hashed, offsets)
    family = chance[:, 1:].argmax(axis=1) + 1
    best = chance[np.arange(len(family)), family]
    for at in np.flatnonzero((best >= model.least) & (best > chance[:, 0]) & (np.diff(offsets) > 0)):
        yield int(at), FAMILIES[family[at]], float(best[at])


def _on_lines(model: Classifier, hashed: np.ndarray, offsets: np.ndarray) -> list[Notice]:
    """The lines that are notices."""
    out = []
    for at, family, probability in _judge(model, hashed, offsets):
        if got := _notice(hashed[offsets[at]:offsets[at + 1]], int(offsets[at]), family, probability):
            got.line = got.last_line = at
            out.append(got)
    return out


def _spans(hashed: np.ndarray, line: np.ndarray, paragraph: np.ndarray) -> set[tuple[int, int]]:
    """(begin, end) of spans of words that cross a line break inside a paragraph and hold enough pairs of a template."""
    keys = _pair_keys(hashed)
    every = np.unique(np.concatenate(template_keys()))
    hit = np.flatnonzero((every[np.minimum(np.searchsorted(every, keys), len(every) - 1)] == keys) & (paragraph[:-1] == paragraph[1:]))
    spans = set()
    for template in template_keys():
        at = hit[np.isin(keys[hit], template)]
        need, reach = max(1, int(np.ceil(CONFIRMED * len(template) - 1e-9))), REACH * (len(template) + 1)
        stop = np.minimum(np.searchsorted(at, at + reach - 2, side="right"), np.searchsorted(paragraph[at], paragraph[at], side="right"))
        found = []
        for i in np.flatnonzero((stop - np.arange(len(at)) >= need) & (line[at[stop - 1] + 1] != line[at])):
            held, best = set(), None
            for k in at[i:stop[i]].tolist():
                if keys[k] not in held:
                    held.add(keys[k])
                    length = k + 2 - int(at[i])
                    if len(held) >= need and (best is None or 2 * len(held) - length >= best[0]):
                        best = 2 * len(held) - length, k + 2
            if best and line[best[1] - 1] != line[at[i]]:
                found.append((-best[0], int(at[i]), best[1]))
        taken: set[int] = set()
        for _, begin, end in sorted(found):
            if taken.isdisjoint(range(begin, end)):
                taken.update(range(begin, end))
                spans.add((begin, end))
    return spans


def _over_lines(model: Classifier, hashed: np.ndarray, offsets: np.ndarray, first_lines: np.ndarray) -> list[Notice]:
    """The notices that are wrapped over lines; ``first_lines`` are the lines that begin a text."""
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = np.ones(len(hashed), bool)
    first = offsets[:-1][np.diff(offsets) > 0]
    keep[first[np.isin(hashed[first], hash_words(pa.array(LINE_MARKS)))]] = False
    place, line, plain = np.flatnonzero(keep), line[keep], hashed[keep]
    if len(plain) < 2:
        return []
    new = np.zeros(len(offsets) - 1, bool)
    new[first_lines] = True
    new[1:] |= np.bincount(line, minlength=len(new))[:-1] == 0
    spans = sorted(_spans(plain, line, np.cumsum(new)[line]))
    if not spans:
        return []
    out = []
    texts = [plain[a:b] for a, b in spans]
    for k, family, probability in _judge(model, np.concatenate(texts), np.cumsum([0, *map(len, texts)])):
        if got := _notice(texts[k], spans[k][0], family, probability):
            got.line, got.last_line = int(line[got.begin]), int(line[got.end - 1])
            got.begin, got.end = int(place[got.begin]), int(place[got.end - 1]) + 1
            out.append(got)
    return out


def _settle(notices: list[Notice], n_words: int) -> list[Notice]:
    """Notices that share no word: the one with more pairs stays, and takes in those of its family."""
    owner = np.full(n_words, -1)
    out: list[Notice] = []
    for n in sorted(notices, key=lambda n: (-n.held, n.begin, n.end)):
        mine = owner[n.begin:n.end]
        others = [out[k] for k in np.unique(mine[mine >= 0])]
        if not others:
            mine[:] = len(out)
            out.append(n)
        elif all(o.family == n.family for o in others):
            o = others[0]
            mine[mine < 0] = owner[o.begin]
            o.line, o.last_line = min(o.line, n.line), max(o.last_line, n.last_line)
            o.probability, o.similarity = max(o.probability, n.probability), max(o.similarity, n.similarity)
    return out


def _scan(model: Classifier):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text", TEXT_BYTES):
            lists = pc.split_pattern(pc.fill_null(batch.column("text").cast(pa.string()), ""), "\n")
            line_at = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            hashed, offsets = words(lists.flatten())
            notices = _on_lines(model, hashed, offsets)
            if wrapped := _over_lines(model, hashed, offsets, line_at[:-1]):
                notices = _settle(notices + wrapped, len(hashed))
            rows = []
            for n in sorted(notices, key=lambda n: (n.line, n.begin)):
                doc = int(np.searchsorted(line_at, n.line, side="right")) - 1
                rows.append((doc, n.line - int(line_at[doc]), n.last_line - int(line_at[doc]), n.family, n.probability, n.similarity))
            doc, line, last, name, score, alike = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.record_batch([batch.column("id").take(pa.array(doc, pa.int64())), pa.array(line, pa.int64()), pa.array(last, pa.int64()),
                                   pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(alike, pa.float64())],
                                  ["id", "line", "last_line", "family", "probability", "similarity"])
    return scan


def find_licenses(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, last_line, family, probability, similarity), a row for each licence notice with its first and last
    line; lines from 0.

    Null, empty and wordless texts have none.  Null ids are kept and repeated rows give their rows again; an empty
    table gives an empty one; other columns are not read.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, line long, last_line long, family string, probability double, similarity double"
    return base.mapInArrow(_scan(model), schema).withColumnRenamed("id", id_col)
