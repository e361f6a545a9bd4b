"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line, or neighbouring lines without a blank one between them that only together hold a notice, as
hard-wrapped notices do; such a run is numbered by its first line. Its word n-grams (one and two words) are sparse features of a logistic regression over
licence families, licences of no such family, and ordinary text. The model is trained here: on variations of the family
templates, on notices of other licences under real and made-up names as the unknown class, and, as ordinary text, on
paragraphs of a bounded sample of documents and on sentences that use the words of licences for other things.
Probabilities are calibrated by a temperature fitted on examples kept from training. What is probably no ordinary text
is a licence. Its family counts if it is the likeliest class, with at least ``FAMILY_PROBABILITY``, and a template of
it confirms it by enough of its three-word sequences; otherwise the licence is unknown.

Words that no notice and none of those sentences has are no features. The weakest features together cannot lift any family over ordinary text
(their weights are bounded by Cauchy-Schwarz against the intercepts); a paragraph without one of the words of the
others is ordinary and not scored further, so the result is that of scoring every paragraph.

Defined results: null and empty texts have no paragraphs; blank paragraphs are numbered but never licences. All of a
long text is scanned. Repeated rows give repeated results; a null doc_id stays null; other columns are ignored.
Without any document the model has no ordinary examples and the result is empty.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table, texts

#: bounds of the sample of ordinary text that the model is trained on
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS, SAMPLE_CHARS, SPARE_PARAGRAPHS = 1500, 2, 2000, 300
VARIATIONS, STEPS, RATE, DECAY = 40, 150, 0.3, 1e-4
LICENCE_PROBABILITY, FAMILY_PROBABILITY, SIMILARITY = 0.5, 0.6, 0.6

# fixed values: notices by licence family
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
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
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "reserved": (
        "All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
    ),
}
# fixed values: notices of other licences, with a place for a name, and names
OTHER_NOTICES = (
    "Licensed under the {} License.",
    "Licensed under the {} licence, version 9.",
    "Distributed under the {} License.",
    "Released under the terms of the {} License.",
    "This software is made available under the {} Public License, version 2.",
    "Use of this work is governed by the {} license agreement.",
    "This package is copyrighted by {} and licensed for internal use only.",
    "You may use, copy and modify this material under the conditions of the {} license.",
    "Permission to use, copy, modify and distribute this software for any purpose with or without fee is hereby granted by {}.",
    "This software is provided by {} as is, without any express or implied warranty, under its own license.",
    "The text is subject to the {} licence; see the file for its terms.",
)
OTHER_NAMES = (
    "ISC", "Eclipse", "Artistic", "zlib", "Boost Software", "Python Software Foundation", "SIL Open Font", "European Union",
    "GNU Lesser General", "GNU Affero General", "Microsoft Reciprocal", "Academic Free", "Open Software",
)
# fixed values: sentences in which the words of licences say other things
ORDINARY_SENTENCES = (
    "the license plates of the {} were new",
    "she renewed her driving licence in the {}",
    "his fishing license had expired before the {}",
    "people have the same rights as the {}",
    "all of the {} stood on the right of the road",
    "they asked the {} for permission to leave",
    "no part of the {} was sold",
    "the general went to the public house near the {}",
    "version 2.0 of the {} is here",
    "the work on the {} is free for any person",
    "under the {} there is a copy of the file",
    "this {} is subject to change in the source",
    "the apache and the mozilla met the {} in the commons",
    "the mit of the {} and the public",
    "copyright is a subject that the {} teaches",
    "they must redistribute the food to the {}",
)
# fixed values: words of notices that say nothing about licences by themselves
FUNCTION_WORDS = tuple(
    "a all and any are as be by can do for free from in is it its may no not of on or out own part that the this to under use "
    "version with without work you 0 1 2 3 4".split()
)
FRAMES = ("{}", "Note: {}", "{} See the file for details.", "This document is offered as follows. {}", "(c) The authors. {}")

SCHEMA = "doc_id long, paragraph int, start int, end int, family string, probability double, similarity double"

_words = re.compile(r"[^\W_]+").findall


def ngrams(words: list[str]) -> set[str]:
    return {*words, *map(" ".join, zip(words, words[1:], strict=False))}


def trigrams(words: list[str]) -> set[tuple]:
    return set(zip(words, words[1:], words[2:], strict=False)) or {tuple(words)}


#: runs of lines beyond twice the words of the longest template are not joined
RUN_WORDS = 2 * max(len(_words(t)) for ts in TEMPLATES.values() for t in ts)


@dataclass
class Model:
    """``weights[feature]``: one weight per class; class 0 is ordinary text, the last one licences of no family."""

    families: list[str]
    weights: dict[str, np.ndarray]
    bias: np.ndarray
    temperature: float
    telling: frozenset[str]  # words without which a paragraph is ordinary
    templates: dict[str, list[set]]

    def probabilities(self, words: list[str]) -> np.ndarray:
        known = [self.weights[g] for g in ngrams(words) if g in self.weights]
        z = (self.bias + (np.sum(known, axis=0) / np.sqrt(len(known)) if known else 0.0)) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def judge(self, paragraph: str) -> tuple[str, float, float] | None:
        """(family or unknown, probability of a licence, template similarity) of a licence paragraph."""
        words = _words(paragraph.lower())
        if self.telling.isdisjoint(words):
            return None
        p = self.probabilities(words)
        licence = 1.0 - float(p[0])
        if licence < LICENCE_PROBABILITY:
            return None
        own, likeliest = trigrams(words), 1 + int(np.argmax(p[1:]))
        family = self.families[int(np.argmax(p[1 : 1 + len(self.families)]))]
        similarity = max(len(own & t) / len(t) for t in self.templates[family])
        sure = likeliest <= len(self.families) and float(p[likeliest]) >= FAMILY_PROBABILITY and similarity >= SIMILARITY
        return family if sure else "unknown", licence, similarity

    def paragraphs(self, lines: list[str]) -> list[tuple[int, int, tuple]]:
        """(first line, last line, judgement) of the licence paragraphs of a text."""
        out = [(i, i, found) for i, line in enumerate(lines) if (found := self.judge(line))]
        taken = {i for i, _, found in out if found[0] != "unknown"}
        words = [_words(line.lower()) for line in lines]
        tells = [not self.telling.isdisjoint(w) for w in words]
        runs, free = [], 0  # lines before free belong to a run
        for j in range(1, len(lines)):
            if j < free:
                continue
            i, total, told = j, len(words[j]), tells[j]
            while i > free and i not in taken and lines[i].strip() and i - 1 not in taken and lines[i - 1].strip():
                i, total, told = i - 1, total + len(words[i - 1]), told or tells[i - 1]
                if total > RUN_WORDS:
                    break
                found = self.judge("\n".join(lines[i : j + 1])) if told else None
                if not found or found[0] == "unknown":
                    continue
                last = j
                while last + 1 < len(lines) and lines[last + 1].strip() and last + 1 not in taken:
                    more = self.judge("\n".join(lines[i : last + 2]))
                    if not more or more[0] != found[0] or more[2] <= found[2]:
                        break
                    last, found = last + 1, more
                runs.append((i, last, found))
                free = last + 1
                break
        covered = {k for i, j, _ in runs for k in range(i, j + 1)}
        return sorted([x for x in out if x[0] not in covered] + runs)


def _variations(rng: np.random.RandomState, ordinary: list[list[str]]) -> list[tuple[list[str], int]]:
    """Templates in frames and among ordinary words, with some of their words left out."""
    out = []
    for label, notices in enumerate(TEMPLATES.values(), start=1):
        for notice in notices:
            for k in range(VARIATIONS):
                words = _words(FRAMES[k % len(FRAMES)].format(notice).lower())
                if k >= len(FRAMES):
                    words = [w for w in words if rng.rand() > 0.1]
                if k % 2 and ordinary:
                    around = ordinary[rng.randint(len(ordinary))][: rng.randint(1, 12)]
                    words = around + words if k % 4 == 1 else words + around
                out.append((words, label))
    return out


def _filled(rng: np.random.RandomState, frames: tuple[str, ...], names: tuple[str, ...], spare: list[str], label: int):
    """Frames with names in them, half of them made up of ordinary words, some among ordinary words."""
    out = []
    for frame in frames:
        for k in range(VARIATIONS):
            made_up = " ".join(spare[rng.randint(len(spare))] for _ in range(rng.randint(1, 4))) if spare else "thing"
            name = names[rng.randint(len(names))] if names and k % 2 else made_up
            words = _words(frame.format(name).lower())
            if k >= VARIATIONS // 2:
                words = [w for w in words if rng.rand() > 0.1]
            if k % 3 == 2 and spare:
                words = words + [spare[rng.randint(len(spare))] for _ in range(rng.randint(1, 12))]
            out.append((words, label))
    return out


def fit(paragraphs: list[str]) -> Model:
    """Trains on the templates and on ordinary paragraphs; those that hold a template are left out."""
    families = list(TEMPLATES)
    templates = {f: [trigrams(_words(t.lower())) for t in TEMPLATES[f]] for f in families}
    ordinary = [w for w in (_words(p.lower()) for p in paragraphs) if w]
    ordinary = [w for w in ordinary if all(len(trigrams(w) & t) < 0.5 * len(t) for ts in templates.values() for t in ts)]
    rng = np.random.RandomState(3)
    examples = _variations(rng, ordinary)
    spare = sorted({w for words in ordinary[:SPARE_PARAGRAPHS] for w in words})
    unknown = len(families) + 1
    examples += _filled(rng, OTHER_NOTICES, OTHER_NAMES, spare, unknown)
    examples += _filled(rng, ORDINARY_SENTENCES, (), spare, 0)
    small = FUNCTION_WORDS + tuple(spare[: 2 * len(FUNCTION_WORDS)])
    examples += [([small[i] for i in rng.randint(len(small), size=rng.randint(1, 15))], 0) for _ in range(10 * VARIATIONS)]
    examples += [([FUNCTION_WORDS[i] for i in rng.randint(len(FUNCTION_WORDS), size=rng.randint(1, 15))], 0) for _ in range(10 * VARIATIONS)]
    known = [*(t for ts in TEMPLATES.values() for t in ts), *(f.format("") for f in (*OTHER_NOTICES, *ORDINARY_SENTENCES)), *OTHER_NAMES]
    vocabulary = sorted(set().union(*(ngrams(_words(t.lower())) for t in known)))
    column = {g: i for i, g in enumerate(vocabulary)}
    examples += [(w, 0) for w in ordinary]
    # ordinary text in pieces, as short paragraphs are common
    examples += [(w[: rng.randint(1, 15)], 0) for w in ordinary]
    x = np.zeros((len(examples), len(vocabulary)), np.float32)
    for i, (words, _) in enumerate(examples):
        own = [column[g] for g in ngrams(words) if g in column]
        if own:
            x[i, own] = 1.0 / np.sqrt(len(own))
    y = np.array([label for _, label in examples])
    target = np.eye(unknown + 1, dtype=np.float32)[y]
    kept = rng.rand(len(y)) < 0.25
    w, b = np.zeros((len(vocabulary), target.shape[1]), np.float32), np.zeros(target.shape[1], np.float32)
    xt, tt = x[~kept], target[~kept]
    # classes count alike, whatever their number of examples
    share = (1.0 / np.maximum(1, tt.sum(0)))[tt.argmax(1)][:, None].astype(np.float32) / tt.shape[1]
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(STEPS):
        g = (_softmax(xt @ w + b) - tt) * share
        vw, vb = 0.9 * vw - RATE * 10 * (xt.T @ g + DECAY * w), 0.9 * vb - RATE * 10 * g.sum(0)
        w += vw
        b += vb
    z = x[kept] @ w + b
    losses = [(-np.log(_softmax(z / t)[np.arange(len(z)), y[kept]] + 1e-12).mean(), t) for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)]
    temperature = min(losses)[1]
    w, b = w.astype(np.float64), b.astype(np.float64)
    weights = {g: w[i] for g, i in column.items()}
    return Model(families, weights, b, temperature, telling_words(weights, b, temperature, ordinary), templates)


def telling_words(
    weights: dict[str, np.ndarray], bias: np.ndarray, temperature: float, ordinary: list[list[str]]
) -> frozenset[str]:
    """A word of each feature outside a set of weak ones that leaves every paragraph ordinary. Features of words
    that are common in ordinary text are put into the weak set first, and the rarer word stands for a feature."""
    times = Counter(w for words in ordinary for w in words)
    rare = {g: min(g.split(), key=lambda w: (times[w], w)) for g in weights}
    # k known features add up to sum / sqrt(k), at most the norm of their gains
    room = -temperature * np.log(np.exp((bias[1:] - bias[0]) / temperature).sum())
    left, telling = max(0.0, room) ** 2, set()
    for g in sorted(weights, key=lambda g: (-times[rare[g]], g)):
        gain = max(0.0, float((weights[g][1:] - weights[g][0]).max())) ** 2
        if gain < left:
            left -= gain
        else:
            telling.add(rare[g])
    return frozenset(telling)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(documents: DataFrame) -> Model | None:
    """Fits the model on a sample of ``SAMPLE_DOCUMENTS`` different texts, those of least hash, and of each of them on
    the first ``SAMPLE_CHARS`` characters of ``SAMPLE_PARAGRAPHS`` lines in the middle."""
    # as many texts at every size; each task hands over no more hashes than are wanted
    hashes = texts(documents).select(F.xxhash64("text").alias("h")).groupBy("h").agg(F.lit(1)).select("h")
    least = [r.h for r in hashes.orderBy("h").limit(SAMPLE_DOCUMENTS).collect()]
    if not least:
        return None
    source = texts(documents).withColumn("h", F.xxhash64("text")).filter(F.col("h") <= least[-1])
    lines = F.filter(F.split("text", "\n"), lambda p: F.length(F.trim(p)) > 0)
    middle = F.greatest(F.lit(1), F.floor(F.size("lines") / 2).cast("int"))
    sample = (
        source.groupBy("h")
        .agg(F.min("text").alias("text"))
        .select(lines.alias("lines"))
        .filter(F.size("lines") > 0)
        .select(F.explode(F.slice("lines", middle, F.lit(SAMPLE_PARAGRAPHS))).alias("p"))
        .select(F.substring("p", 1, SAMPLE_CHARS).alias("p"))
    )
    return fit(sorted(r.p for r in sample.collect()))


def licence_paragraphs(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Each licence paragraph with its place, family, probability and template similarity; one pass, no shuffle."""
    model = model or train(documents)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                lines = text.as_py().split("\n")
                starts = [0, *accumulate(len(line) + 1 for line in lines)]
                for i, j, found in model.paragraphs(lines) if model else ():
                    rows.append((doc_id, i, starts[i], starts[j + 1] - 1, *found))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "paragraph", "start", "end", "family", "probability", "similarity"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts(documents).mapInArrow(scan, SCHEMA)


def query(spark, sf_dir):
    return licence_paragraphs(table(spark, sf_dir, "documents"))
