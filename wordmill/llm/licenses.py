"""Licence scans: a trained paragraph classifier, a calibrated unknown class, and template comparison.

A softmax regression over word uni- and bigrams tells licence families from
ordinary paragraphs.  It is trained on variations of notice templates and on a
bounded sample of the corpus' own paragraphs.  A predicted family counts only
if its calibrated probability is high and a template of it is really there;
otherwise a licence-like paragraph is ``unknown``.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import ALNUM
from wordmill.llm.logit import fit_softmax, scores_of, softmax, temperature

# Licence families and the wording of their usual notices.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the 3-Clause BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "Public-Domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
}
# Wording about rights that names no known family, and ordinary uses of the same words.
UNKNOWN = (
    "All rights reserved.", "Copyright (c) 2019 Example Corp. All rights reserved.", "This document is licensed under proprietary terms.",
    "You may not copy or redistribute this material without written permission of the publisher.",
    "Licensed under the terms agreed with the author; see the accompanying agreement.",
    "Use of this work is subject to the licence agreement between you and the vendor.",
    "Released under the Example Community License, version 1.", "Licensed for personal use only, redistribution is prohibited.",
)
ORDINARY = (
    "The driver showed his license and the officer returned it with the papers.", "Permission denied, please ask the administrator for access.",
    "The general public was invited to the free concert in the park.", "Version 2.0 of the program was released in May.",
    "She studied at MIT before she joined the Apache helicopter project.", "The file contains a copy of the following conditions and terms.",
    "Software development is work that needs attention to source code and its modification.", "The foundation published a report on public health.",
)

VARIATIONS, SEED = 80, 11
# Paragraphs of the corpus, the first by hash of their document, that stand for ordinary text in training.
MAX_PARAGRAPHS, MAX_DOCUMENTS = 4_000, 1_000
CERTAIN, LIKELY = 0.8, 0.5  # probability of a family; of being about a licence at all
CONFIRM = 0.6  # share of a template's bigrams, in its order, that a paragraph must hold


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(ALNUM).split()


def grams(words: list[bytes]) -> set[int]:
    return {zlib.crc32(w) for w in words} | {zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])}


def containment(words: list[bytes], template: list[bytes]) -> float:
    """Share of the template's adjacent word pairs that the paragraph holds in the template's order."""
    pairs = list(zip(words, words[1:]))
    want = list(zip(template, template[1:]))
    at = {}
    for i, p in enumerate(pairs):
        at.setdefault(p, []).append(i)
    ends: list[int] = []  # longest increasing chain of places
    for p in want:
        for i in reversed(at.get(p, ())):
            lo = int(np.searchsorted(ends, i)) if ends else 0
            if lo == len(ends):
                ends.append(i)
            else:
                ends[lo] = i
    return len(ends) / max(1, len(want))


def located(words: list[bytes], template: list[bytes]) -> tuple[int, int, int]:
    """``containment`` as a number of pairs, and the places of the first and last word of that chain."""
    at: dict[tuple, list[int]] = {}
    for i, p in enumerate(zip(words, words[1:])):
        at.setdefault(p, []).append(i)
    ends: list[int] = []
    tails: list[tuple] = []  # the chain to each end, as (place, chain before)
    for p in zip(template, template[1:]):
        for i in reversed(at.get(p, ())):
            lo = bisect_left(ends, i)
            link = (i, tails[lo - 1] if lo else None)
            if lo == len(ends):
                ends.append(i)
                tails.append(link)
            else:
                ends[lo], tails[lo] = i, link
    if not ends:
        return 0, 0, 0
    link = tails[-1]
    while link[1]:
        link = link[1]
    return len(ends), link[0], ends[-1] + 1


def variations(text: str, rng: random.Random, filler: list[str]) -> str:
    """One way in which a notice turns up: parts of other text around it, words lost, names and years added."""
    words = text.split()
    if len(words) > 8 and rng.random() < 0.3:
        words = words[: rng.randint(len(words) // 2, len(words))]
    words = [w for w in words if rng.random() > 0.04]
    if rng.random() < 0.3:
        words = ["Copyright", "(c)", str(rng.randint(1990, 2030)), *rng.choices(filler, k=2), *words]
    if rng.random() < 0.5:
        words = rng.choices(filler, k=rng.randint(1, 25)) + words
    if rng.random() < 0.5:
        words = words + rng.choices(filler, k=rng.randint(1, 25))
    return " ".join(words)


class LicenceModel:
    """A fitted classifier; its size is that of the templates and the bounded sample."""

    def __init__(self, ordinary: list[bytes]):
        rng = random.Random(SEED)
        self.families = ["none", "unknown", *TEMPLATES]
        self.templates = {f: [words_of(t.encode()) for t in TEMPLATES[f]] for f in TEMPLATES}
        self.flat = [t for f in self.templates.values() for t in f]
        self.occurrences = {w: np.array([t.count(w) for t in self.flat]) for w in {w for t in self.flat for w in t}}
        filler = sorted({w.decode("utf-8", "ignore") for p in ordinary for w in words_of(p)} | {w for t in ORDINARY for w in t.split()})
        texts, labels = [], []

        def add(label, text):
            texts.append(words_of(text if isinstance(text, bytes) else text.encode()))
            labels.append(label)

        for label, family in enumerate(self.families):
            for t in {"none": ORDINARY, "unknown": UNKNOWN}.get(family) or TEMPLATES[family]:
                add(label, t)
                for _ in range(VARIATIONS):
                    add(label, variations(t, rng, filler))
        for t in [t for family in TEMPLATES.values() for t in family] + list(UNKNOWN):
            for _ in range(VARIATIONS // 8):  # the words of notices, but no notice
                add(0, " ".join(rng.sample(t.split(), min(4, len(t.split()))) + rng.choices(filler, k=12)))
        for p in ordinary:
            w = words_of(p)
            if not any(containment(w, t) >= CONFIRM for f in self.templates.values() for t in f):
                add(0, p)
        sets = [grams(w) for w in texts]
        held = np.array([zlib.crc32(b" ".join(w)) % 5 == 0 for w in texts])
        notices = [s for s, l in zip(sets, labels) if l]
        count: dict[int, int] = {}
        for s in notices:
            for g in s:
                count[g] = count.get(g, 0) + 1
        self.index = {g: i for i, g in enumerate(sorted(g for g, n in count.items() if n >= VARIATIONS // 4))}
        rows = [self.numbered(s) for s in sets]
        labels = np.array(labels)
        fit = np.flatnonzero(~held)
        self.weights = fit_softmax([rows[i] for i in fit], labels[fit], len(self.index), len(self.families), l2=0.5)
        self.temperature = temperature(scores_of([rows[i] for i in np.flatnonzero(held)], self.weights), labels[held])

    def numbered(self, gram_set: set[int]) -> np.ndarray:
        return np.array(sorted(self.index[g] for g in gram_set if g in self.index), np.int64)

    def wrapped(self, lines: list[list[bytes]]) -> list[tuple[int, int]]:
        """Runs of neighbouring lines ``(first, last)`` over which a notice may be wrapped: they hold a template, no line alone."""
        seen = set().union(*lines)
        weight = sum((self.occurrences[w] for w in seen & self.occurrences.keys()), np.zeros(len(self.flat), np.int64))
        # a chain of n pairs needs more than n of the template's words, wherever they stand
        likely = [t for t, n in zip(self.flat, weight) if len(t) > 1 and n >= CONFIRM * (len(t) - 1)]
        if len(lines) < 2 or not likely:
            return []
        words = [w for line in lines for w in line]
        line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
        pairs = [set(zip(t, t[1:])) for t in likely]
        every = set().union(*pairs)
        places = [(i, p) for i, p in enumerate(zip(words, words[1:])) if p in every]
        runs = []
        for template, mine in zip(likely, pairs):
            at = np.array([i for i, p in places if p in mine], np.int64)
            reach, need, done = len(template) + len(template) // 2 + 8, CONFIRM * (len(template) - 1), -1
            within = np.searchsorted(at, at + reach) - np.arange(len(at))
            for i in at[within >= need].tolist():
                if i >= done:
                    n, first, last = located(words[i:i + reach + 1], template)
                    if n >= need:
                        done = i + last
                        runs.append((-n, i + first, i + last))
        chosen: list[tuple[int, int]] = []  # where templates overlap, the one with most pairs
        for _, first, last in sorted(runs):
            if all(last < a or b < first for a, b in chosen):
                chosen.append((first, last))
        found = [(int(line_of[a]), int(line_of[b])) for a, b in sorted(chosen)]
        return [(a, b) for a, b in found if a < b]

    def judge(self, paragraphs: list[list[bytes]]) -> list[tuple[str, float] | None]:
        """Family and probability of each paragraph; None if it is not about a licence."""
        rows = [self.numbered(grams(w)) for w in paragraphs]
        busy = [i for i, r in enumerate(rows) if len(r)]  # without known grams, only the intercept speaks: ordinary
        out: list[tuple[str, float] | None] = [None] * len(rows)
        if not busy:
            return out
        p = softmax(scores_of([rows[i] for i in busy], self.weights) / self.temperature)
        for k in np.flatnonzero(p[:, 0] < LIKELY).tolist():
            words = paragraphs[busy[k]]
            best = 2 + int(p[k, 2:].argmax())
            family = self.families[best]
            sure = p[k, best] / max(1e-12, 1 - p[k, 0]) >= CERTAIN
            confirmed = sure and max(containment(words, t) for t in self.templates[family]) >= CONFIRM
            out[busy[k]] = (family, float(p[k, best])) if confirmed else ("unknown", float(1 - p[k, 0]))
        return out


def corpus_paragraphs(docs: DataFrame, id_col: str, text_col: str, max_documents: int = MAX_DOCUMENTS, of_each: int = 4,
                      max_paragraphs: int = MAX_PARAGRAPHS) -> list[bytes]:
    """A bounded, deterministic sample of paragraphs: of the documents of lowest hash, the paragraphs of lowest hash.

    The hashes alone are sorted, for the largest one that is let in; texts are
    cut into paragraphs only after that, so none but the sample's travel.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    chosen = chosen.withColumn("h", F.xxhash64(F.lit(SEED), "id", "text"))
    last = chosen.select("h").distinct().orderBy("h").limit(max_documents).agg(F.max("h")).first()[0]
    heads = chosen.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"])
    ordered = F.array_sort(F.transform(F.split("text", "\n"), lambda p: F.struct(F.xxhash64(p).alias("k"), p.alias("p"))))
    rows = heads.select(F.explode(F.slice(ordered, 1, of_each)).alias("x")).select("x.k", "x.p").distinct().orderBy("k", "p").limit(max_paragraphs).collect()
    return sorted({r["p"].encode() for r in rows if r["p"].strip()})


FINDING = "array<struct<paragraph: int, family: string, probability: double>>"


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_paragraphs, findings)`` of every row; a paragraph is a line with words, numbered from 0.

    A notice may also be wrapped over neighbouring lines: these are joined and
    judged as one, and a confirmed family is one finding at its first line, in
    place of what its lines gave alone.

    Whole texts are scanned.  A null or empty text has no paragraphs.  Repeated
    rows are scanned each.  An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LicenceModel(corpus_paragraphs(docs, id_col, text_col)))
    kinds = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            owner, number, paragraphs, counts = [], [], [], []
            found: list[dict[tuple[int, str], float]] = [{} for _ in range(b.num_rows)]
            run_of, joined = [], []

            def flush():
                for o, n, verdict in zip(owner, number, model.judge(paragraphs)):
                    if verdict:
                        found[o][n, verdict[0]] = verdict[1]
                owner.clear(), number.clear(), paragraphs.clear()

            for i, raw in enumerate(b.column(1)):
                lines = re.split(rb"[\r\n]+", raw.as_buffer().to_pybytes()) if raw.is_valid else []
                lines = [words for words in map(words_of, lines) if words]
                counts.append(len(lines))
                for first, last in model.wrapped(lines):
                    run_of.append((i, first, last))
                    joined.append([w for line in lines[first:last + 1] for w in line])
                for n, words in enumerate(lines):
                    owner.append(i)
                    number.append(n)
                    paragraphs.append(words)
                    if len(paragraphs) >= 2000:
                        flush()
            flush()
            for (o, first, last), verdict in zip(run_of, model.judge(joined)):
                if verdict and verdict[0] != "unknown":
                    for n in range(first, last + 1):  # a line that is a notice of its own stays
                        found[o].pop((n, "unknown"), None)
                        found[o].pop((n, verdict[0]), None)
                    found[o][first, verdict[0]] = verdict[1]
            found = [[{"paragraph": n, "family": f, "probability": x[n, f]} for n, f in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(found, kinds)], ["doc_id", "n_paragraphs", "findings"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw"))
    return rows.mapInArrow(run, f"doc_id bigint, n_paragraphs bigint, findings {FINDING}")
