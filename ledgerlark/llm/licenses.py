"""License scan: a trained paragraph classifier with a calibrated unknown class, confirmed by template comparison.

Paragraphs are lines with a word in them. Long ones are judged in windows of `WINDOWS` words (and the pairs that begin in them) too, one every `STEP` words,
and beyond the longest window by these only; each family is shown once in a paragraph, where it is closest. The families are those of `TEMPLATES`, ten in all; a licence of
another family is `unknown`. Hashed single words and word pairs are the features of a multinomial
logistic regression over licence families and `unknown`. It is trained on variants of the templates (shortened, with
other words around) and, as unknown, on at most `NEGATIVES` lines, none longer than `CHARACTERS`, of the `DOCUMENTS`
documents that come first by hash of their id, that resemble no template. A part of these rows, kept out of the fit, sets the temperature of the
probabilities. A family with probability `LIKELY` or more is a finding; it is confirmed if the paragraph shares
`SIMILAR` of the word pairs with a template of that family (of the shorter one's pairs).

Scoring is a narrow pass over whole texts. Null and empty texts have no paragraphs and no findings. Rows with equal
ids are scanned one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import numbers, word_bounds, word_hashes
from ledgerlark.llm.tables import cut

BUCKETS = 1 << 14
VARIANTS = 32  # of each template
DOCUMENTS = 300
NEGATIVES = 2_000
CHARACTERS = 4_096
WINDOWS = (16, 24, 64)  # words, in multiples of `STEP`
STEP = 8
LIKELY = 0.5
SIMILAR = 0.6
UNKNOWN = "unknown"

# fixed values: usual notices and opening passages of common licences, by family
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v2.",
    ],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
}
# fixed values: sentences on licences that grant nothing
OTHERS = [
    "A driving licence is required for this job.",
    "The licence fee goes up next year.",
    "He lost his license in the city.",
    "All rights reserved.",
    "Version 2.0 of the report was released under pressure.",
    "The general public was free to use the library.",
    "Terms and conditions apply to this work.",
    "Please read the license before use.",
]
FAMILIES = [UNKNOWN, *TEMPLATES]

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 10 else 32 for c in range(256))


def paragraph_features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all paragraphs with a word: number of the line, first word, bucket of each word, and of each pair (else -1)."""
    data = (text or "").encode("utf-8", "replace").translate(_PLAIN)
    words = word_hashes(data)
    buffer = np.frombuffer(data, dtype=np.uint8)
    starts, _ = word_bounds(buffer)
    line = np.searchsorted(np.flatnonzero(buffer == 10), starts)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.uint64(BUCKETS)
    pairs = np.full(len(words), -1, dtype=np.int64)
    if len(words) > 1:
        a, b = numbers(31, 2) | np.uint64(1)
        joined = ((words[:-1] * a + words[1:] * b) >> np.uint64(20)) % size
        pairs[:-1] = np.where(line[1:] == line[:-1], joined.astype(np.int64), -1)
    return line[first], first, ((words >> np.uint64(20)) % size).astype(np.int64), pairs


@dataclass
class LicenseModel:
    weights: np.ndarray  # bucket, family; one row more, of zeros, for no pair
    constants: np.ndarray
    temperature: float = 1.0

    def whole(self, first: np.ndarray, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Logits of the stretches that begin at `first`."""
        total = np.add.reduceat(self.weights[words] + self.weights[pairs], first, axis=0)
        return self.constants + total / np.sqrt(np.add.reduceat(1 + (pairs >= 0), first))[:, None]

    def logits(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each paragraph and window: number of the line, its first word and the one behind it (-1: all of a
        paragraph), and logits."""
        lines, first, words, pairs = paragraph_features(text)
        if not len(first):
            return lines, np.zeros((0, 2), dtype=np.int64), np.zeros((0, len(self.constants)))
        sizes = np.diff(first, append=len(words))
        short = np.flatnonzero(sizes <= max(WINDOWS))
        # the last window of a paragraph may be shorter
        found = [(lines[short], np.full((len(short), 2), -1), self.whole(first, words, pairs)[short])]
        blocks = -(-sizes // STEP)
        step = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        owner = np.repeat(np.arange(len(first)), blocks)
        at = first[owner] + STEP * step
        total = np.add.reduceat(self.weights[words] + self.weights[pairs], at, axis=0)
        count = np.add.reduceat(1 + (pairs >= 0), at)
        for size in WINDOWS:
            n = size // STEP
            start = np.flatnonzero((step <= blocks[owner] - n) & (sizes[owner] > size))
            held = np.sqrt(sum(count[start + j] for j in range(n)))
            span = np.stack([at[start], np.minimum(at[start] + size, (first + sizes)[owner[start]])], axis=1)
            found.append((lines[owner[start]], span, self.constants + sum(total[start + j] for j in range(n)) / held[:, None]))
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def probabilities(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lines, span, logits = self.logits(text)
        return lines, span, softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True)


def pair_set(text: str) -> set[tuple[bytes, ...]]:
    words = text.encode("utf-8", "replace").translate(_PLAIN).split()
    return {*zip(words, words[1:], strict=False)} or {(w,) for w in words}


def similarity(paragraph: str, family: str) -> float:
    """Largest share of word pairs in common with a template of the family, of the smaller set."""
    own = pair_set(paragraph)
    return max((len(own & t) / min(len(own), len(t)) for t in map(pair_set, TEMPLATES[family]) if own), default=0.0)


def training_rows(lines: list[str], seed: int = 5) -> list[tuple[str, int, bool]]:
    """`(paragraph, family, held out)`: variants of the templates, and the lines as unknown."""
    rng = np.random.default_rng(seed)
    unknown = [t for t in lines if max(similarity(t, f) for f in TEMPLATES) < SIMILAR] or OTHERS
    rows = [(t, 0, k % 4 == 0) for k, t in enumerate(unknown)] + [(t, 0, False) for t in OTHERS for _ in range(8)]
    for number, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            for k in range(VARIANTS):
                words = template.split()
                if len(words) > 12 and k % 4 == 1:
                    n = int(rng.integers(int(0.6 * len(words)), len(words) + 1))
                    at = int(rng.integers(0, len(words) - n + 1))
                    words = words[at : at + n]
                if k % 4 >= 2:
                    around = unknown[int(rng.integers(len(unknown)))].split()[: int(rng.integers(1, 9))]
                    words = [*around, *words] if k % 2 else [*words, *around]
                rows.append((" ".join(words), number, k % 8 == 7))
    return rows


def fit(docs: DataFrame) -> LicenseModel:
    """Train on template variants and a bounded sample of lines."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).withColumn("mark", F.xxhash64("text"))
    # ids first, texts of these only: `DOCUMENTS` pairs of numbers
    some = rows.select("doc_id", "mark").orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(DOCUMENTS).distinct()
    some = some.select(F.col("doc_id").alias("id"), F.col("mark").alias("same"))
    near = rows.join(F.broadcast(some), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("same")), "left_semi")
    short = F.filter(F.split("text", "\n"), lambda x: F.length(x) <= CHARACTERS)
    lines = near.select(F.explode(short).alias("line")).where(F.col("line").rlike(r"\w")).distinct()
    negatives = [r["line"] for r in lines.orderBy(F.xxhash64("line"), "line").limit(NEGATIVES).collect()]
    samples = training_rows(negatives)

    def vector(text: str):
        _, _, words, pairs = paragraph_features(text.replace("\n", " "))
        found = np.concatenate([words, pairs[pairs >= 0]])
        places, counts = np.unique(found, return_counts=True)
        return Vectors.sparse(BUCKETS, places.tolist(), (counts / np.sqrt(max(len(found), 1))).tolist())

    data = spark.createDataFrame([(vector(t), float(y)) for t, y, held in samples if not held], ["features", "label"])
    learner = LogisticRegression(family="multinomial", maxIter=60, regParam=1e-4, standardization=False)
    learnt = learner.fit(cut(data))
    weights = np.vstack([learnt.coefficientMatrix.toArray().T, np.zeros((1, len(FAMILIES)))]).astype(np.float32)
    model = LicenseModel(weights, learnt.interceptVector.toArray())
    held = [(paragraph_features(t.replace("\n", " "))[1:], y) for t, y, h in samples if h]
    logits, truth = np.vstack([model.whole(*x) for x, _ in held if len(x[0])]), np.array([y for x, y in held if len(x[0])])
    losses = {t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.25, 4, 33)}
    model.temperature = float(min(losses, key=losses.get))
    return model


def findings(text: str | None, model: LicenseModel) -> tuple[int, list[dict]]:
    """Number of paragraphs, and the licences found in them."""
    lines, span, p = model.probabilities(text)
    best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=np.intp)
    found: dict[tuple[int, str], dict] = {}
    parts, words = [], []
    for k in np.flatnonzero((best > 0) & (p.max(axis=1, initial=0) >= LIKELY)) if len(p) else ():
        parts = parts or text.split("\n")
        family, (start, end) = FAMILIES[best[k]], span[k]
        if start < 0:
            paragraph = parts[lines[k]]
        else:
            words = words or text.encode("utf-8", "replace").translate(_PLAIN).split()
            paragraph = b" ".join(words[start:end]).decode("utf-8", "replace")
        close = similarity(paragraph, family)
        one = {"line": int(lines[k]), "family": family, "probability": float(p[k, best[k]]), "similarity": close, "confirmed": close >= SIMILAR, "paragraph": paragraph}
        other = found.get((one["line"], family))
        if other is None or (close, one["probability"]) > (other["similarity"], other["probability"]):
            found[one["line"], family] = one
    return len(np.unique(lines)), sorted(found.values(), key=lambda f: (f["line"], f["family"]))


FINDING = "array<struct<line:int,family:string,probability:double,similarity:double,confirmed:boolean,paragraph:string>>"


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """`(doc_id, n_paragraphs, found)` of every row; narrow."""
    kind = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("paragraph", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [findings(t.as_py(), model) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _ in rows], pa.int64()), pa.array([f for _, f in rows], kind)], names=["doc_id", "n_paragraphs", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_paragraphs long, found {FINDING}")


def license_scan(docs: DataFrame) -> DataFrame:
    """Confirmed families of every document, with counts of findings."""
    found = scan(docs, fit(docs))
    confirmed = F.filter("found", lambda f: f["confirmed"])
    return found.select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_found"), F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda f: f["family"]))), ",").alias("families"),
    )
