"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

`fit` learns from a bounded sample of labelled documents (`QualityModel.sample` rows at most). Statistics of
each text are standardised and mapped to `features` random cosines that approximate a Gaussian kernel. Every
partition sums its part of the normal equations, Spark adds the parts, and the small system is solved. The
raw scores of a quarter of the sample, which takes no part in the equations, calibrate the result.

`score` is a narrow pass over all rows. A null or empty text has the statistics of an empty document and is
scored like any other; without any usable label the score is 0.5. Rows with equal ids are scored one by one.
A null id has a score and a null `held_out`. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import sequence_hashes, word_hashes
from ledgerlark.llm.tables import cut, labelled, remainder, training_texts

SAMPLE = 12_000  # labelled documents used for fitting, at most
FEATURES = 192
RIDGE = 1e-3
THRESHOLD = 0.3
BLOCKS = 8  # parts of a text whose worst ratio counts
BINS = 512  # of raw scores before calibration

_MEMBER = np.zeros((256, 11))  # byte, class
for _number, _members in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b"!?", b"|", b"#$%&*@^~_=+", b"<>{}[]\\/")
):
    _MEMBER[list(_members), _number + 1] = 1
_MEMBER[128:, 10] = 1
_MEMBER[:, 0] = 1 - _MEMBER.sum(axis=1)


def _runs(same: np.ndarray) -> int:
    """Length of the longest stretch of true values."""
    if not same.any():
        return 0
    edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
    return int((edges[1::2] - edges[::2]).max())


def _distinct(hashes: np.ndarray) -> tuple[int, int]:
    """Number of different values, and how often the most frequent one occurs."""
    if not len(hashes):
        return 0, 0
    ordered = np.sort(hashes)
    same = ordered[1:] == ordered[:-1]
    return len(hashes) - int(same.sum()), 1 + _runs(same)


def _parts(n: int) -> np.ndarray:
    return np.arange(n) * BLOCKS // max(n, 1)


_CHOSEN = [1, 3, 6, 7, 8, 9]


def document_stats(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text: shares of character classes, overall and in its worst part, and repetition."""
    data = (text or "").encode("utf-8", "replace")
    buffer = np.frombuffer(data, dtype=np.uint8)
    bytes_in = np.zeros((BLOCKS, 256))
    edges = [len(data) * k // BLOCKS for k in range(BLOCKS + 1)]
    for k in range(BLOCKS):
        bytes_in[k] = np.bincount(buffer[edges[k] : edges[k + 1]], minlength=256)
    classes = bytes_in @ _MEMBER  # of each part
    counts, n = classes.sum(axis=0), max(len(data), 1)
    worst = (classes[:, _CHOSEN] / np.maximum(np.diff(edges), 1)[:, None]).max(axis=0)
    seen = bytes_in.sum(axis=0) / n
    seen = seen[seen > 0]
    words = word_hashes(data)
    m = max(len(words), 1)
    same = words[1:] == words[:-1]
    again = np.count_nonzero(words[2:] == words[:-2])
    repeats = np.count_nonzero(same)
    share = 0.0
    if repeats:
        places = _parts(len(same))
        share = float((np.bincount(places, weights=same, minlength=BLOCKS) / np.maximum(np.bincount(places, minlength=BLOCKS), 1)).max())
    different, top = _distinct(words)
    triples = sequence_hashes(words, 3)
    return np.concatenate(
        [
            counts / n,
            worst,
            np.log1p(counts[_CHOSEN]),
            [
                np.log1p(len(data)),
                np.log1p(len(words)),
                len(data) / m,
                float(-(seen * np.log(seen)).sum()),
                different / m,
                top / m,
                repeats / max(len(same), 1),
                share,
                np.log1p(repeats),
                np.log1p(_runs(same)),
                again / max(len(words) - 2, 1),
                _distinct(triples)[0] / len(triples) if len(triples) else 1.0,
            ],
        ]
    )


WIDTH = len(document_stats(None))


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None  # raw scores, rising
    levels: np.ndarray | None = None  # calibrated score at each knot, never falling

    def expand(self, stats: np.ndarray) -> np.ndarray:
        """A constant, the standardised statistics and the random cosines."""
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([np.ones((len(x), 1)), x, cosines])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.expand(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        if self.knots is None or not len(self.knots):
            return np.clip(self.raw(stats), 0, 1)
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by `x`; mean position and level of each pool."""
    pools: list[list[float]] = []
    for position, value, w in zip(x, y, weight, strict=True):
        pools.append([position * w, value * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    total = np.array(pools).reshape(-1, 3)
    return total[:, 0] / total[:, 2], total[:, 1] / total[:, 2]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, seed: int = 11) -> QualityModel:
    """Learn label `quality` from labelled ids whose crc32 remainder modulo 5 is not 0."""
    spark = docs.sparkSession
    ids = labelled(labels, "quality", sample, remainder("doc_id", 5) != 0)
    rows = training_texts(docs, ids)

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_stats(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([s.tolist() for s in found], pa.list_(pa.float64()))],
                names=["doc_id", "y", "stats"],
            )

    known = cut(rows.mapInArrow(stats, "doc_id bigint, y int, stats array<double>"))
    sums = known.select(
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(WIDTH)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(WIDTH)],
    ).first()
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(WIDTH)])
    spread = np.array([sums[f"s{i}"] or 0.0 for i in range(WIDTH)])
    spread[spread < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    width = np.sqrt(WIDTH)  # of the kernel, in standardised units
    model = QualityModel(mean, spread, rng.normal(size=(WIDTH, features)) / width, rng.uniform(0, 2 * np.pi, features))
    size = 1 + WIDTH + features

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                z = model.expand(np.array(batch.column("stats").to_pylist(), dtype=float))
                left += z.T @ z
                right += z.T @ batch.column("y").to_numpy(zero_copy_only=False)
        if left.any():
            yield pa.RecordBatch.from_pydict({"row": pa.array(range(size), pa.int32()), "sums": [[*a, b] for a, b in zip(left.tolist(), right, strict=True)]})

    calibrating = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0
    parts = known.where(~calibrating).mapInArrow(equations, "row int, sums array<double>")
    total = (
        parts.select("row", F.posexplode("sums").alias("column", "value"))
        .groupBy("row", "column").agg(F.sum("value").alias("value"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("column", "value"))).alias("line"))  # `size` numbers
        .collect()  # `size` rows, whatever the input
    )
    if not total:
        return model
    system = np.zeros((size, size + 1))
    for line in total:
        system[line["row"]] = [cell["value"] for cell in line["line"]]
    penalty = RIDGE * max(system[0, 0], 1.0) * np.eye(size)
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = model.raw(np.array(batch.column("stats").to_pylist(), dtype=float))
                yield pa.RecordBatch.from_pydict({"raw": values, "y": batch.column("y")})

    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("raw") + 0.5) * (BINS / 2))))
    bins = (
        known.where(calibrating).mapInArrow(raw, "raw double, y int")
        .groupBy(place.alias("bin")).agg(F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin").collect()  # BINS rows at most
    )
    if bins:
        model.knots, model.levels = isotonic(*(np.array([float(b[k]) for b in bins]) for k in ("x", "y", "n")))
    return model


def score(docs: DataFrame, model: QualityModel, columns: list[str] | None = None) -> DataFrame:
    """`columns` of the documents (their id by default) with `score` and `predicted`; narrow."""
    keep = ["doc_id"] if columns is None else columns
    source = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            scores = model.score(np.array([document_stats(t.as_py()) for t in texts]).reshape(-1, WIDTH))
            predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(scores), predicted], names=[*keep, "score", "predicted"])

    schema = source.drop("__text").withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    return source.mapInArrow(run, schema)


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document with a model learnt from the labelled part."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
