"""Interaction audit of document filters: what every order of the filters would remove.

A document's failures are five bits. For each of the 32 subsets of filters they say whether the document would survive
them; these answers are the bits of its survival word. Words are added up by position with carry-save adders, for each
part and for the documents with a label, so 32 sums say how many survive each subset. Every order, step and share
follows from these sums: what a step removes is the difference of two of them.

1. `facts` reads each text once and keeps its first four bits and a 128-bit digest.
2. The smallest id of every digest is joined back by id, never by digest, so copies of one text do not meet in a task.
3. `survivors` adds words up inside tasks, then sums of parts.
4. `orders` turns the 32 sums of a part into its 600 rows.

A null text is an empty one, a null language the part ''. A null id counts as larger than any other, so it is never the
first of copies beside an id, and has no labels; copies without ids do not remove each other. Rows with equal id and text are
copies that stay or go together. Of several label rows of one id the larger value counts. An empty table gives no parts
and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import pieces
from ledgerlark.llm.tables import cut

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
WORDS = 200  # A: fewer words
DISTINCT_PERCENT = 50  # B: a smaller share of different words
UPPER_PERCENT = 3  # C: a larger share of A-Z
MARKS = b"#$%&*|"  # D: any of these
LAST = np.iinfo(np.int64).max  # stands for a null id
CLASSES = ("all", "good", "toxic")
_UPPER = bytes(range(0x41, 0x5B))


def survival_words() -> np.ndarray:
    """For every set of failed filters the word whose bit S is 1 if none of them is in the subset S."""
    failed, subset = np.arange(SUBSETS)[:, None], np.arange(SUBSETS)
    return ((failed & subset) == 0).astype(np.uint64) @ (np.uint64(1) << subset.astype(np.uint64))


def text_failures(data: bytes) -> int:
    """Bits 0 to 3: failures of A to D."""
    words, different = 0, set()
    for piece in pieces(data):
        some = piece.split()
        words += len(some)
        different.update(some)
    points = int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))
    upper = len(data) - len(data.translate(None, _UPPER))
    marks = len(data) - len(data.translate(None, MARKS))
    fails = (words < WORDS, 100 * len(different) < DISTINCT_PERCENT * words, 100 * upper > UPPER_PERCENT * points, marks > 0)
    return sum(f << k for k, f in enumerate(fails))


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column("text")]
        digests = np.array([np.frombuffer(hashlib.blake2b(t, digest_size=16).digest(), dtype=np.int64) for t in texts]).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("part"), pa.array([text_failures(t) for t in texts], pa.int32()), *[pa.array(digests[:, k]) for k in (0, 1)]],
            names=["id", "part", "failed", "d1", "d2"],
        )


def facts(docs: DataFrame) -> DataFrame:
    """`(id, part, failed, d1, d2)` of every row; narrow."""
    rows = docs.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return rows.mapInArrow(_facts, "id bigint, part string, failed int, d1 bigint, d2 bigint")


def survival(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`(id, part, failed, good, toxic)`: all five failures and the labels of every row."""
    rows = cut(facts(docs))
    # a row passes E if it is the first of its text; the join is on the id, of which a text has one smallest
    first = rows.groupBy("d1", "d2").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    known = known.agg(*[F.coalesce(F.max(c) == 1, F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    joined = rows.join(first, ["id", "d1", "d2"], "left").join(known, "id", "left")
    later = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return joined.select("id", "part", (F.col("failed") + later).alias("failed"), *flags)


def _positional(words: np.ndarray) -> np.ndarray:
    """How many words have each bit, by carry-save adders: three words of one weight become one and a carry."""
    counts = np.zeros(SUBSETS, dtype=np.int64)
    shifts = np.arange(SUBSETS, dtype=np.uint32)
    weight = 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * third :]))
        counts += weight * ((words[:, None] >> shifts) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return counts


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of each subset, for every part of a batch and for its labelled rows."""
    table = survival_words().astype(np.uint32)
    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        codes, words = parts.indices.to_numpy(), table[batch.column("failed").to_numpy()]
        chosen = [np.ones(len(words), dtype=bool), *(batch.column(c).to_numpy(zero_copy_only=False) for c in CLASSES[1:])]
        order = np.argsort(codes, kind="stable")
        stretches = np.split(order, np.cumsum(np.bincount(codes, minlength=len(parts.dictionary)))[:-1]) if len(order) else []
        sums = [[_positional(words[at[c[at]]]) for at in stretches] for c in chosen]
        yield pa.RecordBatch.from_arrays([parts.dictionary[: len(stretches)], *[pa.array(x, pa.list_(pa.int64())) for x in sums]], names=["part", *CLASSES])


def survivors(rows: DataFrame) -> DataFrame:
    """`(part, all, good, toxic)`: for each part how many rows survive each of the 32 subsets."""
    sums = rows.select("part", "failed", *CLASSES[1:]).mapInArrow(_sums, "part string, all array<bigint>, good array<bigint>, toxic array<bigint>")
    return sums.groupBy("part").agg(*[F.array(*[F.sum(F.col(c)[k]) for k in range(SUBSETS)]).alias(c) for c in CLASSES])


def _steps(left: np.ndarray) -> list[tuple]:
    """The rows of all orders from the survivors `left`, one row of it for each class."""
    everything, n = SUBSETS - 1, len(FILTERS)
    rows, removed_by = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            removed, good, toxic = (int(x) for x in left[:, before] - left[:, before | bit])
            failed = int(left[0, 0] - left[0, bit])
            alone = int(left[0, everything ^ bit] - left[0, everything])
            rows.append(("".join(order), step, letter, int(left[0, before | bit]), removed, failed - removed, alone, good, toxic))
            removed_by[letter] += removed
            before |= bit
    assert len(rows) == n * factorial(n)
    return [(o, step, *counts, removed_by[letter]) for o, step, letter, *counts in rows]


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
    for batch in batches:
        for k in range(batch.num_rows):
            rows = _steps(np.array([batch.column(c)[k].as_py() for c in CLASSES]))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("part")[k].as_py()] * len(rows), pa.string()), *columns], names=["part", *names])


def orders(left: DataFrame) -> DataFrame:
    """Every part, order and step with its counts; see the module for the meaning of the columns."""
    counts = ", ".join(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return left.mapInArrow(_orders, f"part string, filter_order string, step int, {counts}")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: `kept` after it, `removed` by it, `redundant` (failing its filter,
    removed before), `unique_fails` (failing its filter only), removed with a label (`good_lost`, `toxic_lost`), and
    `shapley` (what its filter removes, over all orders)."""
    return orders(survivors(survival(docs, labels)))


ORACLE_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), known AS (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
        CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
        + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
        + 16 * CAST(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t) AS INT) AS mask
    FROM texts LEFT JOIN known ON texts.doc_id = known.doc_id
), counted AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad FROM failed GROUP BY part, mask
), letters(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), all_orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM all_orders, range(1, 6) AS r(step)
), found AS (
    SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS kept,
        coalesce(sum(n) FILTER (mask & own > 0 AND mask & before = 0), 0) AS removed,
        coalesce(sum(n) FILTER (mask & own > 0 AND mask & before > 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
        coalesce(sum(n_good) FILTER (mask & own > 0 AND mask & before = 0), 0) AS good_lost,
        coalesce(sum(n_bad) FILTER (mask & own > 0 AND mask & before = 0), 0) AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found
"""
