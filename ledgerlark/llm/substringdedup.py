"""Substring dedup with difference-cover anchors.

A window is `WINDOW` consecutive words. A word goes if a window that covers it has the same words as one that starts
in a document with a smaller id; windows are judged on the input. Hashes of runs of `GRAM` words are taken only at
places that are 1, 2 or 4 modulo 7. These residues are a difference cover: for any two places some shift below 7 puts
both on the cover. A window holds all seven shifts of a run, so two equal windows always share an anchor.

1. Documents are dealt into groups. A group lists its different anchors, in buckets by hash.
2. A bucket meets all groups' lists and answers, one bit per anchor, which occur in two documents.
3. Only windows around such an anchor are extended to their full length. A group lists their 96-bit hashes with the
   smallest id that has them, and the buckets answer, one bit per window, if another group has a smaller one.
4. The group marks the covered words of its documents.

A group sends an anchor or window once however often it occurs there, so a passage that a third of all documents
share is one entry per group. Groups and buckets follow the number of bytes, and none holds more for more data. The
texts are shuffled once, into groups; the steps read that same exchange.

Null texts have no words. A null id counts as larger than any other. Documents with equal ids do not remove each
other's words; rows are told apart, repeated ones give equal results. Other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import sequence_hashes, word_hashes

WINDOW = 13
COVER = (1, 2, 4)  # residues modulo PERIOD; every residue is a difference of two of them
PERIOD = 7
GRAM = WINDOW - PERIOD + 1
GROUP_BYTES = 4 << 20  # of text in a group
BUCKET_BYTES = 16 << 20  # of text whose anchors or windows meet in a bucket
LAST = np.iinfo(np.int64).max  # stands for a null id

ANSWERS = "g long, bucket long, kind int, bits binary"


class Anchored:
    """The words of a group's documents and their anchors."""

    def __init__(self, table: pa.Table):
        self.ids = [LAST if i is None else i for i in table.column("doc_id").to_pylist()]
        self.data = [(t or "").encode("utf-8", "replace") for t in table.column("text").to_pylist()]
        self.words = [word_hashes(d) for d in self.data]
        self.places, hashes, owners = [], [], []
        for k, words in enumerate(self.words):
            places = np.arange(len(words) - GRAM + 1 if len(words) >= WINDOW else 0)
            places = places[np.isin(places % PERIOD, COVER)]
            self.places.append(places)
            hashes.append(sequence_hashes(words, GRAM)[places] >> np.uint64(1) if len(places) else np.zeros(0, dtype=np.uint64))
            owners.append(np.full(len(places), self.ids[k], dtype=np.int64))
        hashes, owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, dtype=np.intp)
        self.different = ordered[first]
        self.number = np.empty(len(hashes), dtype=np.intp)  # of each anchor among the different ones
        self.number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ordered))))
        ids = owners[order]
        self.twice = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first) if len(first) else np.zeros(0, dtype=bool)

    def windows(self, shared: np.ndarray) -> None:
        """Keep the windows around shared anchors: their document, start and hashes, and the different ones."""
        at, owners, starts, hashes, tails = 0, [], [], [], []
        for k, words in enumerate(self.words):
            places = self.places[k]
            if not len(places):
                continue
            flags = np.zeros(len(words) - GRAM + 2, dtype=np.int32)
            flags[places + 1] = shared[self.number[at : at + len(places)]]
            at += len(places)
            seen = np.cumsum(flags)
            chosen = np.flatnonzero(seen[PERIOD:] > seen[:-PERIOD])
            if len(chosen):
                owners.append(np.full(len(chosen), k))
                starts.append(chosen)
                hashes.append(sequence_hashes(words, WINDOW, seed=21)[chosen])
                tails.append((sequence_hashes(words, WINDOW, seed=22)[chosen] >> np.uint64(32)).astype(np.uint32))
        empty = np.zeros(0, dtype=np.intp)
        self.owner, self.start = (np.concatenate(x) if x else empty for x in (owners, starts))
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        tails = np.concatenate(tails) if tails else np.zeros(0, dtype=np.uint32)
        order = np.lexsort((tails, hashes))
        first = _firsts(hashes[order], tails[order])
        self.window = np.empty(len(hashes), dtype=np.intp)
        self.window[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(hashes))))
        self.hashes, self.tails = hashes[order][first], tails[order][first]
        self.id_of = np.array(self.ids, dtype=np.int64)[self.owner]
        self.smallest = np.minimum.reduceat(self.id_of[order], first) if len(first) else np.zeros(0, dtype=np.int64)


def _firsts(hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Where a new pair begins in sorted arrays."""
    if not len(hashes):
        return np.zeros(0, dtype=np.intp)
    return np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (tails[1:] != tails[:-1]))))


def _slices(sorted_hashes: np.ndarray, bits: int, buckets: int) -> list[tuple[int, slice]]:
    """The non-empty stretch of each bucket; buckets are ranges of the hash."""
    place = (sorted_hashes >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1], [True]))) if len(place) else np.zeros(1, dtype=np.intp)
    return [(int(place[a]), slice(int(a), int(b))) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _read_answers(table: pa.Table, kind: int, stretches: list[tuple[int, slice]], n: int) -> np.ndarray:
    """The bits of all buckets, in the order of the list they answer."""
    flags = np.zeros(n, dtype=bool)
    bits = {b: x for k, b, x in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True) if k == kind}
    for bucket, stretch in stretches:
        flags[stretch] = np.unpackbits(np.frombuffer(bits[bucket], dtype=np.uint8), count=stretch.stop - stretch.start)
    return flags


def _list_anchors(buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = Anchored(table)
        marked = group.different << np.uint64(1) | group.twice
        rows = [(key[0].as_py(), b, marked[s].tobytes()) for b, s in _slices(group.different, 63, buckets)]
        return pa.table({"g": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([r[1] for r in rows], pa.int64()), "data": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _answer_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """Which anchors of each list occur in two documents."""
    lists = [np.frombuffer(x, dtype=np.uint64) for x in table.column("data").to_pylist()]
    all_marked = np.concatenate(lists)
    order = np.argsort(all_marked, kind="stable")
    hashes = all_marked[order] >> np.uint64(1)
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    count = np.diff(np.append(first, len(hashes)))
    shared = (count > 1) | (np.maximum.reduceat(all_marked[order] & np.uint64(1), first) > 0)
    flags = np.empty(len(hashes), dtype=bool)
    flags[order] = np.repeat(shared, count)
    return _answers(table, 0, flags, [len(x) for x in lists])


def _answers(table: pa.Table, kind: int, flags: np.ndarray, lengths: list[int]) -> pa.Table:
    parts = np.split(flags, np.cumsum(lengths)[:-1])
    return pa.table({"g": table.column("g"), "bucket": table.column("bucket"), "kind": pa.array([kind] * len(parts), pa.int32()), "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())})


def _list_windows(buckets: int):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if texts.num_rows:
            group = Anchored(texts)
            group.windows(_read_answers(answers, 0, _slices(group.different, 63, buckets), len(group.different)))
            for b, s in _slices(group.hashes, 64, buckets):
                ids = group.smallest[s]
                low = int(ids.min())
                near = (ids - low).astype(np.uint64)
                short = int(near.max()) < 1 << 32
                rows.append((key[0].as_py(), b, group.hashes[s].tobytes(), group.tails[s].tobytes(), low, (near.astype(np.uint32) if short else near).tobytes()))
        kinds = {"g": pa.int64(), "bucket": pa.int64(), "hashes": pa.binary(), "tails": pa.binary(), "low": pa.int64(), "ids": pa.binary()}
        return pa.table({name: pa.array([r[k] for r in rows], t) for k, (name, t) in enumerate(kinds.items())})

    return run


def _answer_windows(key: tuple, table: pa.Table) -> pa.Table:
    """Which windows of each list another list has with a smaller id."""
    hashes = [np.frombuffer(x, dtype=np.uint64) for x in table.column("hashes").to_pylist()]
    tails = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table.column("tails").to_pylist()])
    ids = []
    for n, low, x in zip(map(len, hashes), table.column("low").to_pylist(), table.column("ids").to_pylist(), strict=True):
        ids.append(np.frombuffer(x, dtype=np.uint32 if len(x) == 4 * n else np.uint64).astype(np.int64) + low)
    lengths = [len(h) for h in hashes]
    hashes, ids = np.concatenate(hashes), np.concatenate(ids)
    order = np.lexsort((tails, hashes))
    first = _firsts(hashes[order], tails[order])
    lowest = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(hashes))))
    flags = np.empty(len(hashes), dtype=bool)
    flags[order] = lowest < ids[order]
    return _answers(table, 1, flags, lengths)


def _remove(buckets: int):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        removed, kept, counts = [], [], []
        if texts.num_rows:
            group = Anchored(texts)
            group.windows(_read_answers(answers, 0, _slices(group.different, 63, buckets), len(group.different)))
            elsewhere = _read_answers(answers, 1, _slices(group.hashes, 64, buckets), len(group.hashes))
            gone = elsewhere[group.window] | (group.smallest[group.window] < group.id_of)
            starts, owners = group.start[gone], group.owner[gone]
            edges = np.searchsorted(owners, np.arange(len(group.data) + 1))
            for k, data in enumerate(group.data):
                n, own = len(group.words[k]), starts[edges[k] : edges[k + 1]]
                counts.append(n)
                if len(own):
                    steps = np.bincount(own, minlength=n + 1) - np.bincount(own + WINDOW, minlength=n + 1)
                    keep = np.cumsum(steps)[:n] == 0
                    removed.append(n - int(keep.sum()))
                    kept.append(b" ".join(compress(data.split(), keep.tolist())).decode("utf-8", "replace"))
                else:
                    removed.append(0)
                    kept.append(b" ".join(data.split()).decode("utf-8", "replace"))
        return pa.table(
            {"doc_id": pa.array(texts.column("doc_id").to_pylist() if texts.num_rows else [], pa.int64()), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())}
        )

    return run


def substring_dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """`(doc_id, n_words, n_removed, kept)` of every row; `kept` has the words left, joined by one space."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = (max(1, math.ceil(size / per)) for per in (group_bytes, bucket_bytes))
    texts = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups).cast("long")).alias("g"))
    lists = texts.groupBy("g").applyInArrow(_list_anchors(buckets), "g long, bucket long, data binary")
    shared = lists.groupBy("bucket").applyInArrow(_answer_anchors, ANSWERS)
    windows = texts.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_list_windows(buckets), "g long, bucket long, hashes binary, tails binary, low long, ids binary")
    earlier = windows.groupBy("bucket").applyInArrow(_answer_windows, ANSWERS)
    answers = shared.unionByName(earlier)
    return texts.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(_remove(buckets), "doc_id long, n_words long, n_removed long, kept string")
