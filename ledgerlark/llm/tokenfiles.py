"""Token ids as files of patched frame-of-reference blocks, written in id order and readable at any place.

A file set is a Parquet folder whose rows are segments of at most `SEGMENT` ids, so Spark's writers commit it and any
store can hold it. `pack` makes the bytes of a segment:

    header    4 bytes "PFR1", then little-endian 32-bit numbers: ids, ids a block, blocks, exceptions
    index     for each block its minimum (32 bits), where its packed bits start (32), its exceptions before (32), its width (8)
    payload   for each block, every id less the minimum in `width` bits, lowest first
    patches   for each exception its place in the block (16 bits), then for each the bits above the width (32)

The width of a block is the one that holds one of the `PERCENTILES` of its values, the percentile that makes the block
smallest; the few larger values are exceptions.
`unpack` decodes only the blocks that a range of places touches.

Documents are dealt by ranges of their ids and sorted, each range is encoded and written as it streams by, and no
document is held in more than one piece of text and one segment of ids. A document may reach over many segments. A
segment lists the documents that end in it, with their start and length in their part; the starts over all parts
follow from one count for each part.

The tokenizer must drop white space, and no match of its splitting rule may hold any. Then a text is encoded by its
runs between ASCII white space, and each worker remembers the ids of short runs.

A null text is an empty one and has the end id only. Rows without an id come first; rows with equal ids follow each
other by a hash of their texts, and each gives a row of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.hashing import PIECE, pieces

BLOCK = 256  # ids in a block, a multiple of eight
SEGMENT = 1 << 18  # ids in a segment
PERCENTILES = (75, 90, 95, 98, 100)
PATCH_BITS = 16 + 32
CACHE = 1_000_000  # runs and words after which a worker starts a new table and keeps the last one beside it
LONGEST = 64  # bytes of a run that is remembered

_HEADER = struct.Struct("<4s4I")
_WORD = re.compile(rb"([A-Za-z\x80-\xff]+)([.,;:!?]*)")


def pack(ids: np.ndarray, block: int = BLOCK, percentiles: tuple[int, ...] = PERCENTILES) -> bytes:
    """The segment of these ids."""
    n = len(ids)
    blocks = -(-n // block)
    rows = np.full(blocks * block, ids[-1] if n else 0, dtype=np.uint32)
    rows[:n] = ids
    rows = rows.reshape(blocks, block)
    low = rows.min(axis=1, initial=np.iinfo(np.uint32).max)
    gaps = rows - low[:, None]
    bits = np.frexp(gaps.astype(np.float64))[1].astype(np.uint8)
    ranks = [max(0, -(-p * block // 100) - 1) for p in percentiles]
    widths = np.partition(bits, ranks, axis=1)[:, ranks]
    cost = np.stack([block * w.astype(np.int64) + PATCH_BITS * (bits > w[:, None]).sum(axis=1) for w in widths.T], axis=1)
    width = np.take_along_axis(widths, cost.argmin(axis=1)[:, None], axis=1)[:, 0]
    starts = _starts(width, block)
    payload = np.empty(int(starts[-1]), dtype=np.uint8)
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        flags = np.unpackbits(gaps[some].astype("<u4").view(np.uint8).reshape(len(some), block, 4), axis=2, bitorder="little")[:, :, :w]
        payload[_places(starts[some], w, block)] = np.packbits(flags.reshape(len(some), -1), axis=1, bitorder="little")
    over = bits > width[:, None]
    owner, place = np.nonzero(over)
    before = np.concatenate(([0], np.cumsum(over.sum(axis=1))))[:-1]
    high = gaps[over] >> width[owner].astype(np.uint32)
    parts = [low.astype("<u4"), starts[:-1].astype("<u4"), before.astype("<u4"), width, payload, place.astype("<u2"), high.astype("<u4")]
    return _HEADER.pack(b"PFR1", n, block, blocks, len(place)) + b"".join(p.tobytes() for p in parts)


def _starts(width: np.ndarray, block: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(width.astype(np.int64) * (block // 8))))


def _places(starts: np.ndarray, width: int, block: int) -> np.ndarray:
    """The payload bytes of blocks of one width, a row for each block."""
    return starts[:, None] + np.arange(int(width) * (block // 8))


def unpack(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids at the places from `start` to before `stop`; only their blocks are decoded."""
    magic, n, block, blocks, patches = _HEADER.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a segment of packed ids")
    stop = n if stop is None else min(stop, n)
    if stop <= start:
        return np.zeros(0, dtype=np.uint32)
    at = _HEADER.size
    low, starts, before = (np.frombuffer(data, "<u4", blocks, at + k * 4 * blocks) for k in range(3))
    width = np.frombuffer(data, np.uint8, blocks, at + 12 * blocks)
    at += 13 * blocks
    payload = np.frombuffer(data, np.uint8, len(data) - at - 6 * patches, at)
    place = np.frombuffer(data, "<u2", patches, len(data) - 6 * patches)
    high = np.frombuffer(data, "<u4", patches, len(data) - 4 * patches)
    first, last = start // block, -(-stop // block)
    gaps = np.zeros((last - first, block), dtype=np.uint32)
    for w in np.unique(width[first:last]):
        some = np.flatnonzero(width[first:last] == w)
        flags = np.zeros((len(some), block, 32), dtype=np.uint8)
        if w:
            packed = payload[_places(starts[first + some].astype(np.int64), w, block)]
            flags[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(some), block, w)
        gaps[some] = np.packbits(flags, axis=2, bitorder="little").view("<u4")[:, :, 0]
    a, b = int(before[first]), int(before[last]) if last < blocks else patches
    if b > a:
        owner = np.repeat(np.arange(last - first), np.diff(np.append(before[first:last].astype(np.int64), b)))
        gaps[owner, place[a:b]] |= high[a:b] << width[first + owner].astype(np.uint32)
    return (gaps + low[first:last, None]).reshape(-1)[start - first * block : stop - first * block]


class Codec:
    """One vocabulary, with the ids of the runs met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks already use all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends: np.ndarray | None = None  # ids that end a word, if the vocabulary has such
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for word, i in vocabulary.items() if word.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}  # what was known before the last time `known` was full

    def encode(self, data: bytes) -> bytes:
        """Ids of a text, as little-endian 32-bit numbers."""
        if len(self.known) > CACHE:
            self.earlier, self.known = self.known, {}
        runs = data.split()
        try:
            return b"".join(map(self.known.__getitem__, runs))
        except KeyError:
            pass
        ids = self._learn({*runs}.difference(self.known))
        try:
            return b"".join(map(self.known.__getitem__, runs))
        except KeyError:  # long runs are not remembered
            return b"".join([ids[r] if r in ids else self.known[r] for r in runs])

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """Ids of runs not known so far. A run of letters and a last stop is encoded as these two, so that `Word`,
        `word` and `word.` share an entry."""
        found = {run: self.earlier[run] for run in new if run in self.earlier}
        split: dict[bytes, tuple[bytes, bytes]] = {}
        wanted, words = set(), set()
        for run in new.difference(found):
            match = _WORD.fullmatch(run) if self.ends is not None else None
            if match and match[1].decode("utf-8", "replace").isalpha():  # letters only: no marks that join across case
                head, tail = match[1].lower(), match[2]
                split[run] = head, tail
                if head not in self.known:
                    words.add(head)
                if tail and tail not in self.known:
                    wanted.add(tail)
            else:
                wanted.add(run)
        parts = self._words([*words]) | self._runs([*wanted])
        for run, (head, tail) in split.items():
            ids = parts[head] if head in parts else self.known[head]
            if tail:
                ids += parts[tail] if tail in parts else self.known[tail]
            found[run] = ids
        found |= {run: parts[run] for run in wanted}
        for some in (parts, found):
            short = max(map(len, some), default=0) <= LONGEST
            self.known.update(some if short else {r: i for r, i in some.items() if len(r) <= LONGEST})
        return found

    def _runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        found = self.tokenizer.encode_batch_fast([r.decode("utf-8", "replace") for r in runs], add_special_tokens=False)
        return {r: np.array(f.ids, dtype="<u4").tobytes() for r, f in zip(runs, found, strict=True)}

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words of letters, encoded in one go and told apart by the ids that end a word."""
        if not words:
            return {}
        text = b" ".join(words).decode("utf-8", "replace")
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or last[-1] != len(ids) - 1:  # another notion of a letter
            return self._runs(words)
        data, edges = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        return {w: data[a:b] for w, a, b in zip(words, edges[:-1], edges[1:], strict=True)}


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of this vocabulary."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))
_SEGMENTS = "part int, segment int, first bigint, n int, open bigint, docs array<struct<doc_id: bigint, start: bigint, n: bigint>>, data binary"


class _Part:
    """Ids of one part on their way into segments."""

    def __init__(self, number: int, size: int):
        self.number, self.size = number, size
        self.held: list[bytes] = []
        self.waiting = self.first = self.segment = 0  # ids held, ids and segments written
        self.docs: list[dict] = []

    def add(self, ids: bytes, start: int) -> Iterator[pa.RecordBatch]:
        """Take ids of the document that began at `start`; full segments come out."""
        self.held.append(ids)
        self.waiting += len(ids) // 4
        while self.waiting >= self.size:
            yield self._row(self.size, start)

    def _row(self, n: int, start: int | None) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(self.held), dtype="<u4")
        end = self.first + n
        self.held, self.waiting = [ids[n:].tobytes()], len(ids) - n
        row = [self.number, self.segment, self.first, n, start if start is not None and start < end else None, self.docs, pack(ids[:n])]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), _DOCS, pa.binary()]
        self.first, self.segment, self.docs = end, self.segment + 1, []
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=["part", "segment", "first", "n", "open", "docs", "data"])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            yield self._row(self.waiting, None)


def _encode_parts(path: str, end_id: int, size: int):
    mark = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for k in range(batch.num_rows):
                if part is None:
                    part = _Part(batch.column("part")[k].as_py(), size)
                start = part.first + part.waiting
                for piece in pieces(batch.column("text")[k].as_py()):
                    yield from part.add(codec(path).encode(piece), start)
                # the end id completes the document, and is listed in the segment that holds it
                n = part.first + part.waiting + 1 - start
                part.docs.append({"doc_id": batch.column("doc_id")[k].as_py(), "start": start, "n": n})
                yield from part.add(mark, start + n)
        if part is not None:
            yield from part.end()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, size: int = SEGMENT) -> None:
    """Encode every text with the vocabulary at `path`, append `end_id` and write the ids in id order to `folder`."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # the last two columns let one id with very many rows spread over several parts
    rows = rows.withColumns({"order": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange("doc_id", "order", "row").sortWithinPartitions("doc_id", "order", "row")
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    rows.mapInArrow(_encode_parts(path, end_id, size), _SEGMENTS).write.parquet(folder)


def _part_starts(segments: DataFrame) -> DataFrame:
    """`(part, before)`: the ids of all parts before each. One number for each part comes to the driver."""
    counts = sorted((r.part, r.n) for r in segments.groupBy("part").agg(F.sum("n").alias("n")).collect())
    rows, before = [], 0
    for part, n in counts:
        rows.append((part, before))
        before += n
    return segments.sparkSession.createDataFrame(rows, "part int, before bigint")


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """`(doc_id, start, n_tokens, part, first)` of every document; reads no ids. `first` is its place in its part."""
    segments = spark.read.parquet(folder)
    found = segments.select("part", F.explode("docs").alias("d")).join(F.broadcast(_part_starts(segments)), "part")
    return found.select("d.doc_id", (F.col("before") + F.col("d.start")).alias("start"), F.col("d.n").alias("n_tokens"), "part", F.col("d.start").alias("first"))


def read_tokens(spark: SparkSession, folder: str, wanted: DataFrame, size: int = SEGMENT) -> DataFrame:
    """`(doc_id, start, piece, ids)`: the ids of the documents in `wanted` (doc_id), in pieces of one segment each.

    Only the segments that hold a wanted document are joined, and of these only the blocks that it touches are decoded.
    """
    places = document_index(spark, folder).join(wanted.select("doc_id").distinct(), "doc_id")
    first, last = (F.floor(c / size) for c in (F.col("place"), F.col("place") + F.col("n_tokens") - 1))
    places = places.withColumnRenamed("first", "place").withColumn("segment", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    rows = places.join(spark.read.parquet(folder).select("part", "segment", "first", "data"), ["part", "segment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc, start, segment, place, n, first, data = (batch.column(c)[row].as_py() for c in ("doc_id", "start", "segment", "place", "n_tokens", "first", "data"))
                ids = unpack(data, max(0, place - first), place + n - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([start], pa.int64()), pa.array([segment - place // size], pa.int32()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["doc_id", "start", "piece", "ids"],
                )

    return rows.mapInArrow(run, "doc_id bigint, start bigint, piece int, ids array<int>")


def join_crc(a: int, b: int, n: int) -> int:
    """The crc32 of two stretches joined, from their own and the number of bytes of the second."""
    zeros, none = a, 0
    while n:
        some = bytes(min(n, PIECE))
        zeros, none, n = zlib.crc32(some, zeros), zlib.crc32(some, none), n - len(some)
    return zeros ^ none ^ b


def _crc_pieces(whole: bool):
    """Crc32 and size of each document that lies in a segment, or of each stretch of one that reaches over its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, segment, first, n, opened, docs, data = (batch.column(c)[k].as_py() for c in ("part", "segment", "first", "n", "open", "docs", "data"))
                docs = [d for d in docs if (d["start"] >= first) == whole]
                if not whole and opened is not None:
                    docs.append({"doc_id": None, "start": opened, "n": first + n - opened})
                stretches = [(max(d["start"], first), d["start"] + d["n"]) for d in docs]
                if whole:
                    ids = memoryview(unpack(data).astype("<u4").tobytes())
                    crcs = [zlib.crc32(ids[4 * (a - first) : 4 * (b - first)]) for a, b in stretches]
                else:
                    crcs = [zlib.crc32(unpack(data, a - first, b - first).astype("<u4").tobytes()) for a, b in stretches]
                columns = {
                    "part": pa.array([part] * len(docs), pa.int32()), "first": pa.array([d["start"] for d in docs], pa.int64()), "segment": pa.array([segment] * len(docs), pa.int32()),
                    "doc_id": pa.array([d["doc_id"] for d in docs], pa.int64()), "n": pa.array([d["n"] for d in docs], pa.int64()),
                    "crc": pa.array(crcs, pa.int64()), "size": pa.array([4 * (b - a) for a, b in stretches], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def token_checks(spark: SparkSession, folder: str) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32)` of every document, from the files.

    Segments are read where they lie. Only documents that reach over several are put together, by a few numbers for
    each of their stretches.
    """
    segments = spark.read.parquet(folder)
    shape = "part int, first bigint, segment int, doc_id bigint, n bigint, crc bigint, size bigint"
    stretches = F.array_sort(F.collect_list(F.struct("segment", "crc", "size"))).alias("stretches")
    # a document's own row is the one of its last segment
    pieces_of = segments.mapInArrow(_crc_pieces(False), shape).groupBy("part", "first").agg(F.max_by("doc_id", "segment").alias("doc_id"), F.max_by("n", "segment").alias("n"), stretches)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for row in batch.column("stretches").to_pylist():
                crc = 0
                for stretch in row:
                    crc = join_crc(crc, stretch["crc"], stretch["size"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "first", "doc_id", "n")), pa.array(crcs, pa.int64())], names=["part", "first", "doc_id", "n", "crc"])

    joined = pieces_of.mapInArrow(fold, "part int, first bigint, doc_id bigint, n bigint, crc bigint")
    rows = segments.mapInArrow(_crc_pieces(True), shape).select("part", "first", "doc_id", "n", "crc").unionByName(joined)
    starts = F.broadcast(_part_starts(segments))
    return rows.join(starts, "part").select("doc_id", (F.col("before") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
