"""Byte-level BPE by overlapping chunks, for texts of any length.

`encode` cuts every text longer than `size` characters into chunks that reach `overlap` characters into the next one.
Chunks are rows and are dealt evenly, so one long text is worked on by many tasks. First each chunk is pre-tokenised
alone, from wherever it begins. The pattern looks only to the right, so two neighbours agree from the first boundary
on that both have in their overlap; there they are stitched. Then each chunk's pieces, from its own stitch to the
next one, are encoded. If two neighbours share no boundary (one piece longer than the overlap), that text is matched
in one go: always right, and as parallel as the other texts. Decoding looks ids up and joins their bytes.

A null text is an empty one; an empty text has no ids. Rows with equal ids, and repeated rows, each give a row. Other
columns are ignored. Ranks come from a file whose path is a parameter (readable on every executor, like any installed
package's file); each Python worker reads it once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SIZE = 32_768  # characters in a chunk
OVERLAP = 512
CACHE = 400_000  # different pieces a worker remembers


class Codec:
    """One vocabulary: texts to pieces, pieces to ids, ids to bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.merges = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def starts(self, text: str) -> np.ndarray:
        """Where the pieces of a text start."""
        lengths = np.array([len(p) for p in self.pattern.findall(text)], dtype=np.int64)
        if lengths.sum() == len(text):
            return np.cumsum(lengths) - lengths
        return np.array([m.start() for m in self.pattern.finditer(text)], dtype=np.int64)  # it skips characters

    def encode(self, text: str) -> bytes:
        """Ids of all pieces as little-endian 32-bit numbers."""
        pieces, known = self.pattern.findall(text), self.known
        if len(known) > CACHE:
            known.clear()
        for piece in {*pieces}.difference(known):
            known[piece] = np.array(self.merges.encode_ordinary(piece), dtype="<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of this vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def chunks(text: str, size: int, overlap: int) -> list[str]:
    """Every chunk with its reach into the next; the last one holds the rest, up to twice the size."""
    n = max(1, len(text) // size)
    return [text[k * size : (k + 1) * size + overlap if k < n - 1 else len(text)] for k in range(n)]


def _cut(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                parts = chunks(text.as_py(), size, overlap)
                for at in range(0, len(parts), 64):
                    some = parts[at : at + 64]
                    yield pa.RecordBatch.from_pydict({"key": [key.as_py()] * len(some), "chunk": pa.array(range(at, at + len(some)), pa.int32()), "part": some})

    return run


def _edges(path: str, pattern: str, size: int, overlap: int):
    """Boundaries in the first characters of a chunk and in its reach into the next, from those places on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [codec(path, pattern).starts(part.as_py()) for part in batch.column("part")]
            head = [s[s < overlap].tolist() for s in starts]
            tail = [s[(s >= size) & (s < size + overlap)].tolist() for s in starts]
            tail = [[p - size for p in t] for t in tail]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("chunk"), pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], names=["key", "chunk", "head", "tail"])

    return run


def _encode_parts(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [codec(path, pattern).encode(p.as_py()) for p in some.column("part")]
                yield pa.RecordBatch.from_arrays([some.column("key"), some.column("chunk"), pa.array(ids, pa.binary())], names=["key", "chunk", "ids"])

    return run


def stitched(long: DataFrame, path: str, pattern: str, size: int, overlap: int) -> DataFrame:
    """`(key, chunk, ids)` of texts with several chunks; the ids of a text in chunk order are its ids."""
    cut = long.mapInArrow(_cut(size, overlap), "key string, chunk int, part string").repartition("key", "chunk")
    edges = cut.mapInArrow(_edges(path, pattern, size, overlap), "key string, chunk int, head array<int>, tail array<int>")
    following = Window.partitionBy("key").orderBy("chunk")  # a few hundred bytes for each chunk
    # the first boundary that both neighbours have; null where they share none
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(following)))
    joints = edges.dropDuplicates(["key", "chunk"]).select("key", "chunk", F.when(F.col("chunk") == 0, 0).otherwise(shared).alias("start"))
    joints = joints.withColumns({"stop": F.lead("start").over(following), "broken": F.max(F.col("start").isNull()).over(Window.partitionBy("key"))})
    begin = F.col("start")
    stop = F.coalesce(F.col("stop") + size, F.length("part"))  # the last chunk has no stop
    parts = (
        cut.join(joints.where(~F.col("broken")), ["key", "chunk"])
        .select("key", "chunk", F.col("part").substr(begin + 1, stop - begin).alias("part"))
    )
    whole = long.join(joints.where(F.col("broken") & (F.col("chunk") == 0)).select("key", "chunk"), "key").select("key", "chunk", F.col("text").alias("part"))
    return parts.unionByName(whole).mapInArrow(_encode_parts(path, pattern), "key string, chunk int, ids binary")


def _digests(path: str, pattern: str):
    """Digests of the ids of each key and of the bytes they stand for, from rows sorted by key and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None
        for batch in batches:
            done = []
            for k, chunk, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "chunk", "ids")), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, n, of_ids.hexdigest(), of_bytes.hexdigest()))
                    key, last, n, of_ids, of_bytes = k, None, 0, hashlib.sha256(), hashlib.sha256()
                if chunk != last:  # repeated rows bring the same chunk again
                    last, n = chunk, n + len(ids) // 4
                    of_ids.update(ids)
                    of_bytes.update(codec(path, pattern).decode(ids))
            yield _rows(done)
        if key is not None:
            yield _rows([(key, n, of_ids.hexdigest(), of_bytes.hexdigest())])

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"key": pa.string(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())], names=[*kinds])


def _short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                ids = codec(path, pattern).encode(text.as_py())
                found.append((None, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec(path, pattern).decode(ids)).hexdigest()))
            rows = _rows(found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rows.columns[1:]], names=["doc_id", *rows.schema.names[1:]])

    return run


def _texts(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Texts of one chunk, and those of several with a key that equal rows share."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    several: Column = F.length("text") >= 2 * size
    key = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text")), 256)
    return rows.where(~several), rows.where(several).withColumn("key", key)


def encode(docs: DataFrame, path: str, pattern: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """`(doc_id, chunk, ids)`: the ids of every text, one row for each of its parts, in chunk order."""
    short, long = _texts(docs, size)
    one = short.select(F.col("doc_id").cast("string").alias("key"), F.lit(0).alias("chunk"), F.col("text").alias("part"))
    ids = one.mapInArrow(_encode_parts(path, pattern), "key string, chunk int, ids binary").select(F.col("key").cast("bigint").alias("doc_id"), "chunk", "ids")
    parts = stitched(long.select("key", "text").dropDuplicates(["key"]), path, pattern, size, overlap)
    return ids.unionByName(long.select("doc_id", "key").join(parts, "key").drop("key"))


def decode(parts: DataFrame, path: str, pattern: str) -> DataFrame:
    """`(doc_id, chunk, data)`: the bytes the ids of each part stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [codec(path, pattern).decode(ids.as_py()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chunk"), pa.array(data, pa.binary())], names=["doc_id", "chunk", "data"])

    return parts.select("doc_id", "chunk", "ids").mapInArrow(run, "doc_id bigint, chunk int, data binary")


def token_digests(docs: DataFrame, path: str, pattern: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Number of tokens and SHA-256 of ids and decoded bytes, one row per row of `docs`."""
    short, long = _texts(docs, size)
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    one = short.mapInArrow(_short(path, pattern), f"doc_id bigint, {schema}")
    parts = stitched(long.select("key", "text"), path, pattern, size, overlap)
    many = parts.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(_digests(path, pattern), f"key string, {schema}")
    return one.unionByName(long.select("doc_id", "key").join(many, "key").drop("key"))
