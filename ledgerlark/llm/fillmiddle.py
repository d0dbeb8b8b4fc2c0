"""Fill-in-the-middle over texts stored as seekable compressed frames.

`frames` cuts a text into frames of about `FRAME` bytes, each compressed on its own, with the number of units that start
before each frame's end and the code points up to there. A unit is a run of ASCII letters or any other code point; a run
that goes on in the next frame counts where it starts, so a frame never has to hold a whole run.

`transform` draws the two cuts from a hash of the document's id. It finds the frames of the cuts by their counts,
decompresses these two alone to place the cuts, and streams the frames in the order of the output, which becomes frames
again. `restore` finds the marks in an output, streams its parts back in the order of the text and so needs no look at
the text. No step holds more than one frame of text beside the compressed ones, and none shuffles.

The form of a document is "plain" (its text as it is) if the text is empty or has one of the marks, or by the draw;
else "psm" or "spm", after the order of prefix, suffix and middle.

A null text is an empty one. A null id has no digits: its draw is that of the salt alone. Repeated rows give equal rows.
An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME = 1 << 16  # bytes of text in a frame
LEVEL = 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SALT = "1:"

_FRAMES = pa.list_(pa.struct([("size", pa.int64()), ("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))
_FRAMES_SQL = "array<struct<size: bigint, units: bigint, chars: bigint, data: binary>>"


def unit_starts(data: bytes, before: int) -> np.ndarray:
    """Where units start in a stretch of UTF-8 bytes that follows the byte `before`."""
    text = np.frombuffer(data, dtype=np.uint8)
    letter = (text | 0x20) - np.uint8(0x61) < 26  # smaller bytes wrap
    follows = np.empty(len(text), dtype=bool)
    follows[1:] = letter[:-1]
    if len(text):
        follows[0] = chr(before).isalpha() and before < 128
    return np.flatnonzero(np.where(letter, ~follows, (text & 0xC0) != 0x80))


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def frames(parts: Iterator[bytes]) -> list[dict]:
    """Compressed frames of a text that comes in parts, with the bytes, units and code points up to the end of each."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    found, size, units, chars, last = [], 0, 0, 0, 0
    for data in parts:
        size, units, chars, last = size + len(data), units + len(unit_starts(data, last)), chars + code_points(data), data[-1]
        found.append({"size": size, "units": units, "chars": chars, "data": squeeze.compress(data)})
    return found


def _stretches(data: bytes, frame: int) -> Iterator[bytes]:
    """A text in parts of about `frame` bytes that end between code points."""
    at = 0
    while at < len(data):
        end = at + frame
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


class Stored:
    """A text in frames, of which any range can be read."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.ends = {c: [r[c] for r in rows] for c in ("size", "units", "chars")}
        self.loosen = zstandard.ZstdDecompressor()

    def total(self, column: str) -> int:
        return self.ends[column][-1] if self.rows else 0

    def before(self, column: str, k: int) -> int:
        return self.ends[column][k - 1] if k else 0

    def frame(self, k: int) -> bytes:
        size = self.ends["size"][k] - self.before("size", k)
        return self.loosen.decompress(self.rows[k]["data"], max_output_size=size)

    def place(self, unit: int) -> tuple[int, int]:
        """The byte and the code point where a unit starts; the end of the text for the number of all units."""
        if unit >= self.total("units"):
            return self.total("size"), self.total("chars")
        k = bisect_right(self.ends["units"], unit)
        data = self.frame(k)
        last = self.frame(k - 1)[-1] if k else 0
        at = int(unit_starts(data, last)[unit - self.before("units", k)])
        return self.before("size", k) + at, self.before("chars", k) + code_points(data[:at])

    def read(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes from `start` to before `stop`, frame by frame."""
        k = bisect_right(self.ends["size"], start)
        while k < len(self.rows) and (first := self.before("size", k)) < stop:
            yield self.frame(k)[max(0, start - first) : stop - first]
            k += 1

    def find(self, mark: bytes, start: int = 0) -> int:
        """Where a mark first stands, also across frames; -1 if nowhere."""
        tail, at = b"", start
        for data in self.read(start, self.total("size")):
            seen = tail + data
            if (found := seen.find(mark)) >= 0:
                return at - len(tail) + found
            at, tail = at + len(data), seen[len(seen) - len(mark) + 1 :] if len(seen) >= len(mark) else seen
        return -1


def draws(doc_id: int | None, salt: str = SALT) -> list[int]:
    """Four numbers of 32 bits from the id."""
    digest = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def store(docs: DataFrame, frame: int = FRAME) -> DataFrame:
    """`(doc_id, marked, frames)`: every text in compressed frames; `marked` if it holds one of the marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [t.as_py() for t in some.column("text")]
                marked = [any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
                rows = [frames(_stretches(t, frame)) for t in texts]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(marked, pa.bool_()), pa.array(rows, _FRAMES)], names=["doc_id", "marked", "frames"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id bigint, marked boolean, frames {_FRAMES_SQL}")


def _form(empty: bool, marked: bool, h3: int, h4: int) -> str:
    if empty or marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        return "plain"
    return "spm" if h4 % 100 < SPM_PERCENT else "psm"


def _ordered(text: Stored, form: str, first: int, second: int) -> Iterator[bytes]:
    """The output in parts of a frame at most."""
    prefix, middle, suffix = (0, first), (first, second), (second, text.total("size"))
    orders = {
        "plain": [(b"", (0, text.total("size")))],
        "psm": [(PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)],
        "spm": [(SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)],
    }
    for mark, (start, stop) in orders[form]:
        if mark:
            yield mark
        if stop > start:
            yield from text.read(start, stop)


def _rebuilt(output: Stored, form: str) -> Iterator[bytes]:
    """The text in order, from an output and its form alone."""
    size = output.total("size")
    if form == "plain":
        return output.read(0, size)
    marks = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    second = output.find(marks[1], len(marks[0]))
    middle = output.find(MIDDLE, second + len(marks[1]))
    places = {marks[0]: (len(marks[0]), second), marks[1]: (second + len(marks[1]), middle), MIDDLE: (middle + len(MIDDLE), size)}
    return (data for mark in (PREFIX, MIDDLE, SUFFIX) for data in output.read(*places[mark]))


def _gathered(parts: Iterator[bytes], frame: int) -> Iterator[bytes]:
    """Small parts joined until they fill a frame."""
    held, size = [], 0
    for part in parts:
        if not part:
            continue
        held.append(part)
        size += len(part)
        if size >= frame:
            yield b"".join(held)
            held, size = [], 0
    if held:
        yield b"".join(held)


def transform(stored: DataFrame, frame: int = FRAME, salt: str = SALT) -> DataFrame:
    """`(doc_id, n, form, prefix_chars, middle_chars, frames)`: units, form and output of every stored text.

    The output is in frames; `text` gives it as one string. Lengths are in code points, null if the form is plain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = []
                for doc_id, marked, held in zip(*(some.column(c) for c in ("doc_id", "marked", "frames")), strict=True):
                    text = Stored(held.as_py())
                    n = text.total("units")
                    h1, h2, h3, h4 = draws(doc_id.as_py(), salt)
                    form = _form(not n, marked.as_py(), h3, h4)
                    (first, chars), (second, more) = (0, 0), (0, 0)
                    if form != "plain":
                        (first, chars), (second, more) = (text.place(cut) for cut in sorted((h1 % (n + 1), h2 % (n + 1))))
                    lengths = [None, None] if form == "plain" else [chars, more - chars]
                    rows.append([n, form, *lengths, frames(_gathered(_ordered(text, form, first, second), frame))])
                kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "frames": _FRAMES}
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *columns], names=["doc_id", *kinds])

    return stored.mapInArrow(run, f"doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, frames {_FRAMES_SQL}")


def _added(outputs: DataFrame, name: str, kind: str, make: Callable[[Stored, str], object]) -> DataFrame:
    """The columns of `outputs` without the frames, and one made from them and the form."""
    kept = [c for c in outputs.columns if c != "frames"]
    arrow = {"string": pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                made = [make(Stored(held.as_py()), form.as_py()) for held, form in zip(some.column("frames"), some.column("form"), strict=True)]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), pa.array(made, arrow)], names=[*kept, name])

    fields = ", ".join(f"{c} {outputs.schema[c].dataType.simpleString()}" for c in kept)
    return outputs.mapInArrow(run, f"{fields}, {name} {kind}")


def text(outputs: DataFrame) -> DataFrame:
    """The outputs as strings, in a column `output` in place of the frames."""
    return _added(outputs, "output", "string", lambda stored, _: b"".join(stored.read(0, stored.total("size"))).decode("utf-8", "replace"))


def restore(outputs: DataFrame) -> DataFrame:
    """The texts rebuilt from outputs and forms, in a column `text` in place of the frames."""
    return _added(outputs, "text", "string", lambda stored, form: b"".join(_rebuilt(stored, form)).decode("utf-8", "replace"))


def _digest(parts: Iterator[bytes]) -> str:
    total = hashlib.sha256()
    for part in parts:
        total.update(part)
    return total.hexdigest()


def digests(outputs: DataFrame) -> DataFrame:
    """`output_sha256` and `restored_sha256` in place of the frames, from frames streamed in order."""
    both = _added(outputs, "both", "string", lambda stored, form: _digest(stored.read(0, stored.total("size"))) + _digest(_rebuilt(stored, form)))
    return both.withColumns({"output_sha256": F.substring("both", 1, 64), "restored_sha256": F.substring("both", 65, 64)}).drop("both")


ORACLE_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
        ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM drawn
), placed AS (
    SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""
