"""Hashes of words and word sequences, vectorised over the bytes of one document.

Used inside tasks only. A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), the rule
`bytes.split()` has as well. Hashes are fixed functions of the content: equal on every machine and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

PIECE = 1 << 20  # bytes hashed at once; bounds the working memory for very long documents
_SPACE = frozenset(b" \t\n\v\f\r")
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """`n` fixed 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text in pieces that end at white space, each of `size` bytes or little more unless a run is longer."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[at:end]
        at = end


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte array."""
    inside = np.zeros(len(buffer) + 2, dtype=bool)
    inside[1:-1] = (buffer != 0x20) & (buffer - np.uint8(9) > 4)  # 0x09-0x0D become 0-4, smaller bytes wrap
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word, in order: XXH3 of its bytes, by one rule for words of any length."""
    parts = []
    for piece in pieces(data):
        words = piece.split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def sequence_hashes(hashes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """One hash per run of `n` consecutive items; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    factors = numbers(seed, n) | np.uint64(1)
    total = hashes[:count] * factors[0]
    for k in range(1, n):
        total += hashes[k : k + count] * factors[k]
    return mix(total)
