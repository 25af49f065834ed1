"""Words and shingles of texts as 64-bit hashes, computed in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text hashed at a time: bounds a task's memory, changes no result.
CHUNK_BYTES = 1 << 20
_WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        # The published splitmix64 constants.
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seed(*numbers: int) -> np.uint64:
    """One 64-bit number drawn from several small ones."""
    out = np.zeros(1, dtype=np.uint64)
    for n in numbers:
        out = mix(out ^ np.uint64(n & 0xFFFFFFFFFFFFFFFF))
    return out[0]


def _inverse(odd: int) -> int:
    """The inverse of an odd number modulo 2**64."""
    return pow(odd, -1, 1 << 64)


_BASE = int(seed(101)) | 1


def _byte_values() -> np.ndarray:
    """A random number per byte; A-Z share those of a-z."""
    values = mix(np.arange(256, dtype=np.uint64) ^ seed(102))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def word_hashes(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` (UTF-8 bytes) and, for each document, where
    its words begin in that list (one more entry than documents).

    A word is a longest run of bytes other than space and 0x09-0x0D; A-Z equal
    a-z. Documents begin at ``doc_starts``; no word spans two of them.
    """
    white = np.zeros(256, dtype=bool)
    white[list(_WHITE)] = True
    inside = ~white[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    inner = doc_starts[doc_starts < len(data)]
    first[inner] = inside[inner]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    with np.errstate(over="ignore"):
        powers = np.full(len(data) + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        back = np.full(len(data) + 1, _inverse(_BASE), dtype=np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[data] * powers[:-1], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.append(np.searchsorted(starts, doc_starts), len(starts))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    out = words[: len(words) - n + 1]
    for k in range(1, n):
        out = mix(out + np.uint64(k)) ^ words[k : len(words) - n + 1 + k]
    return mix(out)


def shingle_set(words: np.ndarray, n: int, shingles: np.ndarray | None = None) -> np.ndarray:
    """Distinct shingles of ``n`` words, sorted. Fewer words: the whole run as the
    only one. No words: none."""
    if len(words) == 0:
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return mix(shingle_hashes(words, len(words)) ^ seed(103, len(words)))
    return np.unique(shingle_hashes(words, n) if shingles is None else shingles)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """``shingle_set`` of each text, in order; a null text is empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        to = min(to, len(texts))
        part = data[offsets[at] : offsets[to]]
        words, begins = word_hashes(part, offsets[at:to] - offsets[at])
        shingles = shingle_hashes(words, n)
        for k in range(to - at):
            a, b = begins[k], begins[k + 1]
            yield shingle_set(words[a:b], n, shingles[a : b - n + 1] if b - a >= n else None)
        at = to
