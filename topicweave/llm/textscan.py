"""Vectorised scanning of Arrow string batches: words, hashes, byte classes.

A batch's texts lie in one contiguous UTF-8 buffer, so words are found and
hashed for all of its documents at once.  Work goes through the buffer in
segments, which bounds the temporaries however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19  # bytes hashed at a time (a longer word makes one longer segment)

_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SHINGLE_CODE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

IS_WHITE = np.zeros(256, bool)
IS_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    key = str(int(base))
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        have = np.full(max(n, SEGMENT + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * SEGMENT:
            _POWERS[key] = have
    return have[:n]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and each text's bounds."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]] if len(offs) else raw, offs - offs[0]


def chunked(batches, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices(texts: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each (one row at least)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offs = buffer_of(texts)
    n, at = len(offs) - 1, 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every white-space separated word, and for each
    text the bounds of its words in those arrays."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~IS_WHITE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + SEGMENT, "right")))
        hi = int(ends[to - 1])
        pw = powers(hi - lo)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(BYTE_CODE[buf[lo:hi]] * pw, out=run[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (run[e] - run[s]) * powers(hi - lo, BASE_INVERSE)[s]
        at = to
    return mix(out)


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the k-word windows inside each text: (hash, first word, text)."""
    n = len(hashes) - k + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    h = hashes[:n] * SHINGLE_CODE[0]
    for j in range(1, k):
        h += hashes[j : n + j] * SHINGLE_CODE[j]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ok = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(h[ok]), ok, doc[ok]
