"""Word shingles of whole texts as sets of 64-bit hashes, in numpy over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of texts of about CHUNK bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    at = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK, side="right")) - 1)
        yield row, whole[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """All shingles in order and the number of them per text.

    Words lie between blanks and \\t to \\r; A-Z count as a-z. A text of fewer words, but not none, is one shingle.
    """
    n_docs = len(offsets) - 1
    inside = ~_GAP[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[begins] = inside[begins]
    place = np.flatnonzero(inside)
    first = np.searchsorted(place, np.flatnonzero(starts))
    if not len(first):
        return np.zeros(0, dtype=np.uint64), np.zeros(n_docs, dtype=np.int64)
    length = np.diff(np.append(first, len(place)))
    order = np.arange(len(place)) - np.repeat(first, length)
    letters = (_LOWER[data[place]].astype(np.uint64) + np.uint64(1)) * powers(_BASE, int(length.max()))[order]
    words = mix(np.add.reduceat(letters, first) + length.astype(np.uint64))
    per_doc = np.diff(np.searchsorted(place[first], offsets))
    word_at = np.append(0, np.cumsum(per_doc))
    n = np.where(per_doc >= size, per_doc - size + 1, (per_doc > 0).astype(np.int64))
    steps = powers(_STEP, size)
    padded = np.append(words, np.zeros(size, dtype=np.uint64))
    # First words of all shingles, and how many words each has.
    begin = np.repeat(word_at[:-1] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
    width = np.repeat(np.minimum(per_doc, size), n)
    total = np.zeros(len(begin), dtype=np.uint64)
    for k in range(size):
        total += np.where(k < width, padded[begin + k], np.uint64(0)) * steps[k]
    return mix(total + width.astype(np.uint64) * _BASE), n


def shingle_sets(column: pa.Array, size: int = SIZE) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for _, data, offsets in chunks(column):
        hashes, n = shingle_hashes(data, offsets, size)
        at = np.append(0, np.cumsum(n))
        for i in range(len(n)):
            yield np.unique(hashes[at[i] : at[i + 1]])
