"""Vectorised word hashing over Arrow string columns: whole texts, no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are handled in groups of about this many bytes, which bounds the work arrays.
GROUP_BYTES = 1 << 20
#: Places of a word with a factor of their own; the blocks of places after them have one more each.
_PLACES = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_PLACE = mix(np.arange(1, _PLACES + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
_BYTE = mix(np.arange(256, dtype=U) + U(0x51ED2701))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All of ASCII but letters and digits.
NOT_ALNUM = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its texts; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def groups(at: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield first, last
        first = last


def hashed_words(raw: np.ndarray, at: np.ndarray, lower: bool, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts at ``at``: 64-bit hash, start and end byte of each word, and each text's first word
    (n+1 bounds)."""
    base, end = int(at[0]), int(at[-1])
    b = raw[base:end]
    if lower:
        b = _LOWER[b]
    inside = ~separators[b]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = np.unique(at[:-1] - base)
    cuts = cuts[cuts < len(b)]
    starts[cuts] = inside[cuts]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, U), begin, begin, np.zeros(len(at), np.int64)
    lengths = np.add.reduceat(inside, begin, dtype=np.int64)
    place = np.arange(len(b), dtype=np.int64)[begin[0] :] - np.repeat(begin, np.diff(np.append(begin, len(b))))
    terms = _BYTE[b[begin[0] :]] * _PLACE[place & (_PLACES - 1)]
    if lengths.max() > _PLACES:  # the factors of later places differ by block
        terms *= mix((place >> 16).astype(U) * U(0xD1B54A32D192ED03)) | U(1)
    terms[~inside[begin[0] :]] = 0
    hashes = mix(np.add.reduceat(terms, begin - begin[0], dtype=U) + lengths.astype(U))
    bounds = np.searchsorted(begin, at - base)
    return hashes, begin + base, begin + lengths + base, bounds


def windows(hashes: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of k consecutive words (those that cross texts are the caller's to mask)."""
    if len(hashes) < k:
        return np.zeros(0, U)
    out = np.zeros(len(hashes) - k + 1, U)
    for j in range(k):
        out = out * U(base) + hashes[j : len(hashes) - k + 1 + j]
    return mix(out)
