"""Whole texts as arrays: bytes of an Arrow column, word hashes, shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[np.uint64, np.ndarray] = {}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES + 1024), base, dtype=np.uint64)
        known[0] = 1
        _POWERS[base] = known = np.multiply.accumulate(known)
    return known[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, a longer row by itself."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lowered, split at blanks) and the word offsets of the rows.

    Long input is hashed slice by slice, cut between words, so that the work
    arrays stay small whatever a text's length.
    """
    hashes, first = [], []
    at = 0
    while at < len(flat):
        end = min(len(flat), at + CHUNK_BYTES)
        while end < len(flat) and not _BLANK[flat[end]]:  # cut before a blank
            stop = min(len(flat), end + 4096)
            blanks = np.flatnonzero(_BLANK[flat[end:stop]])
            end = end + int(blanks[0]) if len(blanks) else stop
        piece = _LOWER[flat[at:end]]
        solid = ~_BLANK[piece]
        edge = np.zeros(len(piece) + 1, dtype=bool)
        inside = offsets[(offsets >= at) & (offsets <= end)] - at
        edge[inside] = True
        starts = solid.copy()
        starts[1:] &= ~solid[:-1] | edge[1:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(piece)), out=sums[1:])
        raw = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(piece) + 1)[starts]
        hashes.append(mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        first.append(starts + at)
        at = end
    starts = np.concatenate(first) if first else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.searchsorted(starts, offsets, "left")


_PLACES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of the whole sequence if it is shorter; empty without words."""
    n = len(words)
    if not n:
        return words
    width = min(SHINGLE, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * _PLACES[k]
        total ^= total >> np.uint64(29)
    return np.unique(mix(total))


def shingle_sets(flat: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    words, at = word_hashes(flat, offsets)
    return [shingle_set(words[at[i] : at[i + 1]]) for i in range(len(offsets) - 1)]
