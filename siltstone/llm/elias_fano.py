"""Elias-Fano sequences and the two-level n-gram trie made of them, as flat byte strings.

A trie is one ``bytes`` value whose arrays are read in place, so it can be kept
in a table's binary column, or in a file and memory-mapped.
"""

from __future__ import annotations

import struct

import numpy as np

_HEADER = struct.Struct("<qqqq")


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence: low bits packed, high bits in unary."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, int(np.floor(np.log2((top + 1) / n)))) if n and top >= n else 0
    values = values.astype(np.uint64)
    if low_bits:
        wanted = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(wanted.astype(np.uint8).ravel(), bitorder="little").tobytes()
    else:
        low = b""
    high = np.zeros(n + (top >> low_bits) + 1, dtype=np.uint8)
    high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
    packed = np.packbits(high, bitorder="little").tobytes()
    return _HEADER.pack(n, low_bits, len(low), len(packed)) + low + packed


class Sequence:
    """Random access to an encoded sequence; ``buffer`` may be a memory map."""

    def __init__(self, buffer: bytes | memoryview):
        self.n, self.low_bits, low, high = _HEADER.unpack_from(buffer)
        at = _HEADER.size
        # Eight bytes of slack let every low part be read as one word.
        self.low = np.frombuffer(bytes(memoryview(buffer)[at : at + low]) + bytes(8), np.uint8)
        self.high = np.frombuffer(buffer, np.uint8, high, at + low)
        self.size = at + low + high
        # Select: the number of ones before every byte.
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        at = np.asarray(at, dtype=np.int64)
        byte = np.searchsorted(self.before, at, "right") - 1
        found = _SELECT[self.high[byte], at - self.before[byte]] + 8 * byte - at
        if not self.low_bits:
            return found
        bit = at * self.low_bits
        words = np.lib.stride_tricks.sliding_window_view(self.low, 8)[bit >> 3].copy().view("<u8").ravel()
        low = (words >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)
        return (found << self.low_bits) | low.astype(np.int64)

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = ones - np.arange(self.n)
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (high << self.low_bits) | low


def _select_table() -> np.ndarray:
    table = np.zeros((256, 8), dtype=np.int64)
    for byte in range(256):
        ones = [i for i in range(8) if byte >> i & 1]
        table[byte, : len(ones)] = ones
    return table


_SELECT = _select_table()

QUANTA = 65535
LOWEST = -16.0


def quantised(log10: np.ndarray) -> np.ndarray:
    """Base-10 logarithms from ``LOWEST`` to 0 as 16-bit codes."""
    return np.rint(np.clip(log10 / LOWEST, 0, 1) * QUANTA).astype("<u2")


def restored(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (LOWEST / QUANTA)


class Trie:
    """Contexts and their successors, with quantised probabilities and back-off weights.

    Level one holds the sorted contexts and, as a monotone sequence, where the
    successors of each begin.  Level two holds the successors of all contexts in
    one monotone sequence: to each is added what the sequence had reached before
    its context, so a successor is searched relative to its own context.
    """

    def __init__(self, buffer: bytes | memoryview):
        self.contexts = Sequence(buffer)
        at = self.contexts.size
        parts = []
        for _ in range(3):
            parts.append(Sequence(memoryview(buffer)[at:]))
            at += parts[-1].size
        self.pointers, self.bases, self.successors = parts
        self.backoff = np.frombuffer(buffer, "<u2", len(self.contexts), at)
        self.code = np.frombuffer(buffer, "<u2", len(self.successors), at + 2 * len(self.contexts))

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, log10: np.ndarray, contexts: np.ndarray, backoff: np.ndarray) -> bytes:
        """From successors sorted by (context, word) and the sorted distinct ``contexts``, some of which may have none."""
        first = np.searchsorted(context, contexts, "left")
        end = np.searchsorted(context, contexts, "right")
        span = np.zeros(len(contexts), np.int64)
        some = np.flatnonzero(end > first)
        span[some] = word[end[some] - 1].astype(np.int64) + 1
        bases = np.cumsum(span) - span
        at = np.searchsorted(contexts, context)
        return b"".join([
            encode(contexts), encode(np.append(first, len(context))), encode(bases),
            encode(bases[at] + word.astype(np.int64)), quantised(backoff).tobytes(), quantised(log10).tobytes(),
        ])

    def codes(self, context: np.ndarray, word: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """Code of the log probability of every ``word`` after its ``context``; ``unigram`` is the code of its own one, for backing off.

        A context's place gives its range of successors and what their values
        are relative to; the successor is then searched in the one sequence.
        Codes add up like the logarithms they stand for.
        """
        unigram = unigram.astype(np.int64)
        if not len(self.contexts):
            return unigram
        known = self.contexts.decode()
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        seen = known[at] == context
        at = np.where(seen, at, 0)
        pointers, bases = self.pointers.decode(), self.bases.decode()
        wanted = bases[at] + word
        successors = self.successors.decode()
        place = np.minimum(np.searchsorted(successors, wanted), max(0, len(successors) - 1))
        found = seen & (place >= pointers[at]) & (place < pointers[at + 1])
        if len(successors):
            found &= successors[place] == wanted
        backed = np.where(seen, self.backoff[at].astype(np.int64), 0) + unigram
        if not len(self.successors):
            return backed
        return np.where(found, self.code[place].astype(np.int64), backed)

    def log10(self, context: np.ndarray, word: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """The log probabilities themselves, those of the words alone being given as such."""
        return restored(self.codes(context, word, quantised(unigram)))
