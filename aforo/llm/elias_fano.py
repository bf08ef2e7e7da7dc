"""Elias-Fano sequences and a two-level n-gram trie of them, read from a memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

ONE = np.uint64(1)


def _bits(positions: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(length // 64 + 2, np.uint64)
    np.bitwise_or.at(out, positions >> 6, ONE << (positions & 63).astype(np.uint64))
    return out


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit; ``before`` counts the set bits before each word."""
    word = np.searchsorted(before, k, "right") - 1
    left, rest, at = words[word], (k - before[word]).astype(np.int64), word * 64
    for width in (32, 16, 8, 4, 2, 1):
        low = left & np.uint64((1 << width) - 1)
        count = np.bitwise_count(low).astype(np.int64)
        over = rest >= count
        rest -= np.where(over, count, 0)
        at += np.where(over, width, 0)
        left = np.where(over, left >> np.uint64(width), low)
    return at


class File:
    """Arrays written one after the other to a temporary file, which goes when it is closed, and mapped from it."""

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()

    def put(self, array: np.ndarray) -> np.ndarray:
        at = (self.file.seek(0, 2) + 63) // 64 * 64
        self.file.seek(at)
        self.file.write(np.ascontiguousarray(array).tobytes() or b"\0" * 8)
        self.file.flush()
        return np.memmap(self.file, array.dtype, "r", at, (len(array),)) if len(array) else array


class Monotone:
    """A sorted sequence: the lower bits of each value packed, the upper bits as a unary bit vector."""

    def __init__(self, values: np.ndarray, universe: int, file: File):
        self.n = n = len(values)
        self.low = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        low = np.uint64(self.low)
        tail, at = values & ((ONE << low) - ONE), np.arange(n, dtype=np.int64) * self.low
        packed = np.zeros(n * self.low // 64 + 2, np.uint64)
        shift = (at & 63).astype(np.uint64)
        np.bitwise_or.at(packed, at >> 6, tail << shift)
        over = np.flatnonzero((at & 63) + self.low > 64)
        np.bitwise_or.at(packed, (at[over] >> 6) + 1, tail[over] >> (np.uint64(64) - shift[over]))
        head = (values >> low).astype(np.int64)
        self.last = int(head[-1]) if n else -1
        ones = _bits(head + np.arange(n), n + self.last + 2)
        counts = np.bitwise_count(ones).astype(np.int64)
        self.packed, self.ones = file.put(packed), file.put(ones)
        before = np.r_[0, np.cumsum(counts)[:-1]]
        self.ones_before = file.put(before)
        self.zeros_before = file.put(np.arange(len(ones)) * 64 - before)

    def lower(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.packed[word] >> shift
        more = self.packed[word + 1] << ((np.uint64(64) - shift) & np.uint64(63))
        value |= np.where(shift > 0, more, np.uint64(0))
        return value & ((ONE << np.uint64(self.low)) - ONE)

    def get(self, i: np.ndarray) -> np.ndarray:
        head = (_select(self.ones, self.ones_before, i) - i).astype(np.uint64)
        return (head << np.uint64(self.low)) | self.lower(i)

    def _first(self, head: np.ndarray) -> np.ndarray:
        """Number of values whose upper bits are below ``head``."""
        out = np.zeros(len(head), np.int64)
        inner = np.flatnonzero((head > 0) & (head <= self.last))
        zeros = head[inner] - 1
        out[inner] = _select(~self.ones, self.zeros_before, zeros) - zeros
        out[head > self.last] = self.n
        return out

    def find(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each value, or -1; ``begin`` and ``end`` bound where it may be."""
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        head = (values >> np.uint64(self.low)).astype(np.int64)
        tail = values & ((ONE << np.uint64(self.low)) - ONE)
        at, stop = self._first(head), self._first(head + 1)
        if begin is not None:
            at, stop = np.maximum(at, begin), np.minimum(stop, end)
        # Values with equal upper bits are sorted by the lower ones. Many share them where a context has many successors.
        open_ = np.flatnonzero(at < stop)
        left, right, sought = at[open_], stop[open_], tail[open_]
        searched = np.arange(len(open_))
        while len(searched):
            middle = (left[searched] + right[searched]) >> 1
            less = self.lower(middle) < sought[searched]
            left[searched[less]] = middle[less] + 1
            right[searched[~less]] = middle[~less]
            searched = searched[left[searched] < right[searched]]
        inside = np.flatnonzero(left < stop[open_])
        same = inside[self.lower(left[inside]) == sought[inside]]
        out[open_[same]] = left[same]
        return out


class Trie:
    """Contexts, the range of successors of each, and the successors, whose values count on from context to context.

    Keys hold a context in the upper and a successor in the lower 32 bits and are sorted and distinct.
    """

    def __init__(self, keys: np.ndarray, codes: np.ndarray):
        self.file = File()
        contexts, first = np.unique(keys >> np.uint64(32), return_index=True)
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(np.r_[first, len(keys)]))
        relative = (rank << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        self.contexts = Monotone(contexts, 1 << 32, self.file)
        self.pointers = Monotone(np.r_[first, len(keys)].astype(np.uint64), len(keys) + 1, self.file)
        self.successors = Monotone(relative, max(1, len(contexts)) << 32, self.file)
        self.codes = self.file.put(codes)

    def codes_of(self, keys: np.ndarray) -> np.ndarray:
        """The code of each key, 0 where the trie lacks it."""
        out = np.zeros(len(keys), np.uint16)
        context = self.contexts.find(keys >> np.uint64(32))
        known = np.flatnonzero(context >= 0)
        context = context[known]
        if len(known):
            begin = self.pointers.get(context).astype(np.int64)
            end = self.pointers.get(context + 1).astype(np.int64)
            sought = (context.astype(np.uint64) << np.uint64(32)) | (keys[known] & np.uint64(0xFFFFFFFF))
            place = self.successors.find(sought, begin, end)
            out[known[place >= 0]] = self.codes[place[place >= 0]]
        return out
