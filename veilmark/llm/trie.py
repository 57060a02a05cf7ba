"""Elias-Fano bigram trie: unigram level, monotone pointers, successors, and quantised log10 probabilities.

A word is its rank among the sorted hashes of the vocabulary.  The successors of context c are kept as c * V + w, one
monotone sequence over the whole level, and the pointers say where each context's successors begin.  Both are
Elias-Fano coded: 16 low bits per element, the rest as gaps in a bit vector.  All parts lie behind each other in one
buffer, so a file of it can be mapped into memory and read in place.
"""

from __future__ import annotations

import io

import numpy as np

LOW_BITS = 16
_MAGIC = b"EFTRIE1\0"


class EliasFano:
    """A monotone sequence of integers, read in place."""

    def __init__(self, low: np.ndarray, bits: np.ndarray):
        self.low, self.bits = low, bits
        # Ones before each 64-bit word of the gaps: the directory for both kinds of select.
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
        self.zeros = np.arange(len(bits) + 1, dtype=np.int64) * 64 - self.ones

    @staticmethod
    def parts(values: np.ndarray, universe: int) -> tuple[np.ndarray, np.ndarray]:
        """Low and gap parts of sorted values below ``universe``."""
        values = values.astype(np.int64)
        places = (values >> LOW_BITS) + np.arange(len(values))
        length = len(values) + (universe >> LOW_BITS) + 1
        bits = np.zeros(-(-length // 64) * 64, np.uint8)
        bits[places] = 1
        return (values & ((1 << LOW_BITS) - 1)).astype(np.uint16), np.packbits(bits, bitorder="little").view(np.uint64)

    def _select(self, numbers: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        """Places of the bits with these numbers (from 0), among ones or, with ``flip``, among zeros."""
        word = np.searchsorted(directory, numbers, side="right") - 1
        left = (numbers - directory[word]).astype(np.uint64)
        bits = self.bits[word]
        bits = ~bits if flip else bits
        place = np.zeros(len(numbers), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            lower = bits & np.uint64((1 << width) - 1)
            count = np.bitwise_count(lower).astype(np.uint64)
            above = left >= count
            left = left - np.where(above, count, np.uint64(0))
            bits = np.where(above, bits >> np.uint64(width), lower)
            place = place + np.where(above, np.uint64(width), np.uint64(0))
        return word * 64 + place.astype(np.int64)

    def get(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        high = self._select(index, self.ones, False) - index
        return (high << LOW_BITS) | self.low[index].astype(np.int64)

    def find(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each value inside its range ``begin:end``, or -1."""
        high = values >> LOW_BITS
        low = (values & ((1 << LOW_BITS) - 1)).astype(np.uint16)
        after = self._select(high, self.zeros, True) - high
        first = np.where(high > 0, self._select(np.maximum(high, 1) - 1, self.zeros, True) - high + 1, 0)
        at, stop = np.maximum(first, begin), np.minimum(after, end)
        # Elements with the same high part are sorted by their low one: halve all ranges at once.
        below, above = at.copy(), stop.copy()
        open_ = np.flatnonzero(below < above)
        while len(open_):
            middle = (below[open_] + above[open_]) >> 1
            less = self.low[middle] < low[open_]
            below[open_[less]] = middle[less] + 1
            above[open_[~less]] = middle[~less]
            open_ = open_[below[open_] < above[open_]]
        inside = np.flatnonzero(below < stop)
        hit = inside[self.low[below[inside]] == low[inside]]
        found = np.full(len(values), -1, np.int64)
        found[hit] = below[hit]
        return found


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of one byte and the values they stand for: means of 256 equal steps between least and largest."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(256)
    low, high = float(values.min()), float(values.max())
    step = (high - low) / 255 or 1.0
    return np.rint((values - low) / step).astype(np.uint8), low + step * np.arange(256)


class Level:
    """The last level alone, over some pairs ``context * V + word``, with one value quantised to a byte for each."""

    def __init__(self, size: int, pairs: np.ndarray, values: np.ndarray):
        self.successors = EliasFano(*EliasFano.parts(pairs, max(size, 1) ** 2))
        self.codes, self.book = _quantised(values)

    def values(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs' values, and whether they are here."""
        if not len(self.codes):
            return np.zeros(len(pairs)), np.zeros(len(pairs), bool)
        begin = np.zeros(len(pairs), np.int64)
        place = self.successors.find(pairs, begin, begin + len(self.codes))
        return self.book[self.codes[place]], place >= 0


class Trie:
    """Reads a buffer made by :func:`build`."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        if bytes(view[:8]) != _MAGIC:
            raise ValueError("not a trie")
        n = int(np.frombuffer(view, np.int64, 1, 8)[0])
        table = np.frombuffer(view, np.int64, 3 * n, 16).reshape(n, 3)
        types = (np.uint8, np.uint16, np.uint64, np.int64, np.float64)
        arrays = [np.frombuffer(view, types[kind], size, at) for kind, size, at in table.tolist()]
        self.hashes, self.counts, self.totals, codes, backoff, levels, *rest = arrays
        self.pointers, self.successors = EliasFano(rest[0], rest[1]), EliasFano(rest[2], rest[3])
        self.codes = rest[4]
        #: Contexts all of whose successors are here.
        self.complete = rest[5].view(bool)
        books = levels.reshape(3, 256)
        self.unigram, self.backoff = books[0][codes], books[1][backoff]
        self.book = books[2]
        self.begin = self.pointers.get(np.arange(len(self.hashes) + 1))

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Ranks of word hashes, -1 outside the vocabulary."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, place, -1)

    def bigrams(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ranks (-1 allowed): log10 of the probability after the context, and whether the trie has the pair."""
        found = np.full(len(word), -1, np.int64)
        known = np.flatnonzero((context >= 0) & (word >= 0))
        if len(known) and len(self.codes):
            begin, end = self.begin[context[known]], self.begin[context[known] + 1]
            some = begin < end
            known, begin, end = known[some], begin[some], end[some]
            found[known] = self.successors.find(context[known] * len(self.hashes) + word[known], begin, end)
        return self.book[self.codes[found]] if len(self.codes) else np.zeros(len(word)), found >= 0


DISCOUNT = 0.75


def build(hashes, counts, total: int, distinct: int, pairs: np.ndarray, times: np.ndarray, successors=None) -> bytes:
    """The buffer of a model: sorted word hashes with counts, sorted pairs ``context * V + word`` with counts.

    ``successors`` is the number of different words after each context, also of those that are not among the pairs; by
    default there are no others.  Pairs are discounted; what that leaves goes to all words by their add-one unigram
    probability, so the probabilities after a context add up to one.
    """
    size = len(hashes)
    unigram = (counts + 1.0) / (total + distinct + 1.0)
    context, word = pairs // max(size, 1), pairs % max(size, 1)
    here = np.bincount(context, minlength=size)
    successors = here if successors is None else successors
    left = DISCOUNT * successors / counts
    seen = (times - DISCOUNT) / counts[context] + left[context] * unigram[word]
    backoff = np.log10(left, where=left > 0, out=np.zeros(size))
    codes, levels = zip(*(_quantised(x) for x in (np.log10(unigram), backoff, np.log10(seen))), strict=True)
    pointers = np.searchsorted(context, np.arange(size + 1))
    arrays = [
        np.asarray(hashes, np.uint64),
        np.asarray(counts, np.int64),
        np.array([total, distinct], np.int64),
        codes[0],
        codes[1],
        np.concatenate(levels),
        *EliasFano.parts(pointers, len(pairs) + 1),
        *EliasFano.parts(pairs, max(size, 1) ** 2),
        codes[2],
        (here == successors).astype(np.uint8),
    ]
    types = (np.uint8, np.uint16, np.uint64, np.int64, np.float64)
    at, table, out = 16 + 24 * len(arrays), [], io.BytesIO()
    for array in arrays:
        at += -at % 64
        table.append((types.index(array.dtype.type), len(array), at))
        at += array.nbytes
    out.write(_MAGIC + np.array([len(arrays)], np.int64).tobytes() + np.array(table, np.int64).tobytes())
    for array, (_, _, place) in zip(arrays, table, strict=True):
        out.write(b"\0" * (place - out.tell()) + array.tobytes())
    return out.getvalue()
