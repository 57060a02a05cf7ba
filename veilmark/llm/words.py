"""Words and shingles of whole texts as 64-bit hashes, one numpy pass over the bytes of a group of texts.

A word is a run of bytes outside 0x20 and 0x09-0x0D, with A-Z lower-cased. These bytes never occur inside a
multi-byte UTF-8 character, so working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Rows of a batch that are turned into Python objects at once.
SLICE = 256
#: Texts are worked on in groups of about this many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit constants from a seed; the same on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BYTE = constants(256, 1)
_BASE = int(constants(1, 2)[0])
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, GROUP_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 2 * GROUP_BYTES:
            _POWERS[base] = have
    return have[:n]


@dataclass
class Words:
    """Word hashes of a group of texts; text i has the words ``hashes[bounds[i]:bounds[i + 1]]``.

    ``starts`` has the words' places in the texts joined by one byte.
    """

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in short slices, so that a task holds few Python objects whatever the batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def groups(texts: Iterable[bytes | None], limit: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts in groups of about ``limit`` bytes, with the position of the first; null is empty."""
    start, size, group = 0, 0, []
    for i, text in enumerate(texts):
        text = text or b""
        if group and size + len(text) > limit:
            yield start, group
            start, size, group = i, 0, []
        group.append(text)
        size += len(text)
    if group:
        yield start, group


def words(texts: Sequence[bytes]) -> Words:
    """Hash every word of the texts."""
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    edges = np.flatnonzero(np.diff(_SPACE[data].view(np.int8), prepend=1))
    starts, stops = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _powers(_BASE_INVERSE, len(data))[starts]
    hashes = mix(hashes + (stops - starts).astype(np.uint64))
    return Words(hashes, np.concatenate([[0], np.searchsorted(starts, ends)]), starts)


_PLACES = constants(64, 3)


def shingles(found: Words, width: int = 5) -> Words:
    """Hashes of the runs of ``width`` words; a text with fewer words has its whole sequence as one."""
    hashes, bounds, counts = found.hashes, found.bounds, found.counts
    n = len(hashes)
    runs = np.zeros(n, np.uint64)
    span = max(0, n - width + 1)
    for j in range(width):
        runs[:span] += hashes[j : j + span] * _PLACES[j]
    runs = mix(runs)
    inside = np.zeros(n, bool)
    last = np.repeat(bounds[1:], counts)
    inside[: len(last)] = np.arange(n) + width <= last
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        a, b = bounds[i], bounds[i + 1]
        runs[a] = mix((hashes[a:b] * _PLACES[width : width + b - a]).sum(dtype=np.uint64)[None])[0]
        inside[a] = True
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    return Words(runs[inside], np.concatenate([[0], np.cumsum(sizes)]))
