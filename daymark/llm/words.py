"""Words of whole texts as 64-bit hashes, computed for a slice of texts at a time.

A word is a longest run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A word's
hash is a polynomial over its bytes (modulo 2**64, then mixed), so the hashes of all words of a
slice follow from one running sum over its bytes, without a Python object per word. Two different
words share a hash with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time; a longer text forms a slice of its own, hashed in pieces.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MARKS = _BLANK.copy()
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(factors, dtype=np.uint64)


@dataclass
class Slice:
    """Neighbouring rows of a batch: rows first to first + rows - 1.

    words: the hash of each word in order; tails: the hash of each word's last three bytes;
    bounds: words of row i are bounds[i] to bounds[i + 1] - 1.
    """

    first: int
    rows: int
    words: np.ndarray
    tails: np.ndarray
    bounds: np.ndarray


class Hasher:
    """Hashes words of slices; keeps the powers it has computed so far.

    punctuation: ASCII punctuation ends words, as white space does.
    """

    def __init__(self, tails: bool = False, punctuation: bool = False):
        self.tails = tails
        self.blank = _MARKS if punctuation else _BLANK
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def slices(self, texts: pa.Array) -> Iterator[Slice]:
        """All rows of a binary column, in order; a null text has no words."""
        texts = texts.cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:][: len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, side="right")) - 1
            last = min(max(last, first + 1), len(texts))
            part = data[ends[first]:ends[last]]
            yield self.hashed(first, part, ends[first:last + 1] - ends[first]) if len(part) <= SLICE_BYTES \
                else self.long(first, part)
            first = last

    def long(self, first: int, data: np.ndarray) -> Slice:
        """One text longer than a slice, hashed in pieces that end at blanks; a longer word is one piece."""
        words, tails, at = [], [], 0
        while at < len(data):
            stop = min(at + SLICE_BYTES, len(data))
            while stop < len(data):
                gaps = np.flatnonzero(self.blank[data[at:stop]])
                if len(gaps):
                    stop = at + int(gaps[-1]) + 1
                    break
                stop = min(stop + SLICE_BYTES, len(data))
            part = self.hashed(0, data[at:stop], np.array([0, stop - at]))
            words.append(part.words)
            tails.append(part.tails)
            at = stop
        made = np.concatenate(words)
        return Slice(first, 1, made, np.concatenate(tails) if self.tails else made[:0], np.array([0, len(made)]))

    def hashed(self, first: int, data: np.ndarray, edges: np.ndarray) -> Slice:
        size, rows = len(data), len(edges) - 1
        if size > len(self.up):
            self.up, self.down = _powers(_BASE, size + 1), _powers(_INVERSE, size + 1)
        blank = self.blank[data]
        fresh = np.ones(size + 1, dtype=bool)
        fresh[1:] = blank
        fresh[edges] = True
        filled = ~blank
        starts = np.flatnonzero(filled & fresh[:size])
        over = np.ones(size + 1, dtype=bool)
        over[:size] = blank
        over[edges] = True
        stops = np.flatnonzero(filled & over[1:]) + 1
        with np.errstate(over="ignore"):
            low = _LOWER[data].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(low * self.up[:size], out=sums[1:])
            words = mix((sums[stops] - sums[starts]) * self.down[starts])
            if self.tails:
                late = np.maximum(starts, stops - 3)
                tails = mix((sums[stops] - sums[late]) * self.down[late])
            else:
                tails = words[:0]
        return Slice(first, rows, words, tails, np.searchsorted(starts, edges))


def shingles(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words within a row, and their bounds by row.

    A row of fewer words, but at least one, has one shingle: all its words.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    edges = np.concatenate(([0], np.cumsum(made)))
    row = np.repeat(np.arange(len(counts)), made)
    start = bounds[row] + np.arange(edges[-1]) - edges[row]
    length = np.minimum(counts[row], width)
    padded = np.concatenate((words, np.zeros(width, dtype=np.uint64)))
    with np.errstate(over="ignore"):
        total = np.zeros(len(start), dtype=np.uint64)
        for i in range(width):
            here = np.where(i < length, padded[start + i], np.uint64(i))
            total = total * np.uint64(_BASE) + here
        return mix(total), edges
