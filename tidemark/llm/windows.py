"""Windows of fixed length over symbol sequences: Rabin-Karp hashes and shared anchors.

A window of ``width`` symbols holds ``width - gram + 1`` grams of ``gram`` symbols; the gram with
the smallest mixed hash, the leftmost among equals, is its anchor. Equal windows have the same
anchor at the same offset, so repeated windows can only be found among anchors whose grams
repeat. Consecutive windows share an anchor, and one row stands for such a run of windows. The
hash of all symbols that a run covers tells whether two runs are equal as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Symbols worked on at a time; longer documents are cut into stretches that overlap by a window.
STRETCH = 1 << 18
_PLACE_BITS = np.uint64(22)

_PLACE_MASK = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look random."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_1
    values ^= values >> np.uint64(27)
    values *= _MIX_2
    values ^= values >> np.uint64(31)
    return values


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def as_symbols(values: np.ndarray) -> np.ndarray:
    """Bytes become 64-bit symbols; other sequences are symbols already."""
    return _BYTES[values] if values.dtype == np.uint8 else values


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


class RangeHash:
    """Rabin-Karp hashes of any ranges of a sequence, from one pass of prefix sums."""

    def __init__(self, symbols: np.ndarray):
        n = 1 << max(19, int(len(symbols)).bit_length())
        forward, self.inverse = _powers(n)
        self.prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * forward[: len(symbols)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return (self.prefix[starts + lengths] - self.prefix[starts]) * self.inverse[starts]

    def every(self, length: int) -> np.ndarray:
        """The hash of every range of a length, by start."""
        count = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:count]) * self.inverse[:count]


@dataclass
class Runs:
    """Runs of windows that share an anchor; ``doc`` is the position of the document given."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    gram: np.ndarray
    whole: np.ndarray

    def __len__(self) -> int:
        return len(self.doc)


def _smallest(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive keys."""
    reach = 1
    while reach * 2 <= span:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    if reach < span:
        keys = np.minimum(keys[: len(keys) - (span - reach)], keys[span - reach :])
    return keys


def stretches(lengths: np.ndarray, width: int) -> list[list[tuple[int, int, int]]]:
    """Documents packed to stretches of about ``STRETCH`` symbols, as (document, from, to).

    Every window of every document starts in exactly one of the pieces.
    """
    packs: list[list[tuple[int, int, int]]] = []
    pack: list[tuple[int, int, int]] = []
    size = 0
    for doc, n in enumerate(lengths.tolist()):
        at = 0
        while n - at >= width:
            to = min(n, at + STRETCH + width - 1)
            pack.append((doc, at, to))
            size += to - at
            at = to - width + 1
            if size >= STRETCH:
                packs.append(pack)
                pack, size = [], 0
    return [*packs, pack] if pack else packs


def _starts(pieces: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of packed pieces with (length): piece and packed position of every window's start."""
    counts = pieces - width + 1
    offsets = np.cumsum(pieces) - pieces
    piece = np.repeat(np.arange(len(pieces)), counts)
    first = np.cumsum(counts) - counts
    return piece, np.arange(len(piece)) - first[piece] + offsets[piece], offsets


def find_runs(symbols: list[np.ndarray], width: int, gram: int) -> Runs:
    """All runs of the given documents, each a sequence of 64-bit symbols or of bytes."""
    lengths = np.array([len(s) for s in symbols], np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    for pack in stretches(lengths, width):
        packed = as_symbols(np.concatenate([symbols[d][a:b] for d, a, b in pack]))
        docs, froms = np.array([p[0] for p in pack]), np.array([p[1] for p in pack])
        ranges = RangeHash(packed)
        keys = (mixed(ranges.every(gram)) & ~_PLACE_MASK) | np.arange(len(packed) - gram + 1, dtype=np.uint64)
        least = _smallest(keys, width - gram + 1)
        piece, at, offsets = _starts(np.array([b - a for _, a, b in pack]), width)
        anchor = (least[at] & _PLACE_MASK).astype(np.int64)
        # Windows of different pieces never share an anchor, as none crosses a boundary.
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(first, len(anchor)))
        start = at[first]
        whole = mixed(ranges(start, count + (width - 1)) + count.astype(np.uint64))
        grams = mixed(ranges(anchor[first], gram))
        where = piece[first]
        found.append((docs[where], start - offsets[where] + froms[where], count, grams, whole))
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Runs(*(np.concatenate(column) for column in zip(*found, strict=True)))


def window_hashes(symbols: np.ndarray, starts: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of every window of the given runs of one document."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lead = np.cumsum(counts) - counts
    at = np.repeat(starts - lead, counts) + np.arange(int(counts.sum()))
    out = np.empty(len(at), np.uint64)
    step = max(1, STRETCH)
    order = np.argsort(at, kind="stable")
    for low in range(0, len(symbols), step):
        i, j = np.searchsorted(at[order], [low, low + step])
        if i < j:
            own = order[i:j]
            ranges = RangeHash(as_symbols(symbols[low : low + step + width - 1]))
            out[own] = mixed(ranges(at[own] - low, width))
    return at, out


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` symbols lie in one of the intervals."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change[:n]) > 0
