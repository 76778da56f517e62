"""Words and shingles of many texts at once, as numpy arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
LONGEST = 64
_LETTERS = np.arange(256, dtype=np.uint8)
LOWER = np.where((_LETTERS >= 65) & (_LETTERS <= 90), _LETTERS + 32, _LETTERS).astype(np.uint8)
WHITE = (_LETTERS == 32) | ((_LETTERS >= 9) & (_LETTERS <= 13))
FNV = np.uint64(1099511628211)
BASIS = np.uint64(14695981039346656037)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word (lower-case A-Z, cut at ASCII white space), and its start and end among the bytes.

    Words never span two texts; texts are data[offsets[i]:offsets[i + 1]].
    """
    low = LOWER[data]
    ink = ~WHITE[low]
    begins = np.ones(len(ink), bool)
    begins[1:] = ~ink[:-1]
    begins[offsets[:-1][offsets[:-1] < len(ink)]] = True
    begins &= ink
    ends = np.ones(len(ink), bool)
    ends[:-1] = ~ink[1:]
    ends[offsets[1:][offsets[1:] > 0] - 1] = True
    ends &= ink
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return hashed(low, start, end), start, end


def hashed(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes."""
    length = np.minimum(end - start, LONGEST + 1).astype(np.uint8)
    order = np.argsort(LONGEST + 1 - length, kind="stable")
    at = start[order]
    count = len(at) - np.concatenate([[0], np.cumsum(np.bincount(length, minlength=LONGEST + 2))])
    h = np.full(len(at), BASIS)
    for j in range(LONGEST):
        m = count[j + 1]
        if not m:
            break
        h[:m] ^= low[at[:m] + j]
        h[:m] *= FNV
    for row in range(count[LONGEST + 1]):
        i = order[row]
        h[row] = xxhash.xxh3_64_intdigest(low[start[i]:end[i]].tobytes())
    out = np.empty_like(h)
    out[order] = mixed(h)
    return out


def by_text(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Word number at which each text begins, and the number of all words."""
    return np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """Distinct hashes, sorted, of all runs of `width` words of each text; a shorter text is one run, an empty one none."""
    count = max(0, len(hashes) - width + 1)
    runs = hashes[:count].copy()
    for k in range(1, width):
        runs *= STEP
        runs += hashes[k:k + count]
    runs = mixed(runs)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(runs[a:b - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            value = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in hashes[a:b]:
                    value = value * STEP + h
            own = mixed(np.array([value]))
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
    return out


class Lookup:
    """Positions of 64-bit keys, found for whole arrays: an open-addressing table over distinct keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, (len(keys) * 7 // 5).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.full(1 << self.bits, -1, np.int32)
        rows = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(rows):
            free = np.flatnonzero(self.at[slot] < 0)
            self.at[slot[free]] = rows[free]
            here = self.at[slot] == rows
            self.keys[slot[here]] = keys[rows[here]]
            rows, slot = rows[~here], (slot[~here] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is absent."""
        slot = self._slot(keys)
        out = self.at[slot]
        wrong = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[wrong]
        while len(wrong):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            now = self.at[slot]
            out[wrong] = now
            on = (now >= 0) & (self.keys[slot] != keys[wrong])
            wrong, slot = wrong[on], slot[on]
        return out


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their total counts."""
    if counts is None:
        keys = np.sort(keys)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[new], np.diff(np.concatenate([new, [len(keys)]]))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts
