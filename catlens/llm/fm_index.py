"""A compressed FM-index over a sequence of integer symbols (numpy), with vectorised backward search."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank of a symbol in a sequence: one packed bit vector with block counts a bit of the alphabet."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels = max(1, int(symbols.max()).bit_length()) if self.n else 1
        self._words: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._zeros: list[int] = []
        rest = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = ((rest >> level) & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, dtype=bool)
            padded[: self.n] = bit
            word = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(word).astype(np.int64)
            self._words.append(word)
            self._counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self._zeros.append(int(self.n - bit.sum()))
            rest = np.concatenate([rest[~bit], rest[bit]])

    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self._counts[k][block] + np.bitwise_count(self._words[k][block] & mask).astype(np.int64)

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position i."""
        begin, end = np.zeros(len(i), dtype=np.int64), i.astype(np.int64)
        for k in range(self.levels):
            one = ((symbols >> (self.levels - 1 - k)) & 1).astype(bool)
            b, e = self._rank1(k, begin), self._rank1(k, end)
            begin = np.where(one, self._zeros[k] + b, begin - b)
            end = np.where(one, self._zeros[k] + e, end - e)
        return end - begin


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and the ranks of all suffixes by their first `depth` symbols (a power of two).

    Past the end counts as less than every symbol.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    at_depth, h = (rank if depth == 1 else None), 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        if h < n:
            second[:-h] = rank[h:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        changed = np.empty(n, dtype=np.int64)
        changed[0] = 0
        changed[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(changed)
        h *= 2
        if h == depth:
            at_depth = rank
        if rank[order[-1]] == n - 1:
            return order, (at_depth if at_depth is not None else rank)


class FMIndex:
    """FM-index of a text of symbols >= 1, closed by one 0.

    `window` symbols are the threshold of matching statistics: `classes` groups the suffixes whose
    first `window` symbols agree, so a match of more symbols shrinks to `window` symbols by a lookup.
    """

    def __init__(self, symbols: np.ndarray, window: int):
        text = np.concatenate([symbols, [0]]).astype(np.int64)
        depth = 1 << (window.bit_length() - 1)
        self.sa, at_depth = suffix_array(text, depth)
        n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])[:-1]
        self.bwt = WaveletMatrix(text[self.sa - 1])
        later = np.minimum(self.sa + window - depth, n - 1)
        head, tail = at_depth[self.sa], at_depth[later]
        self.classes = np.concatenate([[0], np.cumsum((head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))])
        self.class_first = np.flatnonzero(np.concatenate([[True], self.classes[1:] != self.classes[:-1]]))
        self.class_last = np.concatenate([self.class_first[1:], [n]])

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of the matches [lo, hi) with one more symbol on the left."""
        base = self.first[symbols]
        return base + self.bwt.rank(symbols, lo), base + self.bwt.rank(symbols, hi)

    def search(self, pattern: np.ndarray) -> tuple[int, int]:
        """The suffix interval of one pattern (empty if it doesn't occur)."""
        lo, hi = np.zeros(1, dtype=np.int64), np.array([len(self.sa)])
        for c in pattern[::-1]:
            if lo[0] >= hi[0] or c >= len(self.first):
                return 0, 0
            lo, hi = self.extend(np.array([c]), lo, hi)
        return int(lo[0]), int(hi[0])


def window_classes(index: FMIndex, texts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stream documents through the index from right to left, all in step.

    Document d is texts[ends[d] - lengths[d] : ends[d]]. Returns (document, position in it, class) for every
    position at which at least `window` of its symbols match in the index. Documents shorter than that
    give nothing. A symbol that the index lacks or an empty interval restarts the match left of it.
    """
    docs = np.flatnonzero(lengths >= window)
    n, out = len(index.sa), []
    lo, hi, have = np.zeros(len(docs), np.int64), np.full(len(docs), n), np.zeros(len(docs), np.int64)
    step = 0
    while len(docs):
        c = texts[ends[docs] - 1 - step]
        new_lo, new_hi = index.extend(c, lo, hi)
        dead = new_lo >= new_hi
        if dead.any():
            # the longest match that goes on left of here may start inside the old one: restart by halving it
            new_lo, new_hi, have = _restarted(index, texts, ends[docs] - 1 - step, have, dead, new_lo, new_hi, n)
            have = np.where(dead, have, have + 1)
        else:
            have = have + 1
        lo, hi = new_lo, new_hi
        hit = have >= window
        if hit.any():
            cls = index.classes[lo[hit]]
            out.append((docs[hit], lengths[docs[hit]] - 1 - step, cls))
            lo[hit], hi[hit], have[hit] = index.class_first[cls], index.class_last[cls], window
        step += 1
        going = lengths[docs] > step
        docs, lo, hi, have = docs[going], lo[going], hi[going], have[going]
    if not out:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _restarted(index, texts, at, have, dead, lo, hi, n):
    """For the dead matches: the longest prefix of texts[at : at + have + 1] that occurs, found by backward search."""
    have = have.copy()
    for k in np.flatnonzero(dead):
        low, high, best = 0, int(have[k]), (0, n)  # a prefix of `low` symbols occurs; shorter prefixes of it do too
        while low < high:
            middle = (low + high + 1) // 2
            found = index.search(texts[at[k] : at[k] + middle])
            if found[0] < found[1]:
                low, best = middle, found
            else:
                high = middle - 1
        lo[k], hi[k], have[k] = best[0], best[1], low
    return lo, hi, have
