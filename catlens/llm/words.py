"""Vectorised words and shingles over Arrow text buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (the contract's
``[^\\x20\\x09-\\x0D]+``). Words are hashed to 64 bits by a polynomial over their bytes,
so a text is never split into Python strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (vectorised)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=U))[0])


_BYTE = mix(np.arange(1, 257, dtype=U)) | U(1)
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE_LOWER = _BYTE[_FOLD]


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(18, (n - 1).bit_length())
        p = np.full(size, U(_BASE if kind == "up" else _INVERSE), dtype=U)
        p[0] = U(1)
        have = np.multiply.accumulate(p)
        if size <= 1 << 22:  # powers for a huge text aren't kept
            _POWERS[kind] = have
    return have


#: White space and ASCII punctuation: a text's bare words.
BARE = _SPACE.copy()
BARE[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True

#: Marks that `coded_pieces` takes off the end of a word.
MARKS = ",.;:!?"
_LETTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[list(MARKS.encode())] = True


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row numbers of all words of the texts data[offsets[i]:offsets[i+1]]; `between` marks the bytes between words."""
    n = len(data)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    black = ~between[data]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:], after[:-1] = black[:-1], black[1:]
    before[full] = False
    after[ends] = False
    starts = np.flatnonzero(black & ~before)
    stops = np.flatnonzero(black & ~after) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words; with lower, A-Z count as a-z."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, dtype=U)
    total = np.empty(n + 1, dtype=U)
    total[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * _powers("up", n)[:n], out=total[1:])
    h = (total[ends] - total[starts]) * _powers("down", n + 1)[starts]
    return mix(h + (ends - starts).astype(U))


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of all runs of `size` words, in text order.

    A row with 1 to size - 1 words gives one shingle of all its words; a row without words none.
    """
    if not len(hashes):
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    factors = [U(mix_int(j + 1) | 1) for j in range(size)]
    n = len(hashes)
    m = n - size + 1
    if m > 0:
        h = hashes[:m] * factors[0]
        for j in range(1, size):
            h += hashes[j : j + m] * factors[j]
        same = rows[:m] == rows[size - 1 :]
        h, r = mix(h[same]), rows[:m][same]
    else:
        h, r = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    counts = np.bincount(rows, minlength=n_rows)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.zeros(len(short), dtype=U)
        for j in range(size - 1):
            has = counts[short] > j
            extra[has] += hashes[first[has] + j] * factors[j]
        extra = mix(extra + counts[short].astype(U) * U(0xA24BAED4963EE407))
        h, r = np.concatenate([h, extra]), np.concatenate([r, short])
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def split_rows(values: np.ndarray, rows: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """values of each row number 0 .. n_rows - 1; rows ascends."""
    cuts = np.searchsorted(rows, np.arange(n_rows + 1))
    return [values[cuts[i] : cuts[i + 1]] for i in range(n_rows)]


def coded_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of the texts (with lower, A-Z as a-z), and the number and text of each word in order."""
    starts, stops, rows = words(data, offsets)
    black = data[~_SPACE[data]]
    if lower:
        black = _FOLD.astype(np.uint8)[black]
    return *_coded(black, stops - starts), rows


def coded_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As coded_words without lower, but a word of ASCII letters and then marks (MARKS) counts as two, its letters in lower case and its marks."""
    starts, stops, rows = words(data, offsets)
    black, sizes = data[~_SPACE[data]], stops - starts
    at = np.concatenate([[0], np.cumsum(sizes)])
    letters, marks = (np.concatenate([[0], np.cumsum(kind[black], dtype=np.int32 if len(black) < 1 << 31 else np.int64)]) for kind in (_LETTER, _MARK))
    n = letters[at[1:]] - letters[at[:-1]]
    plain = (n > 0) & (n + marks[at[1:]] - marks[at[:-1]] == sizes) & (letters[at[:-1] + n] - letters[at[:-1]] == n)
    black = np.where(np.repeat(plain, sizes), _FOLD.astype(np.uint8)[black], black)
    two = plain & (n < sizes)
    parts = 1 + two
    lengths = np.repeat(np.where(two, n, sizes), parts)
    second = np.cumsum(parts)[two] - 1
    lengths[second] = (sizes - n)[two]
    return *_coded(black, lengths), np.repeat(rows, parts)


def _coded(black: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    col = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(black)])
    coded = col.dictionary_encode()
    return coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
