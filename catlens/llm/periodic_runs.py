"""Operator 11: periodic runs of words by an enhanced suffix array and the branching-tandem test.

A batch of texts is one array of word keys in which no two texts share a key, so suffixes of
different texts never compare equal. The suffix array comes from prefix doubling that sorts only the
suffixes not yet told apart; the ranks of every doubling give the exact LCP of neighbours. Every
neighbour boundary is an LCP interval of its depth d, split in two sides. For each suffix i of the smaller side
the test is whether ISA[i + d] or ISA[i - d] lies in the other side: then two equal blocks of d words
stand side by side and the word after them breaks the period, which is where a run ends. Such a
square is rotated to the left as far as the period holds, and squares of multiples of a period with the
same end lie inside the run of the period, so they merge into it. No tree is built: intervals are
index ranges. A run of at least four periods puts four suffixes into its interval, three of them on one side, so smaller
intervals are passed over.

Texts are independent, so the work is narrow: one Arrow batch, cut into pieces of about 1 MB, at a time. A
longer text is a piece of its own; it needs about 4 bytes a word for each doubling up to its longest repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import runs, text_buffers
from .words import U, mix, word_hashes, words

#: A run has at least this many words and this many periods.
MIN_WORDS = 6
MIN_PERIODS = 4
#: Suffixes tested at once.
TESTED = 1 << 21


def suffix_array(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and the LCP of each suffix with the one before it (lcp[0] = 0).

    ends[i] is the end of the text that holds position i; keys of different texts differ. Keys are
    compared in any fixed order.
    """
    n = len(keys)
    sa = np.argsort(keys)
    opens = np.ones(n + 1, dtype=bool)  # whether a group of suffixes not yet told apart begins here
    opens[1:n] = keys[sa][1:] != keys[sa][:-1]
    level = np.zeros(n, dtype=np.int8)  # the doubling that told a suffix from the one before it

    def ranks() -> np.ndarray:
        out = np.full(n + 1, -1, dtype=np.int32)
        out[sa] = np.maximum.accumulate(np.where(opens[:n], np.arange(n, dtype=np.int32), 0))
        return out

    history = [ranks()]
    width = 1
    while True:
        open_at = np.flatnonzero(~(opens[:n] & opens[1:]))
        if not len(open_at):
            break
        p = sa[open_at]
        after = np.where(p + width < ends[p], history[-1][np.minimum(p + width, n)], -1)
        group = history[-1][p]
        order = np.lexsort((after, group))
        sa[open_at], group, after = p[order], group[order], after[order]
        apart = np.flatnonzero((group[1:] == group[:-1]) & (after[1:] != after[:-1])) + 1
        opens[open_at[apart]] = True
        level[open_at[apart]] = len(history)
        width *= 2
        history.append(ranks())
    lcp = np.zeros(n, dtype=np.int32)
    for k in range(1, len(history)):
        at = np.flatnonzero(level == k)
        if not len(at):
            continue
        length = np.full(len(at), 1 << (k - 1), dtype=np.int32)
        a, b = sa[at - 1], sa[at]
        for j in range(k - 2, -1, -1):
            x, y = np.minimum(a + length, n), np.minimum(b + length, n)
            length += (history[j][x] == history[j][y]).astype(np.int32) << j
        lcp[at] = length
    return sa, history[-1][:n], lcp


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each boundary b with lcp[b] = d >= 1 in a group of at least four suffixes: b, the first rank of its left
    side (all suffixes before b that share d words with it) and the end of its right side (one child after b)."""
    n = len(lcp)
    zero = np.append(np.flatnonzero(lcp == 0), n)
    keep = np.flatnonzero(np.diff(zero) >= MIN_PERIODS)
    if not len(keep):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    size = (zero[keep + 1] - zero[keep]).astype(np.int64)
    base = np.cumsum(size) - size
    rank = np.arange(int(size.sum())) - np.repeat(base - zero[keep], size)
    c = np.append(lcp[rank], 0).astype(np.int32)
    table = [c]
    while (1 << len(table)) <= int(size.max()):
        half = table[-1]
        step = 1 << (len(table) - 1)
        nxt = half.copy()
        nxt[:-step] = np.minimum(half[:-step], half[step:])
        table.append(nxt)
    at = np.flatnonzero(c > 0)
    d = c[at]
    left, right = at.copy(), at + 1
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        fits = left >= step
        left -= np.where(fits & (table[k][np.maximum(left - step, 0)] >= d), step, 0)
        fits = right + step <= len(c)
        right += np.where(fits & (table[k][np.minimum(right, len(c) - 1)] > d), step, 0)
    return rank[at], rank[left - 1], rank[right - 1] + 1


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of every square whose next word breaks the period, if its interval can hold a run."""
    b, low, high = _sides(lcp)
    left, right = b - low, high - b
    use = np.maximum(left, right) >= MIN_PERIODS - 1
    b, low, high, left, right = b[use], low[use], high[use], left[use], right[use]
    small_left = left <= right
    first, count = np.where(small_left, low, b), np.minimum(left, right)
    other, other_end = np.where(small_left, b, low), np.where(small_left, high, b)
    depth = lcp[b].astype(np.int64)
    found, n, i = [], len(sa), 0
    total = np.cumsum(count)
    while i < len(b):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + TESTED, side="right")))
        c = count[i:j]
        which = np.repeat(np.arange(i, j), c)
        p = sa[np.arange(len(which)) - np.repeat(np.cumsum(c) - c, c) + first[which]]
        d = depth[which]
        for partner, begin in ((p + d, p), (p - d, p - d)):
            inside = (partner >= 0) & (partner < n)
            r = isa[np.where(inside, partner, 0)]
            hit = np.flatnonzero(inside & (r >= other[which]) & (r < other_end[which]))
            found.append(np.stack([begin[hit] + 2 * d[hit], d[hit]]))
        i = j
    if not found:
        z = np.zeros(0, dtype=np.int64)
        return z, z
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _rotated(keys: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The starts moved to the left as long as words a period apart are equal."""
    start, live, block = start.copy(), np.arange(len(start)), 8
    while len(live):
        p = start[live][:, None] - np.arange(1, block + 1)
        inside = np.maximum(p, 0)
        same = (p >= 0) & (keys[inside] == keys[inside + period[live][:, None]])
        steps = np.where(same.all(axis=1), block, same.argmin(axis=1))
        start[live] -= steps
        live = live[steps == block]
        block = min(block * 4, max(8, TESTED // max(1, len(live))))
    return start


def find_runs(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, ordered by start, then period."""
    if not len(keys):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    end, period = branching_squares(*suffix_array(keys, ends))  # ordered by end, then period
    out = []
    while len(end):
        first = np.append(True, end[1:] != end[:-1])  # the least period left at each end is a smallest period
        group = np.cumsum(first) - 1
        start = _rotated(keys, end[first] - 2 * period[first], period[first])
        out.append(np.stack([start, end[first] - start, period[first]]))
        left = ~first & (end - 2 * period < start[group])
        end, period = end[left], period[left]
    if not out:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    start, length, period = np.concatenate(out, axis=1)
    use = length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
    start, length, period = start[use], length[use], period[use]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def rebuilt(n: int, doc_id: int | None) -> tuple[int, int] | None:
    """(a, p) if the words from a on repeat the p words at a, None if the text stays as it is."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _batch(ids: list, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    starts, stops, rows = words(data, offsets)
    hashes = word_hashes(data, starts, stops, lower=False)
    cuts = np.searchsorted(rows, np.arange(len(ids) + 1))
    source = np.arange(len(hashes))
    changed = set()
    for r, doc_id in enumerate(ids):
        lo, hi = int(cuts[r]), int(cuts[r + 1])
        tail = rebuilt(hi - lo, doc_id)
        if tail is not None:
            a, p = tail
            source[lo + a : hi] = lo + a + np.arange(hi - lo - a) % p
            changed.add(r)
    keys = hashes[source] + mix(rows.astype(U) + U(1))
    start, length, period = find_runs(keys, cuts[1:][rows] if len(rows) else np.zeros(0, np.int64))
    mine = np.searchsorted(start, cuts)
    edge = np.zeros(len(keys) + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.cumsum(edge)[:-1] == 0
    out = []
    for r, doc_id in enumerate(ids):
        lo, hi, i, j = int(cuts[r]), int(cuts[r + 1]), int(mine[r]), int(mine[r + 1])
        text = data[offsets[r] : offsets[r + 1]].tobytes().split()
        if r in changed:
            text = [text[x] for x in (source[lo:hi] - lo).tolist()]
        found = list(zip((start[i:j] - lo).tolist(), length[i:j].tolist(), period[i:j].tolist()))
        if found:
            text = compress(text, kept[lo:hi].tolist())
            best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            best = (*best, 1000 * best[1] // best[2])
        else:
            best = (None, None, None, None)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        out.append((doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(text)).hexdigest()))
    return out


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: the key, n_runs, the run with the greatest exponent and digests of all runs and of the text without repeats.

    A null text has no words; a null key never has its text rebuilt. Texts without a run have null start, length,
    period and exponent_milli. Repeated rows give repeated rows, an empty table gives none; other columns are
    not read, whatever their names.
    """
    schema = pa.schema(
        [(key, pa.int64())] + [(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")] + [(c, pa.string()) for c in ("runs_sha256", "collapsed_sha256")]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            out = []
            for i, j in runs(offsets):
                out += _batch(ids[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            columns = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    names = f"`{key}` long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(work, names)
