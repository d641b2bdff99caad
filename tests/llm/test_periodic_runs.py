import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from catlens.llm.periodic_runs import find_runs, periodic_runs, rebuilt, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """Every maximal stretch of at least max(6, 4 q) words with smallest period q."""
    best = {}
    for q in range(len(w) // 4, 0, -1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best[i, j + q] = q  # a smaller period of the same stretch comes later
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_suffix_array_and_lcp_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(rng.choice([1, 2, 9])) for _ in range(rng.randrange(1, 40))] for _ in range(3)]
        keys = np.array([100 * d + x for d, t in enumerate(texts) for x in t], dtype=np.uint64)
        bounds = np.cumsum([len(t) for t in texts])
        ends = np.repeat(bounds, [len(t) for t in texts])
        sa, isa, lcp = suffix_array(keys, ends)
        suffix = [tuple(int(x) for x in keys[i : ends[i]]) for i in range(len(keys))]
        assert [suffix[i] for i in sa] == sorted(suffix)
        assert (isa[sa] == np.arange(len(keys))).all()
        for r in range(1, len(sa)):
            a, b = suffix[sa[r - 1]], suffix[sa[r]]
            same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert lcp[r] == same


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(150):
        w = []
        for _ in range(rng.randrange(1, 6)):
            block = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
            w += (block * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        keys = np.array(w, dtype=np.uint64)
        got = list(zip(*(x.tolist() for x in find_runs(keys, np.full(len(w), len(w))))))
        assert got == brute_runs(w)


def texts(seed):
    rng = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a a a a a a"), (4, "a a a a a"), (5, "A a A a A a A a"), (6, "a a a a"), (None, "x y x y x y x y"), (7, "ü  ü  " * 9)]
    for d in range(8, 200):
        w = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.choice([3, 20, 150]))]
        if rng.random() < 0.5:
            at, block = rng.randrange(len(w)), w[: rng.randrange(1, 6)]
            w[at:at] = block * rng.randrange(2, 8)
        rows.append((d, rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows + rows[20:24]


def test_rows_equal_brute_force(make_docs):
    rows = texts(3)
    got = [tuple(r) for r in periodic_runs(make_docs(rows)).collect()]
    assert sorted(got, key=str) == sorted((brute(d, t) for d, t in rows), key=str)
    assert sum(rebuilt(5, d) is not None for d, _ in rows if d is not None) > 5


def test_one_word_a_long_period_and_a_very_long_text(make_docs):
    rng = random.Random(5)
    block = [f"w{rng.randrange(900)}" for _ in range(20_000)]
    rows = [(1, "ha " * 60_000), (3, " ".join(block * 5 + block[:7])), (4, " ".join(f"w{rng.randrange(5000)}" for _ in range(300_000)))]
    assert all(rebuilt(9, d) is None for d, _ in rows)
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in periodic_runs(make_docs(rows)).collect()}
    assert got == {1: (1, 0, 60_000, 1, 60_000_000), 3: (1, 0, 100_007, 20_000, 5000), 4: (0, None, None, None, None)}


def test_empty_table(make_docs):
    assert periodic_runs(make_docs([])).collect() == []
