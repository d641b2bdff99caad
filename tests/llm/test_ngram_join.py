import random
import re

import numpy as np
import pytest
from catlens.llm.graph import components
from catlens.llm.ngram_join import histogram, keep_one, most_common, ngram_components, signatures

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_sets(rows, size):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
        out.append(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, size, percent):
    sets = brute_sets(rows, size)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))]


def near_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One two"), (1004, "one  TWO"), (1005, "one two three"), (1006, "Ä b c d e"), (1007, "ä b c d e")]
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([5, 12, 40, 120, 400]))]
        for copy in range(rng.choice([1, 2, 7])):
            own = list(text)
            for _ in range(int(len(own) * rng.choice([0, 0.005, 0.02, 0.05]))):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((base * 20 + copy, " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_components_equal_brute_force(make_docs, size, percent):
    rows = near_rows(size)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(make_docs(rows), size, percent).collect())
    assert got == sorted(brute(rows, size, percent))


def test_chain_and_crowd(make_docs):
    """A chain whose ends aren't similar is one component; a crowd of near copies is found whole."""
    rng = random.Random(3)
    text = [f"a{i}" for i in range(100)]
    chain = []
    for i in range(8):
        chain.append((i, " ".join(text)))
        for j in range(5):
            text[i * 5 + j] = f"b{i * 5 + j}"
    base = [f"c{rng.randrange(200)}" for _ in range(150)]
    crowd = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(150)] = f"d{i}"
        crowd.append((100 + i, " ".join(own)))
    rows = chain + crowd
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(make_docs(rows), 4, 85).collect())
    assert got == sorted(brute(rows, 4, 85))
    assert {c for d, _, c in got if d >= 100} == {100}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for _ in range(400):
        size = int(rng.integers(1, 700))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        k = int(rng.integers(0, max(1, size // 6) + 1))
        b = np.unique(np.concatenate([a[k:], rng.integers(0, 2**63, int(rng.integers(0, k + 2))).astype(np.uint64)]))
        a = np.unique(a)
        n = len(np.intersect1d(a, b))
        if len(b) and 100 * n >= 85 * (len(a) + len(b) - n):
            assert set(signatures(a, 85).tolist()) & set(signatures(b, 85).tolist())


def test_histograms_never_bound_below_the_truth():
    rng = np.random.default_rng(2)
    pruned = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 900))).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 2**63, int(rng.integers(0, 300))).astype(np.uint64)]))
        n, bound = len(np.intersect1d(a, b)), most_common(histogram(a), histogram(b), len(a), len(b))
        assert n <= bound <= min(len(a), len(b))
        pruned += 100 * bound < 80 * (len(a) + len(b) - bound)
    assert pruned > 100
    crowded = np.arange(100_000, dtype=np.uint64)
    assert histogram(crowded) == b"" and most_common(b"", histogram(a), 100_000, len(a)) == len(a)


def test_empty_table_and_bad_threshold(make_docs):
    assert ngram_components(make_docs([]), 4, 85).count() == 0
    with pytest.raises(ValueError):
        ngram_components(make_docs([]), 4, 50)


def test_keep_one(make_docs):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(5, long), (3, long + " x"), (3, long + " x"), (9, "other text of its own here"), (7, None), (8, ""), (8, ""), (None, "lonely words without any id")]
    kept = keep_one(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(False, 3, long + " x"), (False, 9, rows[3][1]), (False, 7, ""), (False, 8, ""), (False, 8, ""), (True, 0, rows[7][1])]
    )


def test_components_of_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("few", [2, 32])
def test_family_around_the_threshold(make_docs, monkeypatch, few):
    """Near copies of one text, some pairs above and most below the threshold, through both ways of comparing what pivots leave."""
    from catlens.llm import ngram_join

    monkeypatch.setattr(ngram_join, "FEW", few)
    rng = random.Random(few)
    base = [f"c{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(70):
        own = list(base)
        for _ in range(rng.choice([1, 2, 3, 3, 3])):
            own[rng.randrange(120)] = f"d{rng.randrange(100_000)}"
        rows.append((i, " ".join(own)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(make_docs(rows), 4, 85).collect())
    assert got == sorted(brute(rows, 4, 85))
