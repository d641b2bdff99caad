import random
import re

import numpy as np
import pytest
from catlens.llm.fm_index import FMIndex, WaveletMatrix, suffix_array, window_classes
from catlens.llm.substring_dedup import remove_repeats


def brute(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, split, strict=True):
        key = -(2**63) if d is None else d
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            first[g] = min(key, first.get(g, key))
    out = []
    for (d, _), w in zip(rows, split, strict=True):
        key, gone = -(2**63) if d is None else d, set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def repeated_rows(seed, window):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "x.", "the"]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [some(rng.choice([window, window + 1, window * 3])) for _ in range(4)]
    rows = [(900, None), (901, ""), (902, " \x0b\n"), (903, " ".join(["same"] * 200)), (904, " ".join(["same"] * (window + 5)))]
    for i in range(40):
        text = some(rng.randrange(120))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            at = rng.randrange(len(text) + 1)
            text[at:at] = p[rng.randrange(3) :]
        rows.append((i * 3, " \n".join(text)))
    rows += [(500, rows[10][1]), (1, rows[10][1]), (3, rows[11][1]), (3, rows[11][1]), (None, rows[12][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "crowded"), [(50, 20_000), (20, 20_000), (20, 1), (20, 4)])
def test_equals_brute_force(make_docs, window, crowded):
    rows = repeated_rows(window, window)
    got = remove_repeats(make_docs(rows), window, crowded).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(rows, window)
    assert all(sum(s["to"] - s["from"] for s in r.spans) == r.n_removed for r in got)


@pytest.mark.parametrize("shared", [14, 35, 49, 60])
def test_crowded_anchors_are_cut_finer(make_docs, shared):
    """A line of 14 to 60 words in all documents between other words: its anchors have more passages than allowed."""
    rng = random.Random(shared)
    line = [f"c{i}" for i in range(shared)]
    some = lambda: [f"w{rng.randrange(30)}" for _ in range(60)]
    rows = [(i, " ".join(some() + line + some())) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    got = remove_repeats(make_docs(rows), 50, 10).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(rows, 50)


def test_empty_table_and_window(make_docs):
    assert remove_repeats(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(make_docs([]), window=10)


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 37, 1000)
    w = WaveletMatrix(x)
    i, c = rng.integers(0, 1001, 500), rng.integers(0, 37, 500)
    assert (w.rank(c, i) == [(x[:k] == s).sum() for k, s in zip(i, c, strict=True)]).all()


def test_suffix_array_and_search():
    rng = np.random.default_rng(2)
    x = rng.integers(1, 4, 300)
    text = np.concatenate([x, [0]])
    order, _ = suffix_array(text, 4)
    assert order.tolist() == sorted(range(301), key=lambda k: text[k:].tolist())
    index = FMIndex(x, 5)
    for _ in range(200):
        p = rng.integers(1, 4, rng.integers(1, 8))
        lo, hi = index.search(p)
        assert sorted(index.sa[lo:hi]) == [k for k in range(301 - len(p)) if (x[k : k + len(p)] == p).all()]


def test_streamed_documents_report_all_matches():
    """Documents that the index doesn't hold: every position with a match of the window, and no other."""
    rng = np.random.default_rng(3)
    x = rng.integers(1, 5, 400)
    index = FMIndex(x, 6)
    docs = [rng.integers(1, 6, rng.integers(1, 60)) for _ in range(50)] + [x[30:80]]
    lengths = np.array([len(d) for d in docs])
    at, where, cls = window_classes(index, np.concatenate(docs) % 5, np.cumsum(lengths), lengths, 6)
    plain = [d % 5 for d in docs]
    windows = {tuple(x[k : k + 6]) for k in range(395)}
    want = {(k, i) for k, d in enumerate(plain) for i in range(len(d) - 5) if tuple(d[i : i + 6]) in windows}
    assert {(int(a), int(b)) for a, b in zip(at, where, strict=True)} == want
    for a, b, c in zip(at, where, cls, strict=True):
        start = index.sa[index.class_first[c]]
        assert (x[start : start + 6] == plain[a][b : b + 6]).all()
