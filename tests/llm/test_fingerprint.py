import hashlib
import random

import numpy as np
from catlens.llm.fingerprint import _EMPTY, _densify, decode, fingerprints, likeness
from .test_ngram_join import brute_sets


def rows_of(seed, n=60):
    rng = random.Random(seed)
    rows = [(-1, None), (-2, ""), (-3, "é"), (-4, "two words")]
    text = ""
    for i in range(n):
        if i % 3 == 0:
            text = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 30, 300, 2000])))
        rows.append((i * 7, text))
    rng.shuffle(rows)
    return rows


def test_columns_equal_brute_force(make_docs):
    rows = rows_of(1)
    got = {r.doc_id: r for r in fingerprints(make_docs(rows)).collect()}
    order = sorted((d, t or "") for d, t in rows)
    errors = []
    for (d, t), (_, s) in zip(order, order[1:] + order[:1], strict=True):
        r, k = got[d], len(t) // 4
        edited = t[: len(t) - k] + s[:k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (brute_sets([(0, x)], 5)[0] for x in (t, edited, s))
        for near, other in ((r.near_edited, b), (r.near_next, c)):
            true = len(a & other) / len(a | other) if a | other else 1.0
            assert 0 <= near <= 1 and abs(near - true) < 0.12
            errors.append(abs(near - true))
    assert np.mean(errors) < 0.02
    same = {}
    for d, t in order:
        assert same.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    assert got[-1].fingerprint == "" and got[0].fingerprint != ""


def test_single_empty_and_repeated(make_docs):
    assert fingerprints(make_docs([])).count() == 0
    (r,) = fingerprints(make_docs([(3, "alone in here with six words")])).collect()
    assert r.near_next == 1.0
    twice = fingerprints(make_docs([(3, "a b c d e f"), (3, "a b c d e f"), (None, "x")])).collect()
    near = sorted(x.near_next for x in twice)
    assert len(twice) == 3 and near[2] == 1.0 and near[1] < 0.05  # an estimate


def test_densification_is_unbiased():
    """Sparse sets: the share of equal bins still estimates the similarity."""
    rng = np.random.default_rng(2)
    found = []
    for _ in range(200):
        union = rng.integers(0, 2**32 - 1, 12, dtype=np.uint32)
        place = rng.integers(0, 1024, 12)
        a, b = np.full((2, 1024), _EMPTY, dtype=np.uint32)
        np.minimum.at(a, place[:9], union[:9])
        np.minimum.at(b, place[3:], union[3:])
        x = _densify(np.stack([a, b]))
        assert (x != _EMPTY).all()
        found.append((x[0] == x[1]).mean())
    assert abs(np.mean(found) - 0.5) < 0.03


def test_likeness_of_bits():
    assert likeness([b""], [b""]).tolist() == [1.0] and likeness([b""], [b"\1"]).tolist() == [0.0]
    assert decode("AAE=") == b"\0\1"
