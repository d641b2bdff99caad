import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from catlens.llm.lattice_lm import MARK, Vocabulary, lattices, score_texts, word_counts
from catlens.llm.words import coded_words

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.from_model(PATH)


def pieces_of(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = {}
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and MARK not in p[1:]:
            out[p] = i
    return out, {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}


def segmentations(text, pieces, spelled):
    """Every list of piece ids of the text; a character without a piece is its bytes."""
    if not text:
        yield []
        return
    firsts = [(n, [pieces[text[:n]]]) for n in range(1, len(text) + 1) if text[:n] in pieces]
    if text[0] not in pieces:
        firsts.append((1, [spelled[b] for b in text[0].encode()]))
    for n, ids in firsts:
        for rest in segmentations(text[n:], pieces, spelled):
            yield ids + rest


WORDS = ["the", "thing", "größer", "a", "日本語", "x́y", "éclair", "zz😀", "\x00\x01", "1234567", "internal", "–", "ß"]


def test_marginals_and_expected_uses_equal_enumeration(vocabulary):
    pieces, spelled = pieces_of(vocabulary)
    padded = np.append(vocabulary.weights, -np.inf)
    col = pa.array(WORDS)
    got, uses = np.zeros(len(WORDS)), np.zeros(len(vocabulary.weights))
    for rows, lattice in lattices(vocabulary, col):
        got[rows] = lattice.totals(lattice.forward(padded))
        lattice.expected(padded, np.arange(1.0, len(WORDS) + 1)[rows], uses)
    want = np.zeros(len(uses))
    for k, w in enumerate(WORDS):
        all_ways = [(math.exp(sum(vocabulary.weights[i] for i in way)), way) for way in segmentations(MARK + w, pieces, spelled)]
        total = sum(p for p, _ in all_ways)
        assert got[k] == pytest.approx(math.log(total), abs=1e-9)
        for p, way in all_ways:
            for i in way:
                want[i] += (k + 1) * p / total
    assert np.abs(uses - want).max() < 1e-8


def test_weights_are_a_distribution(vocabulary):
    assert np.exp(vocabulary.weights).sum() == pytest.approx(1.0)
    assert (vocabulary.weights[vocabulary.bytes] > -np.inf).all() and vocabulary.weights[vocabulary.end] > -np.inf


def test_very_long_word(vocabulary):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdé日") for _ in range(20_000))
    padded = np.append(vocabulary.weights, -np.inf)
    lp = {}
    for rows, lattice in lattices(vocabulary, pa.array([long, "a", "", long[:9]])):
        lp.update(zip(rows.tolist(), lattice.totals(lattice.forward(padded)).tolist()))
    assert all(np.isfinite(x) and x < 0 for x in lp.values()) and lp[0] < lp[3]


def rows_of(seed, n=120):
    rng = random.Random(seed)
    words = [rng.choice(["the", "of", "größe", "Élan", "ding"]) + rng.choice(["", "s", "ing", "X", "9"]) for _ in range(40)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (None, "The end"), (3, "  Lone"), (4, "Ä ä A a"), (5, "only\x0bhere\x0c日本")]
    rows += [(i, rng.choice([" ", "\n", " \r\n"]).join(rng.choice(words) if rng.random() < 0.95 else f"rare{rng.randrange(10**6)}" for _ in range(rng.choice([1, 8, 90])))) for i in range(6, n)]
    return rows + rows[8:12]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def tokens(t):
    lower = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return [*WORD.findall(lower), None]


def brute_base(rows):
    c = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(d, held(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for d, t in rows]


def order(r):
    return (r[0] is None, r[0] or 0, r[2], r[5])


@pytest.mark.parametrize("common", [400_000, 7, 0])
def test_base_scores_equal_brute_force(make_docs, monkeypatch, common):
    """Whatever share of the words takes the way through the join."""
    import catlens.llm.lattice_lm as L

    monkeypatch.setattr(L, "COMMON", common)
    rows = rows_of(2)
    got = [tuple(r) for r in score_texts(make_docs(rows), PATH, rounds=1).collect()]
    got, want = sorted(got, key=order), sorted(brute_base(rows), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)


def test_scores_do_not_depend_on_the_way_and_add_up_over_words(make_docs, monkeypatch):
    import catlens.llm.lattice_lm as L

    rows = rows_of(4)
    scores = []
    for common in (400_000, 3):
        monkeypatch.setattr(L, "COMMON", common)
        scores.append(sorted(tuple(r) for r in score_texts(make_docs([r for r in rows if r[0] is not None]), PATH, rounds=2).collect()))
    assert [s[6] for s in scores[0]] == pytest.approx([s[6] for s in scores[1]])


def test_learning_raises_the_likelihood_of_unseen_texts(make_docs):
    rng = random.Random(3)
    syllables = ["tha", "ing", "er", "ou", "sch", "keit"]
    rows = [(i, " ".join("".join(rng.choice(syllables) for _ in range(rng.choice([1, 2, 3]))) for _ in range(60))) for i in range(150)]
    mean = []
    for rounds in (0, 1, 3):
        got = [r for r in score_texts(make_docs(rows), PATH, rounds=rounds).collect() if r.held_out]
        mean.append(sum(r.score for r in got) / sum(r.n_tokens for r in got))
    assert mean[0] < mean[1] < mean[2] and mean[2] - mean[0] > 1.0


def test_word_counts_and_coding(make_docs):
    rows = rows_of(5)
    every, train = Counter(), Counter()
    for d, t in rows:
        every.update(tokens(t)[:-1])
        if not held(d):
            train.update(tokens(t)[:-1])
    assert {r.word: (r.n, r.c) for r in word_counts(make_docs(rows)).collect()} == {w: (n, train[w]) for w, n in every.items()}
    text = "Ab  ab\tCD É".encode()
    distinct, code, row = coded_words(np.frombuffer(text, dtype=np.uint8), np.array([0, 6, len(text)]))
    assert [distinct[i].as_py() for i in code] == ["ab", "ab", "cd", "É"] and row.tolist() == [0, 0, 1, 1]


def test_empty_table_and_no_training_rows(make_docs):
    assert score_texts(make_docs([]), PATH).count() == 0
    d = next(i for i in range(100) if held(i))
    (r,) = score_texts(make_docs([(d, "all held out")]), PATH).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 4, 0, 0, 0.0) and r.score < 0
