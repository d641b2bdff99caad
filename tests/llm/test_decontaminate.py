import random

import numpy as np
from catlens.llm import decontaminate as module
from catlens.llm.decontaminate import answer_of, contamination, lcs_length, randomised_svd


def corpus():
    rng = random.Random(6)
    rare = lambda: f"{rng.choice('klmnop')}word{rng.randrange(4000)}"
    sentence = lambda n: " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else rare() for _ in range(n))
    items = [(i, sentence(rng.choice([15, 40, 55])) + "? " + sentence(6) + ".") for i in range(60)] + [(60, sentence(200)), (61, None), (62, "")]
    docs, truth = [], {}
    for d in range(300):
        text, truth[d] = sentence(rng.choice([20, 150, 600])).split(), set()
        if d % 10 == 0:
            n = d // 10
            passage = items[n][1].split()
            if d % 20 == 0:  # a paraphrase: some words changed, some gone
                for _ in range(len(passage) // 8):
                    passage[rng.randrange(len(passage) - 8)] = rare()
                del passage[3]
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() for w in passage]
            truth[d] = {n}
        docs.append((d, " ".join(text)))
    docs.append((1000, sentence(100) + " " + items[60][1] + " " + sentence(50)))
    truth[1000] = {60}
    return docs, items, truth


def test_finds_planted_items_and_leaves_others(spark, make_docs):
    docs, items, truth = corpus()
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string")
    got = contamination(make_docs(docs + [(2000, None), (2001, "")]), bench).collect()
    assert len(got) == len(docs) + 2
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in got}
    assert found.pop(2000) == set() and found.pop(2001) == set()
    assert found == truth
    assert all(r.contaminated == bool(r.leaks) for r in got)


def test_item_in_a_third_of_the_rows_is_found(spark, make_docs):
    docs, items, truth = corpus()
    for k in (0, 2):  # items of about 20 and 60 words, each in a third: more than max(50, 2 * items) and 5 % of the rows
        docs += [(3000 + 1000 * k + i, text + " " + items[k][1]) for i, (_, text) in enumerate(docs[:150])]
        truth |= {3000 + 1000 * k + i: truth[docs[i][0]] | {k} for i in range(150)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in contamination(make_docs(docs), bench).collect()}
    assert found == truth


def test_rare_words_of_an_item_are_no_leak_without_its_common_ones(spark, make_docs):
    rng = random.Random(4)
    common = [f"common{i}" for i in range(15)]
    rare = [f"rare{i}" for i in range(5)]
    item = " ".join(w for i in range(5) for w in (*common[3 * i : 3 * i + 3], rare[i]))
    filler = lambda n: " ".join(f"other{rng.randrange(3000)}" for _ in range(n))
    docs = [(i, filler(40) + " " + " ".join(rng.sample(common, 15))) for i in range(200)]
    docs += [(500, filler(60) + " " + " ".join(rare[:1] + rare[:4]) + " " + filler(60)), (501, filler(60) + " " + item + " " + filler(60))]
    found = contamination(make_docs(docs), spark.createDataFrame([(7, item)], "item_id long, text string")).where("contaminated").collect()
    assert [(r.doc_id, r.leaks[0].lcs) for r in found] == [(501, 1.0)]


def test_short_items_of_a_large_benchmark_are_found(spark, make_docs):
    rng = random.Random(9)
    sentence = lambda n: " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{int(9000 * rng.random() ** 2)}" for _ in range(n))
    items = [(i, sentence(rng.randrange(10, 30))) for i in range(2048)]
    docs, truth = [], {}
    for i in range(0, 2048, 2):  # each in the middle of a text of 200 words
        words = sentence(200).split()
        at = rng.randrange(len(words))
        docs.append((i, " ".join(words[:at] + [items[i][1]] + words[at:])))
    docs += [(5000 + i, sentence(200)) for i in range(200)]
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [d for d, _ in docs if d < 5000 and d not in found[d]] == []
    assert [d for d, _ in docs if found[d] - {d}] == []


def test_blocks_share_one_count_of_the_documents(spark, make_docs, monkeypatch):
    docs, items, truth = corpus()
    calls, count = [], module._frequencies
    monkeypatch.setattr(module, "_frequencies", lambda *a: calls.append(1) or count(*a))
    monkeypatch.setattr(module, "BLOCK", 25)
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == truth and len(calls) == 1


def test_batches_of_blocks_give_the_same_rows(spark, make_docs, monkeypatch):
    docs, items, truth = corpus()
    docs += [(9000, None), (None, docs[10][1]), (9001, docs[10][1]), (9001, docs[10][1])]
    truth |= {9000: set(), None: truth[10], 9001: truth[10]}
    monkeypatch.setattr(module, "BLOCK", 25)
    table = make_docs(docs).withColumnRenamed("extra", "leaks").withColumnRenamed("k", "row")
    bench = spark.createDataFrame(items, "item_id long, text string")
    once, parts = contamination(table, bench), contamination(table, bench, sent_bytes=1)
    assert parts.columns == once.columns
    got = parts.collect()
    assert len(got) == len(docs) and {r.doc_id: {x.item_id for x in r.leaks} for r in got} == truth
    key = lambda r: (r.node, [x.item_id for x in r.leaks], r.contaminated)
    assert sorted(map(key, got)) == sorted(map(key, once.collect()))


def test_item_in_a_very_long_text(spark, make_docs):
    docs, items, _ = corpus()
    filler = " ".join(f"other{i % 9973}" for i in range(300_000))
    got = contamination(make_docs([(1, f"{filler} {items[3][1]} {filler}"), (2, filler)]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in got} == {1: [3], 2: []}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in contamination(make_docs([(1, "some text")]), none).collect()] == [False]
    assert contamination(make_docs([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_lcs_equals_dynamic_programme():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = rng.integers(0, 6, rng.integers(0, 90)), rng.integers(0, 6, rng.integers(0, 120))
        t = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert lcs_length(a, b) == t[-1, -1]


def test_svd_spans_the_leading_directions(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40)) + 1e-3 * rng.standard_normal((60, 40))
    rows = spark.createDataFrame([(list(range(40)), row.tolist()) for row in a], "f array<int>, x array<double>").repartition(3)
    v = randomised_svd(rows, 40, 5)
    true = np.linalg.svd(a)[2][:5]
    assert v.shape == (40, 5) and np.linalg.svd(true @ v)[1].min() > 0.999


def test_answers():
    assert answer_of("What is it? Seven things.") == "Seven things." and answer_of("One. Two three.\nFour") == "Four" and answer_of("") == ""
