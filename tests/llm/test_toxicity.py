import random
import zlib

import numpy as np
import pyarrow as pa
from catlens.llm import toxicity as module
from catlens.llm.toxicity import BUCKETS, LANGUAGES, TABLES, Learner, Model, bucket_counts, start, text_words, toxicity, training_rows
from pyspark.sql import functions as F

BAD = ["idiot", "moron", "trash"]


def corpus(n=700):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        text = [f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" if rng.random() < 0.6 else rng.choice(["the", "of", "and"]) for _ in range(rng.choice([5, 60, 300]))]
        bad = i % 5 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", ",", "."]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark, make_docs):
    docs, labels = corpus()
    extra = [(10_000, None), (10_001, ""), (None, "an Idiot, you see"), (10_002, "the good of it and the rest"), (10_002, "the good of it and the rest")]
    table = spark.createDataFrame(labels + [(3, 1, None), (10_000, 1, 1), (5, 0, 7), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity(make_docs(docs + extra), table).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id < 10_000]
    assert held and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[10_002].predicted == 0 and by_id[10_000].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_without_labels_and_without_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    (r,) = toxicity(make_docs([(1, "some text")]), none).collect()
    assert r.predicted == 0
    assert toxicity(make_docs([]), none).count() == 0


def test_language_comes_from_the_text():
    texts = ["the cat of the house", "der Hund und die Katze", "le chat dans la rue", "el perro y los gatos", "xyzzy", ""]
    found = [k for _, _, langs in text_words(pa.array(texts)) for k in langs]
    assert [LANGUAGES[k] for k in found] == ["en", "de", "fr", "es", "other", "other"]


def test_long_texts_leave_the_others_in_the_sample(spark, make_docs, monkeypatch):
    monkeypatch.setattr(module, "TRAIN_WORDS", 1000)
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    first = table.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    docs = [(i, "word " * (2000 if i == first else 10)) for i in range(60)]
    sample = training_rows(make_docs(docs), table, F.lit(False))
    assert sorted(sample.labels.tolist()) == sorted(i % 2 for i in range(60) if i != first)
    assert {len(x) for x in sample.rows} == {10}
    # a label with long texts only has the first words of one
    docs = [(i, "word " * (2000 if i % 2 else 10)) for i in range(60)]
    sample = training_rows(make_docs(docs), table, F.lit(False))
    assert sorted(sample.labels.tolist()) == [0] * 30 + [1] and sum(len(x) for x in sample.rows) <= 1000


def held_out_accuracy(rows, labels):
    truth = {i: t for i, _, t in labels}
    held = [r for r in rows if r.held_out]
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_learns_from_all_labelled_rows_in_several_tasks(spark, make_docs, monkeypatch):
    docs, labels = corpus()
    monkeypatch.setattr(module, "TRAIN_WORDS", 20)  # bounds of the driver's sample are none of the model's
    monkeypatch.setattr(module, "TRAIN_ROWS", 2)
    monkeypatch.setattr(module, "TASK_ROWS", 100)
    monkeypatch.setattr(module, "LABELS_AT_ONCE", 250)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert held_out_accuracy(toxicity(make_docs(docs), table).collect(), labels) > 0.95


def test_counts_and_cuts_are_over_all_tasks(spark):
    found = [b for _, part, _ in text_words(pa.array([f"c{i % 7} w{i} w{i}" for i in range(60)])) for b in part]
    labels = np.arange(60) % 2
    rows = [(int(y), 0, b.tobytes()) for b, y in zip(found, labels, strict=True)]
    table = spark.createDataFrame(rows, "toxic int, lang int, b binary").repartition(5)
    assert np.array_equal(module._all_counts(table), bucket_counts(found, labels))
    model = Model()
    model.out_bias[:] = -2.0
    for b, y in zip(found, labels, strict=True):
        if y:
            model.tables[0][b[1, 0], 0] = 4.0  # the toxic rows' own words
    model.filters[1][0, 0], model.out[0] = 1.0, 1.0
    z = np.array([model.logit(b) for b in found])
    shift = module._shifts(table, model)
    assert np.array_equal(z > shift[0], labels == 1) and len(set(shift.tolist())) == 1


def test_a_step_follows_the_gradient():
    found = [b for _, part, _ in text_words(pa.array(["one", "two words", "the quick brown fox and the lazy dog", "one fox"])) for b in part]
    labels, weight = np.array([1, 0, 0, 1]), (0.5, 2.0)
    held = np.random.default_rng(3).random((2, TABLES * BUCKETS)) * 5
    model = start(np.stack([held[0] + 5, held[1]]), 40, 10)

    def loss(values):
        z = np.array([Model(values).logit(b) for b in found], dtype=np.float64)
        return sum(weight[y] * (np.log1p(np.exp(v)) - y * v) for v, y in zip(z, labels, strict=True))

    own = Learner(model.values.copy(), np.zeros_like(model.values), weight)
    own.learn(found, labels)
    met = np.flatnonzero(own.touched)
    words = {int(b) + k * BUCKETS for x in found for row in x for k, b in enumerate(row)}
    assert set(met[met < TABLES * BUCKETS].tolist()) <= words
    values = model.values.astype(np.float64)
    for r in [*met[met < TABLES * BUCKETS][::9], *met[-9:]]:
        for d in range(values.shape[1]):
            up, down = values.copy(), values.copy()
            up[r, d] += 1e-5
            down[r, d] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            assert abs(np.sqrt(own.sums.values[r, d]) - abs(slope)) < 1e-3 + 0.01 * abs(slope)
            moved = own.model.values[r, d] - model.values[r, d]
            assert moved * slope <= 0


def test_every_label_reaches_its_text_once(spark, make_docs, monkeypatch):
    monkeypatch.setattr(module, "LABELS_AT_ONCE", 7)
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] * 2, "doc_id long, quality int, toxic int")
    parts = module.labelled_rows(make_docs([(i, f"word{i}") for i in range(50)] + [(3, "again")]), table, F.col("doc_id") == 5)
    got = [(r.doc_id, r.toxic) for p in parts for r in p.collect()]
    assert len(parts) == 6 and sorted(got) == sorted([(i, i % 2) for i in range(40) if i != 5] + [(3, 1)])
