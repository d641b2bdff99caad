"""Ranks over range partitions, joined encoding and sparse Naive Bayes (H1-H3, I1, I2 at a large vocabulary)."""

import random

import pytest
from pyspark.sql import functions as F

from catlens.config import FIXTURE_CONFIG as CFG
from catlens.operators import features, joined, models
from catlens.operators.cleaning import SPLIT_HASH
from catlens.operators.ranking import position_in_group

TINY = CFG.with_(features=("make", "color"), categorical_cols=("make", "color"), key_col=None)


@pytest.fixture(scope="module")
def keep():
    held = []
    yield held
    while held:
        held.pop()()


@pytest.fixture(scope="module")
def tiny(spark):
    """A third of the rows share one make, most makes occur once, some values are NULL."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        make = "HOT" if i % 3 == 0 else rng.choice([f"m{i}", f"m{rng.randrange(40)}", None, "é", "zé", "\U0001f600"])
        rows.append((rng.choice("AAAB") if i % 7 else "C", make, rng.choice(["red", "blue", None]), i))
    train = spark.createDataFrame(rows[:700], f"{CFG.label_col} string, make string, color string, `{SPLIT_HASH}` long")
    rest = [(a, "UNSEEN" if i % 2 else b, c, d) for i, (a, b, c, d) in enumerate(rows[700:])]
    return train, spark.createDataFrame(rest, train.schema), rows[:700], rest


def test_positions_equal_a_sort_and_no_task_holds_a_group(spark, keep):
    rng = random.Random(1)
    rows = [("big", i, rng.randrange(5)) for i in range(4000)] + [(f"g{i % 9}", i, rng.randrange(5)) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(5)
    got, sizes = position_in_group(df, "g", [F.desc("v"), F.asc("k")], "at", keep, 8)
    want, seen = {}, {}
    for g, k, _ in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        want[g, k] = seen.get(g, 0)
        seen[g] = want[g, k] + 1
    assert {(r.g, r.k): r.at for r in got.collect()} == want and sizes == seen
    parts = got.where("g = 'big'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 4 and max(r[1] for r in parts) < 1500


def test_positions_of_an_empty_table(spark, keep):
    got, sizes = position_in_group(spark.createDataFrame([], "g string, k long"), "g", [F.asc("k")], "at", keep)
    assert got.collect() == [] and sizes == {}


def test_index_table_equals_string_indexer(tiny, keep):
    train = tiny[0]
    table = features.category_index_table(features.vocabulary_counts(train, TINY), TINY, keep)
    fm, _, counts = features.fit_features(train, TINY.with_(fit_from_counts=True))
    counts.unpersist()
    assert [r.slot_name for r in table.orderBy("slot").collect()] == features.slot_names(fm, TINY)


def test_joined_one_hot_and_vectors_equal_the_indexers(tiny, keep):
    train, rest, _, _ = tiny
    counts = features.vocabulary_counts(train, TINY)
    table = joined.vocabulary_table(counts, TINY, keep)
    fm, _, c = features.fit_features(train, TINY)
    c.unpersist()
    rows = joined.numbered(train.unionByName(rest), keep)
    want = features.one_hot_long(features.apply_indexers(fm, rows), fm, TINY, joined.ROW)
    got = joined.one_hot_long_joined(rows, table, TINY, keep)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    vectors = {r[joined.ROW]: r for r in joined.sparse_vectors(rows, table, TINY, keep).collect()}
    slots = {}
    for r in want.collect():
        slots.setdefault(r[joined.ROW], []).append(r.slot)
    assert len(vectors) == 900
    for k, v in vectors.items():
        assert v.indices == sorted(slots.get(k, [])) and v["values"] == [1.0] * len(v.indices) and v.size == len(features.slot_names(fm, TINY))


def test_hot_values_take_the_broadcast(tiny, keep):
    train = tiny[0]
    rows = joined.numbered(train, keep)
    long = joined.cells(rows, TINY)
    table = joined.vocabulary_table(features.vocabulary_counts(train, TINY), TINY, keep)
    found = joined.look_up(long, table.select(*joined.KEYS, "slot"), keep)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and found.count() == long.count()


def test_sparse_naive_bayes_equals_mllib(tiny, keep):
    train, rest, _, _ = tiny
    counts = features.vocabulary_counts(train, TINY).persist()
    keep.append(counts.unpersist)
    model = joined.SparseNaiveBayes(counts, TINY, keep)
    rows = joined.numbered(rest, keep)
    got = {r[joined.ROW]: r[features.PREDICTED_LABEL] for r in model.predict(rows).collect()}
    mllib = models.fit(train, TINY, "nb")
    full = features.index_to_label(mllib, mllib.transform(rows)).select(joined.ROW, features.PREDICTED_LABEL)
    assert got == {r[0]: r[1] for r in full.collect()} and len(got) == 200
    assert model.table.count() < 700 and len(model.labels) == 3


def test_smoothing_of_zero_is_refused(tiny, keep):
    with pytest.raises(ValueError):
        joined.SparseNaiveBayes(features.vocabulary_counts(tiny[0], TINY), TINY.with_(smoothing=0.0), keep)
