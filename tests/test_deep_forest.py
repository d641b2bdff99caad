"""The deep forest as a table of nodes (I3, I4): fit, predictions, persistence."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.operators import deep_forest, features, forest, models

CFG = JobConfig(features=("a", "b", "c"), label_col="lab", num_trees=5, max_depth=14, deep_node_rows=1 << 18)
LABELS = ["x", "y", "z"]


def _rows(n, seed=3):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = (r.randrange(k) for k in (7, 5, 40))
        out.append((f"a{a}", f"b{b}", f"c{c}", LABELS[(a * b + c) % 3 if r.random() < 0.8 else r.randrange(3)]))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(_rows(3000), "a string, b string, c string, lab string").withColumn("split_hash", F.xxhash64("a", "b", "c")).persist()


def _nodes(spark, model):
    got = forest.node_table(spark, model.stages[-1], []).collect()
    return {(r["tree"], r["node"]): (r["slot"], r["gain"], r["impurity"], tuple(r["stats"])) for r in got}


@pytest.fixture(scope="module")
def model(train):
    m = models.fit(train, CFG, "rf")
    yield m
    models.release(m)


def test_the_forest_is_a_table_and_the_driver_holds_its_top_alone(spark, train, model):
    # before, every level's histograms of all nodes went from every partition, and the whole forest to the driver
    clf = model.stages[-1]
    assert isinstance(clf, deep_forest.DeepForestModel)
    n = clf.nodes().count()
    assert n > 100 and sum(len(top.heap) for top, _, _ in clf.tops()) == CFG.num_trees


@pytest.mark.parametrize("node_rows, checkpoint, parts", [(100, 2, 1), (400, 10, 7), (0, 3, 3)])
def test_same_forest_however_the_nodes_and_rows_are_dealt(spark, train, model, node_rows, checkpoint, parts):
    other = models.fit(train.repartition(parts), CFG.with_(deep_node_rows=node_rows, deep_checkpoint=checkpoint), "rf")
    want, got = _nodes(spark, model), _nodes(spark, other)
    assert want.keys() == got.keys()
    for k, (slot, gain, impurity, stats) in want.items():
        assert (slot, stats) == (got[k][0], got[k][3]) and impurity == pytest.approx(got[k][2], abs=1e-12)
        assert gain == (None if slot is None else pytest.approx(got[k][1], abs=1e-12))
    unseen = train.withColumn("c", F.when(F.col("c") == "c1", "never").otherwise(F.col("c")))
    show = lambda m: sorted(tuple(r) for r in m.transform(unseen).select("a", "b", "c", "lab", "prediction").collect())
    assert show(model) == show(other)
    models.release(other)


def test_shape_and_importances(spark, model):
    nodes = forest.node_table(spark, model.stages[-1], [])
    facts = forest.shape_facts(nodes).first()
    assert tuple(facts) == (CFG.num_trees, True, True)
    assert forest.slot_importances(nodes).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert 5 < model.stages[-1].depth <= CFG.max_depth


def test_predictions_are_the_walks_of_the_nodes(spark, train, model):
    nodes, names = _nodes(spark, model), features.slot_names(model, CFG)
    test = spark.createDataFrame([*_rows(60, 5), ("never", "b1", "c3", "x"), ("never", "never", "never", "y")], "a string, b string, c string, lab string")
    got = model.transform(test).select(
        "a", "b", "c", "prediction", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("raw")
    ).collect()
    assert len(got) == 62
    for r in got:
        has = {f"{f}_vec_{r[f]}" for f in ("a", "b", "c")}
        votes = np.zeros(4)
        for t in range(CFG.num_trees):
            at = 1
            while (slot := nodes[t, at][0]) is not None:
                at = 2 * at + (names[slot] in has)
            stats = np.array(nodes[t, at][3])
            votes += stats / stats.sum()
        assert np.allclose(r["raw"], votes, atol=1e-9) and np.allclose(r["p"], votes / votes.sum(), atol=1e-9)
        assert votes[int(r["prediction"])] == pytest.approx(votes.max(), abs=1e-9)


def test_saved_and_loaded(spark, train, model, tmp_dir):
    model.write().overwrite().save(f"{tmp_dir}/m")
    again = PipelineModel.load(f"{tmp_dir}/m")
    show = lambda m: sorted(tuple(r) for r in m.transform(train).select("a", "b", "c", "lab", "prediction").collect())
    assert show(again) == show(model)
    models.release(again)  # what was saved stays
    assert PipelineModel.load(f"{tmp_dir}/m").stages[-1].nodes().count() > 0


def _plain(space, tree, node, rows, out):
    """The subtree by plain recursion over (x, y, w)."""
    total = Counter()
    for _, y, w in rows:
        total[y] += w
    gini = lambda c: 1 - sum((v / c.total()) ** 2 for v in c.values())
    n, best = total.total(), None
    if node.bit_length() - 1 < space.depth:
        for s in deep_forest.tried_slots(space, tree, np.array([node]))[0]:
            right = Counter()
            for x, y, w in rows:
                if s in x:
                    right[y] += w
            left = total - right
            if left.total() and right.total():
                gain = gini(total) - (left.total() * gini(left) + right.total() * gini(right)) / n
                if gain > 1e-12 and (best is None or gain > best[1] + 1e-12):
                    best = (int(s), gain)
    out[node] = (best[0] if best else -1, best[1] if best else 0.0, [total[k] for k in range(space.classes)])
    if best:
        _plain(space, tree, 2 * node, [r for r in rows if best[0] not in r[0]], out)
        _plain(space, tree, 2 * node + 1, [r for r in rows if best[0] in r[0]], out)
        (a, _, left), (b, _, right) = out[2 * node], out[2 * node + 1]
        if a < 0 and b < 0 and left.index(max(left)) == right.index(max(right)):  # two leaves of one class
            del out[2 * node], out[2 * node + 1]
            out[node] = (-1, 0.0, out[node][2])


@pytest.mark.parametrize("depth", [1, 4, 30])
def test_a_subtree_is_the_plain_recursion(depth):
    r = np.random.default_rng(depth)
    x = np.stack([r.integers(-1, 4, 300), r.choice([-1, 4, 5, 6], 300)], axis=1).astype(np.int32)
    x[:, 0][x[:, 0] > 3] = -1
    y, w = r.integers(0, 3, 300).astype(np.int32), r.integers(1, 4, 300)
    space = deep_forest.Space(np.repeat([0, 1], [4, 3]), 3, 3, depth, 11)
    got = {}
    for heap, slot, gain, impurity, total in deep_forest.grow(space, 2, 1, x, y, w):
        for i, h in enumerate(heap):
            got[int(h)] = (int(slot[i]), gain[i] if slot[i] >= 0 else 0.0, total[i].tolist())
    want = {}
    _plain(space, 2, 1, [({int(v) for v in a if v >= 0}, int(b), int(c)) for a, b, c in zip(x, y, w)], want)
    assert got.keys() == want.keys()
    assert all(got[h][0] == s and got[h][2] == t and got[h][1] == pytest.approx(g, abs=1e-9) for h, (s, g, t) in want.items())


def test_no_two_leaves_of_one_parent_have_the_same_class(spark, train, model):
    for m in (model, other := models.fit(train, CFG.with_(deep_node_rows=30), "rf")):
        nodes = _nodes(spark, m)
        for (t, h), (slot, _, _, _) in nodes.items():
            if slot is not None:
                low = [nodes[t, 2 * h], nodes[t, 2 * h + 1]]
                assert any(x[0] is not None for x in low) or np.argmax(low[0][3]) != np.argmax(low[1][3])
    models.release(other)


def test_tried_slots_are_distinct_and_even():
    space = deep_forest.Space(np.zeros(20, dtype=np.int64), 2, 5, 10, 42)
    got = deep_forest.tried_slots(space, 3, np.arange(1, 20_001))
    assert got.min() == 0 and got.max() == 19 and all(len(set(r)) == 5 for r in got[:2000].tolist())
    share = np.bincount(got.ravel(), minlength=20) / len(got)
    assert np.abs(share - 0.25).max() < 0.02
    assert (got != deep_forest.tried_slots(space, 4, np.arange(1, 20_001))).any()


def test_equal_rows_are_drawn_like_single_ones(spark):
    # n equal rows get a Poisson(n) weight, and single rows Poisson(1)
    rows = spark.range(40_000).select(F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).cast("int").alias("_x0"), F.lit(0).alias("y"))
    got = deep_forest.bootstrap(rows, 1, 8, 42, 4).collect()
    hot = next(r["w"] for r in got if r["_x0"] == 0)
    assert all(abs(w - 10_000) < 600 for w in hot) and len(set(hot)) > 1
    single = np.array([r["w"] for r in got if r["_x0"] != 0])
    assert abs(single.mean() - 1) < 0.01 and abs(single.var() - 1) < 0.03 and abs((single == 0).mean() - np.exp(-1)) < 0.01


def test_few_rows_and_one_class(spark):
    # trees that draw none of the two rows are leaves without counts
    few = spark.createDataFrame([("a1", "b1", "c1", "x"), ("a2", "b1", "c1", "x")], "a string, b string, c string, lab string").withColumn("split_hash", F.lit(1))
    m = models.fit(few, CFG.with_(num_trees=30), "rf")
    assert m.stages[-1].nodes().count() == 30 and m.stages[-1].depth == 0
    assert {r["prediction"] for r in m.transform(few).collect()} == {0.0}
    models.release(m)
