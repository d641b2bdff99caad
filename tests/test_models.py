"""Features and models (H1-H6, I1-I5) and evaluation."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catlens.config import FIXTURE_CONFIG as CFG
from catlens.operators import features, metrics, models
from catlens.plans import job
from catlens.sources.tickets import tickets_raw

from conftest import SF001, SF01

GOLDEN_FEATURES = ("violation_hour_bucket", "segment", "status", "nation", "zone", "color")


@pytest.fixture(scope="module")
def nb_golden(spark):
    cfg = CFG.with_(features=GOLDEN_FEATURES)
    res = job.run(spark, tickets_raw(spark, SF01), cfg, "nb")
    yield res
    res.release()


def test_nb_golden_metrics(nb_golden):
    s = nb_golden.summary
    assert s["accuracy"] == pytest.approx(0.660659, abs=5e-7)
    assert s["f1"] == pytest.approx(0.637923, abs=5e-7)
    assert s["weighted_precision"] == pytest.approx(0.631048, abs=5e-7)
    assert s["weighted_recall"] == pytest.approx(s["accuracy"], abs=1e-12)


def test_nb_golden_per_class(nb_golden):
    got = {r[0]: (round(r[1], 4), r[2]) for r in nb_golden.tables["per_class"].collect()}
    assert got["OTHER"] == (0.8351, 1540)
    assert got["0"] == (0.6274, 518)
    assert got["12"] == (0.0, 107)
    assert sum(n for _, n in got.values()) == 2885


def test_metrics_equal_mllib_evaluator(nb_golden):
    pred = nb_golden.evaluation.predictions
    m = nb_golden.evaluation.metrics.first()
    for name, col in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision"),
                      ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert ev.evaluate(pred) == pytest.approx(m[col], abs=1e-12), name


def test_confusion_total_is_test_rows(nb_golden):
    conf_total = nb_golden.evaluation.confusion.agg(F.sum("n")).first()[0]
    assert conf_total == nb_golden.evaluation.metrics.first()["n_test"] == 2885


def test_one_hot_matches_vector(spark):
    """Unseen categories are zero blocks; slot = offset + index equals the vector."""
    prep = job.prepare(tickets_raw(spark, SF001), CFG)
    train, test = prep.split()
    from pyspark.ml import Pipeline

    fm = Pipeline(stages=features.feature_stages(CFG)).fit(train)
    out = fm.transform(prep.labelled)
    longform = features.one_hot_long(out, fm, CFG, "row_id")
    joins = [d._jdf.queryExecution().optimizedPlan().toString().count("Join") for d in (longform, prep.labelled)]
    assert joins[0] == joins[1]  # those of the fixture view only
    rows = longform.collect()
    names = features.slot_names(fm, CFG)
    n_vocab = len(names)
    keep = []
    vocab = features.category_index_table(features.vocabulary_counts(train, CFG), CFG, keep).collect()
    [release() for release in keep]
    assert sorted((r["slot"], r["slot_name"]) for r in vocab) == list(enumerate(names))
    assert all(names[r["slot"]] == r["slot_name"] for r in rows)
    by_row = {}
    for r in rows:
        by_row.setdefault(r["row_id"], set()).add(r["slot"])
    dense = out.select("row_id", vector_to_array("features").alias("a")).collect()
    assert len(dense[0]["a"]) == n_vocab
    for r in dense:
        active = {i for i, v in enumerate(r["a"]) if v != 0.0}
        assert active == by_row.get(r["row_id"], set())
    # a value never seen in training: all-zero block for that feature
    unseen = prep.labelled.limit(1).withColumn("segment", F.lit("NEVER_SEEN"))
    v = fm.transform(unseen).select(vector_to_array("features").alias("a")).first()["a"]
    seg = [i for i, n in enumerate(names) if n.startswith("segment_vec_")]
    assert all(v[i] == 0.0 for i in seg)
    assert sum(v) == len(CFG.feature_cols) - 1


def test_unseen_label_counts_as_wrong(spark):
    prep = job.prepare(tickets_raw(spark, SF001), CFG)
    train, test = prep.split()
    model = models.fit(train, CFG, "nb")
    test2 = test.limit(5).withColumn(CFG.label_col, F.lit("999"))
    ev = job.evaluate(model, test2, CFG)
    row = ev.metrics.first()
    assert row["n_test"] == 5 and row["accuracy"] == 0.0


@pytest.fixture(scope="module")
def rf_runs(spark):
    raw = tickets_raw(spark, SF001)
    out = {}
    for parts in (1, 3, 8):
        res = job.run(spark, raw.repartition(parts), CFG, "rf", importances_top=None)
        out[parts] = res
    yield out
    for r in out.values():
        r.release()


def test_rf_invariants(rf_runs):
    res = rf_runs[1]
    imp = np.array([r[1] for r in res.tables["importances"].collect()])
    assert (imp >= 0).all() and imp.sum() == pytest.approx(1.0)
    s = res.summary
    assert s["weighted_recall"] == pytest.approx(s["accuracy"], abs=1e-12)
    assert s["num_trees"] == 20 and s["max_depth"] == 8
    mllib = dict(zip(features.slot_names(res.model, CFG), res.model.stages[-1].featureImportances.toArray()))
    got = {r[0]: r[1] for r in res.tables["importances"].collect()}
    assert got.keys() == mllib.keys() and all(abs(got[k] - mllib[k]) < 1e-12 for k in mllib)


def test_rf_deterministic_across_input_partitioning(rf_runs):
    ref = rf_runs[1]
    ref_imp = sorted((r[0], round(r[1], 12)) for r in ref.tables["importances"].collect())
    ref_conf = sorted(tuple(r) for r in ref.evaluation.confusion.collect())
    for parts in (3, 8):
        r = rf_runs[parts]
        assert sorted((x[0], round(x[1], 12)) for x in r.tables["importances"].collect()) == ref_imp
        assert sorted(tuple(x) for x in r.evaluation.confusion.collect()) == ref_conf


def test_summary_row_schema(nb_golden):
    row = nb_golden.tables["summary"].first().asDict()
    assert row["model"] == "nb" and row["rows_used"] == 14238
    assert row["total_seconds"] >= row["train_seconds"] >= 0


def test_per_class_from_rows_equals_confusion_route(nb_golden):
    ev = nb_golden.evaluation
    a = sorted(tuple(r) for r in metrics.per_class_from_predictions(ev.predictions, CFG.label_col).collect())
    b = sorted(tuple(r) for r in ev.per_class.collect())
    assert a == b


def test_cli_runs_on_csv_folder(spark, tmp_dir):
    import os

    from catlens.__main__ import main

    raw = tickets_raw(spark, SF001)
    names = {"code_raw": "Violation Code", "time_raw": "Violation Time", "year_raw": "Vehicle Year"}
    cats = ["Registration State", "Plate Type", "Vehicle Body Type", "Vehicle Make", "Issuing Agency",
            "Violation County", "Vehicle Color", "Unregistered Vehicle?", "Violation Precinct"]
    src = ["nation", "status", "segment", "zone", "priority", "color", "color", "status", "zone"]
    df = raw.select(*[F.col(a).alias(b) for a, b in names.items()], *[F.col(s).alias(c) for s, c in zip(src, cats)])
    path = os.path.join(tmp_dir, "csv")
    df.write.option("header", "true").csv(path)
    out = os.path.join(tmp_dir, "out")
    assert main([path, "--model", "nb", "--out", out]) == 0
    summary = spark.read.parquet(os.path.join(out, "nb", "summary")).first()
    assert summary["rows_used"] == job.prepare(raw, CFG).baseline.first()["n_rows"]
    assert spark.read.parquet(os.path.join(out, "nb", "per_class")).count() > 0


def test_fit_from_counts_equals_mllib_stage_fits(spark):
    prep = job.prepare(tickets_raw(spark, SF01), CFG)
    train, test = prep.split()
    a = models.fit(train, CFG, "nb")
    b = models.fit(train, CFG.with_(fit_from_counts=False), "nb")
    assert features.labels_arrays(a) == features.labels_arrays(b)
    assert np.abs(a.stages[-1].pi.toArray() - b.stages[-1].pi.toArray()).max() < 1e-12
    assert np.abs(a.stages[-1].theta.toArray() - b.stages[-1].theta.toArray()).max() < 1e-12
    pa = sorted(tuple(r) for r in job.evaluate(a, test, CFG).predictions.select("row_id", "predicted_label").collect())
    pb = sorted(tuple(r) for r in job.evaluate(b, test, CFG).predictions.select("row_id", "predicted_label").collect())
    assert pa == pb


def test_vocabulary_counts_is_one_aggregate(spark):
    prep = job.prepare(tickets_raw(spark, SF001), CFG)
    train, _ = prep.split()
    plan = features.vocabulary_counts(train, CFG)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Generate" in plan


def test_vocabulary_with_null_feature_values_matches_mllib(spark):
    """A raw feature with NULLs: NULL is not vocabulary, class totals still count every row."""
    prep = job.prepare(tickets_raw(spark, SF001), CFG)
    train, _ = prep.split()
    train = train.withColumn("segment", F.when(F.col("row_id") % 5 == 0, F.lit(None)).otherwise(F.col("segment")))
    a = models.fit(train, CFG, "nb")
    b = models.fit(train, CFG.with_(fit_from_counts=False), "nb")
    assert features.labels_arrays(a) == features.labels_arrays(b)
    assert np.abs(a.stages[-1].pi.toArray() - b.stages[-1].pi.toArray()).max() < 1e-12
    assert np.abs(a.stages[-1].theta.toArray() - b.stages[-1].theta.toArray()).max() < 1e-12


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_nb_job_independent_of_partitioning(spark, parts):
    raw = tickets_raw(spark, SF001)
    base = job.run(spark, raw, CFG, "nb")
    other = job.run(spark, raw.repartition(parts), CFG, "nb")
    for k in ("rows_used", "majority_baseline", "accuracy", "f1", "weighted_precision", "weighted_recall"):
        assert base.summary[k] == other.summary[k], k
    assert sorted(tuple(r) for r in base.tables["samples"].collect()) == sorted(tuple(r) for r in other.tables["samples"].collect())
    base.release()
    other.release()


def test_model_save_load_roundtrip(spark, tmp_dir):
    import os

    raw = tickets_raw(spark, SF001)
    res = job.run(spark, raw, CFG, "nb")
    path = job.save_model(res.model, os.path.join(tmp_dir, "nb_model"), res.prepared.labeller.top_codes)
    model, codes = job.load_model(spark, path)
    assert codes == res.prepared.labeller.top_codes
    _, test = res.prepared.split()
    a = sorted(tuple(r) for r in job.evaluate(model, test, CFG).predictions.select("row_id", "predicted_label").collect())
    b = sorted(tuple(r) for r in res.evaluation.predictions.select("row_id", "predicted_label").collect())
    assert a == b
    res.release()


def _partitions(df):
    return [list(map(tuple, p)) for p in df.rdd.glom().collect()]


def test_canonical_layout_without_key_spreads_copies(spark):
    """No key: copies share a hash. The layout keeps every row, does not
    depend on the input partitioning, and cuts a hot group into chunks that
    land in several partitions instead of one."""
    from catlens.operators.cleaning import SPLIT_HASH

    cfg = CFG.with_(key_col=None, layout_chunk_rows=5, layout_partitions=8)
    train, _ = job.prepare(tickets_raw(spark, SF001).drop("row_id"), cfg).split()
    # few distinct values -> large groups of identical rows
    df = train.select(cfg.label_col, (F.col(SPLIT_HASH) % 3).alias(SPLIT_HASH), "zone").cache()
    hot = df.groupBy(*df.columns).count().orderBy(F.desc("count"), *df.columns).first()
    hot_row, hot_n = tuple(hot[:3]), hot["count"]
    assert hot_n > 4 * cfg.layout_chunk_rows

    a = models.canonical_layout(df.repartition(1), cfg)
    b = models.canonical_layout(df.repartition(5), cfg)
    assert a.count() == df.count()
    assert a.exceptAll(df).count() == 0 and df.exceptAll(a).count() == 0
    pa, pb = _partitions(a), _partitions(b)
    assert pa == pb and len(pa) == 8
    per_part = [p.count(hot_row) for p in pa]
    assert sum(per_part) == hot_n
    assert sum(1 for n in per_part if n) > 1 and max(per_part) < hot_n
    df.unpersist()


def test_metrics_rules_on_edge_confusion(spark):
    """Class c is predicted but never actual (ignored), class b is actual but
    never predicted (precision 0). Values by hand."""
    lab = CFG.label_col
    conf = spark.createDataFrame(
        [("a", "a", 3), ("a", "c", 1), ("b", "a", 2)], f"{lab} string, predicted_label string, n long"
    )
    s = {r[lab]: r for r in metrics.per_class_scores(conf, lab).collect()}
    assert set(s) == {"a", "b"}
    assert (s["a"]["n_actual"], s["a"]["tp"], s["a"]["n_predicted"]) == (4, 3, 5)
    assert (s["b"]["n_actual"], s["b"]["tp"], s["b"]["n_predicted"]) == (2, 0, 0)
    assert s["b"]["precision"] == 0.0 and s["b"]["f1"] == 0.0
    m = metrics.metrics(conf, lab).first()
    p_a, r_a = 3 / 5, 3 / 4
    f_a = 2 * p_a * r_a / (p_a + r_a)
    assert m["n_test"] == 6 and m["accuracy"] == pytest.approx(3 / 6)
    assert m["weighted_precision"] == pytest.approx(4 / 6 * p_a)
    assert m["weighted_recall"] == pytest.approx(4 / 6 * r_a)
    assert m["f1"] == pytest.approx(4 / 6 * f_a)


def test_layout_is_even_with_hot_rows_and_repeated_keys(spark):
    """One row a third of the table, and a key of few values: no partition above twice the fair share."""
    from catlens.operators.cleaning import SPLIT_HASH

    p = 8
    df = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"), (F.col("id") % 2).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") * 7919).alias(SPLIT_HASH),
    )
    for frame, cfg in ((df.drop("key"), CFG.with_(key_col=None)), (df.withColumn(SPLIT_HASH, F.col("key")), CFG.with_(key_col="key"))):
        cfg = cfg.with_(layout_partitions=p, layout_chunk_rows=100)
        laid = models.canonical_layout(frame, cfg)
        sizes = [len(x) for x in _partitions(laid)]
        assert sum(sizes) == 24_000 and max(sizes) <= 2 * 24_000 / p
        assert laid.exceptAll(frame).count() == 0


def test_both_routes_give_equal_trees(spark):
    cfg = CFG.with_(num_trees=3, max_depth=3, layout_partitions=4)
    train, _ = job.prepare(tickets_raw(spark, SF001), cfg).split()
    a, b = models.fit(train, cfg, "rf"), models.fit(train, cfg.with_(fit_from_counts=False), "rf")
    assert a.stages[-1].toDebugString.split("\n")[1:] == b.stages[-1].toDebugString.split("\n")[1:]


def test_nb_tables_equal_the_fitted_model(spark):
    train, _ = job.prepare(tickets_raw(spark, SF001), CFG).split()
    model = models.fit(train, CFG.with_(fit_from_counts=False), "nb")
    vocab, counts = features.fit_vocabulary(train, CFG)
    keep = []
    priors, thetas = models.nb_parameters(counts, vocab, CFG, keep)
    names, classes = features.slot_names(model, CFG), features.label_names(model)
    pi, theta = model.stages[-1].pi.toArray(), model.stages[-1].theta.toArray()
    got = {r[0]: r[1] for r in priors.collect()}
    assert len(got) == len(classes) and all(abs(got[c] - pi[i]) < 1e-12 for i, c in enumerate(classes))
    cells = {(r[0], r[1]): r[2] for r in thetas.collect()}
    assert len(cells) == theta.size
    assert all(abs(cells[c, n] - theta[i, j]) < 1e-12 for i, c in enumerate(classes) for j, n in enumerate(names))
    assert {r[0]: r[1] for r in features.label_index_table(counts, CFG).collect()} == {c: i for i, c in enumerate(classes)}
    [release() for release in keep]
    counts.unpersist()


def test_slot_names_equal_the_vector_metadata(spark):
    from pyspark.ml import Pipeline

    train, _ = job.prepare(tickets_raw(spark, SF001), CFG).split()
    fm = Pipeline(stages=features.feature_stages(CFG)).fit(train)
    groups = fm.transform(train).schema["features"].metadata["ml_attr"]["attrs"]
    told = {a["idx"]: a["name"] for g in groups.values() for a in g}
    assert [told[i] for i in range(len(told))] == features.slot_names(fm, CFG)


def test_load_model_raises_on_damaged_codes(spark, tmp_dir):
    import os

    train, _ = job.prepare(tickets_raw(spark, SF001), CFG).split()
    path = job.save_model(models.fit(train, CFG, "nb"), os.path.join(tmp_dir, "m"), None, spark)
    assert job.load_model(spark, path)[1] is None
    os.makedirs(path + "_top_codes")
    with open(os.path.join(path + "_top_codes", "part-0.parquet"), "wb") as f:
        f.write(b"no parquet")
    with pytest.raises(Exception):
        job.load_model(spark, path)


def test_both_models_share_one_preparation(spark):
    raw = tickets_raw(spark, SF001)
    prep = job.prepare(raw, CFG, materialize="cache")
    res = [job.run(spark, raw, CFG, k, prepared=prep, started=0.0) for k in ("nb", "rf")]
    assert res[0].prepared is res[1].prepared
    assert {"preview", "top_codes", "confusion"} <= set(res[0].tables)
    assert res[0].summary["run_seconds"] > res[0].summary["total_seconds"]
    for r in res:
        r.release()
    assert prep.cleaned.is_cached
    prep.release()
