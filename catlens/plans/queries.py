"""The query catalogue: one Spark query per operator group of the job.

Each query takes ``(spark, sf_dir)``, reads the whole ``tickets_raw`` fixture
(derived from the ``orders``, ``customer`` and ``nation`` tables in
``sf_dir``) and returns a DataFrame whose columns match the oracle SQL in
``catlens.plans.oracle``.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.config import FIXTURE_CONFIG, JobConfig
from catlens.functions import year_bucket
from catlens.operators import cleaning, features, forest, joined, labels, metrics, models, report, splits
from catlens.plans import job
from catlens.session import delete_path, scratch_path
from catlens.sources.committed import read_committed, write_committed
from catlens.sources.csv_dir import read_csv_dir, write_csv_dir, write_parquet
from catlens.sources.tickets import tickets_raw

CFG: JobConfig = FIXTURE_CONFIG
# The row that _copies repeats.
COPY_VALUES = {
    "code_raw": "7", "time_raw": "0930A", "year_raw": "2001", "segment": "HOT", "zone": "Z0",
    "color": "C0", "status": "O", "priority": "1-URGENT", "nation": "CHINA",
}
# Fixture variants: a wide skewed category whose rare values are unseen in training, alone and with the others.
MANY = CFG.with_(categorical_cols=(*CFG.categorical_cols, "maker"))
MANY_ONLY = MANY.with_(features=("maker",))
# The local twin's depth.
DEEP = CFG.with_(max_depth=20)
# A forest that is one best gini split, which SQL can compute.
STUMP = CFG.with_(num_trees=1, max_depth=1)
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]

# What the last query cached or wrote; its result reads them lazily, so they go when the next query starts.
_HELD: list[Callable[[], None]] = []


def _start(spark: SparkSession) -> None:
    """Release what the last query left; name a shared folder where the session has none (single process only)."""
    while _HELD:
        with contextlib.suppress(Py4JError):  # the last query's session may have been stopped
            _HELD.pop()()
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="catlens-"))


def _prepared(spark: SparkSession, sf_dir: str, cfg: JobConfig = CFG, raw: DataFrame | None = None) -> job.Prepared:
    """The cached route of the job: one scan of the source."""
    prep = job.prepare(tickets_raw(spark, sf_dir) if raw is None else raw, cfg, materialize="cache")
    _HELD.append(prep.release)
    return prep


def _fitted(spark: SparkSession, sf_dir: str, kind: str, cfg: JobConfig = CFG, raw: DataFrame | None = None, counts: list | None = None):
    """Prepared rows, split and the fitted model (fit on the training rows); counts, if a list, gets the vocabulary counts."""
    prep = _prepared(spark, sf_dir, cfg, raw)
    train, test = prep.split()
    own = None
    if counts is not None:
        own = features.vocabulary_counts(train, cfg).persist()
        _HELD.append(own.unpersist)
        counts.append(own)
    model: PipelineModel = models.fit(train, cfg, kind, own)
    _HELD.append(lambda: models.release(model))
    return prep, train, test, model


def _many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tickets_raw with maker: thousands of values, the low ones frequent, many that occur once."""
    k = F.col("row_id")
    return tickets_raw(spark, sf_dir).withColumn("maker", F.concat(F.lit("M"), ((k * 7919) % (1 + (k * 31) % 5003)).cast("string")))


def _r(c, name):
    return F.round(c, DIGITS).alias(name)


# ---- A: sources ---------------------------------------------------------


def q_preview(spark, sf_dir):
    """A3: the first five rows by key."""
    return cleaning.preview(tickets_raw(spark, sf_dir), 5, order_by="row_id")


def q_select_needed(spark, sf_dir):
    """B1: the needed columns of every row."""
    return cleaning.select_needed(tickets_raw(spark, sf_dir), CFG.needed_cols)


def q_csv_roundtrip(spark, sf_dir):
    """A1 + A2 + A4: every row written as a CSV folder in the shared scratch
    folder and read back, all columns strings; NULLs and blanks stay apart."""
    path = scratch_path(spark, "tickets-csv")
    _HELD.append(lambda: delete_path(spark, path))
    return read_csv_dir(spark, write_csv_dir(tickets_raw(spark, sf_dir), path))


def q_parquet_sink(spark, sf_dir):
    """A4: a report written to the Parquet sink and read back."""
    path = scratch_path(spark, "report")
    _HELD.append(lambda: delete_path(spark, path))
    return spark.read.parquet(write_parquet(_prepared(spark, sf_dir).counts, path))


# ---- B, C: parsing and cleaning ------------------------------------------


def q_lenient_int(spark, sf_dir):
    """B2 on every row (NULL where the code does not parse)."""
    raw = tickets_raw(spark, sf_dir)
    from catlens.functions import lenient_int

    return raw.select("row_id", "code_raw", lenient_int("code_raw").alias("violation_code"))


def q_usable_rows(spark, sf_dir):
    """B3 + E2: rows whose code parsed."""
    return cleaning.clean(tickets_raw(spark, sf_dir), CFG).agg(F.count(F.lit(1)).alias("n_rows"))


def q_time_buckets(spark, sf_dir):
    """Usable rows per time-of-day bucket."""
    c = cleaning.clean(tickets_raw(spark, sf_dir), CFG)
    return c.groupBy(CFG.hour_bucket_out).agg(F.count(F.lit(1)).alias("n"))


def q_year_buckets(spark, sf_dir):
    """All rows per vehicle-year bucket."""
    raw = tickets_raw(spark, sf_dir)
    return raw.groupBy(year_bucket("year_raw", CFG.current_year).alias(CFG.year_bucket_out)).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_clean_categories(spark, sf_dir):
    """C3 + B4: usable rows per (feature, cleaned value)."""
    c = cleaning.clean(tickets_raw(spark, sf_dir), CFG)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in CFG.categorical_cols])
    return c.select(F.inline(pairs)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def q_cleaned_rows(spark, sf_dir):
    """B1-B5 + C1-C3: every usable row, cleaned."""
    c = cleaning.clean(tickets_raw(spark, sf_dir), CFG)
    return c.select("row_id", CFG.code_out, CFG.hour_bucket_out, CFG.year_bucket_out, *CFG.categorical_cols)


# ---- D, E, F: labels and counts ------------------------------------------


def q_code_frequency(spark, sf_dir):
    """Usable rows per code."""
    return labels.code_frequency(cleaning.clean(tickets_raw(spark, sf_dir), CFG), CFG.code_out)


def q_top_codes(spark, sf_dir):
    """D1 + F1 + F2: the eight most frequent codes."""
    freq = labels.code_frequency(cleaning.clean(tickets_raw(spark, sf_dir), CFG), CFG.code_out)
    return labels.top_k_values(freq, CFG.code_out, CFG.top_n_classes)


def q_labelled(spark, sf_dir):
    """D2 + B5-B7: every usable row with its class label."""
    return _prepared(spark, sf_dir).labelled.select("row_id", CFG.code_out, CFG.label_col)


def q_label_counts(spark, sf_dir):
    """E1 per label."""
    return _prepared(spark, sf_dir).counts


def q_majority_baseline(spark, sf_dir):
    """Usable rows, biggest class and the constant-guess accuracy."""
    b = _prepared(spark, sf_dir).baseline
    return b.select("n_rows", "top_class_count", _r(F.col("majority_baseline"), "majority_baseline"))


# ---- G: splits -------------------------------------------------------------


def _side_counts(assigned: DataFrame) -> DataFrame:
    side = F.when(F.col(splits.IS_TEST), splits.TEST).otherwise(splits.TRAIN)
    return assigned.groupBy(CFG.label_col, side.alias("split")).agg(F.count(F.lit(1)).alias("n"))


def q_split_hash_counts(spark, sf_dir):
    """G1: rows per (label, side) of the 80/20 hash split."""
    return _side_counts(_prepared(spark, sf_dir).assign())


def q_split_fraction_small_counts(spark, sf_dir):
    """G1: a test share below one percent (0.4 %)."""
    return _side_counts(_prepared(spark, sf_dir, CFG.with_(test_fraction=0.004)).assign())


def _null_keys(spark, sf_dir):
    """tickets_raw with every third key NULL."""
    return tickets_raw(spark, sf_dir).withColumn("row_id", F.when(F.col("row_id") % 3 != 0, F.col("row_id")))


def q_split_hash_nullkey_counts(spark, sf_dir):
    """G1: a NULL key is hashed by the row's content; no row is lost."""
    return _side_counts(_prepared(spark, sf_dir, raw=_null_keys(spark, sf_dir)).assign())


def q_split_stratified_nullkey_counts(spark, sf_dir):
    """The exact quota per label with every third key NULL."""
    return _side_counts(_prepared(spark, sf_dir, CFG.with_(split="stratified"), _null_keys(spark, sf_dir)).assign())


def _copies(spark, sf_dir):
    """tickets_raw without a key, a third of the rows copies of one row."""
    raw = tickets_raw(spark, sf_dir)
    hot = F.col("row_id") % 3 == 0
    own = {c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in COPY_VALUES.items()}
    return raw.withColumns(own).drop("row_id")


def q_split_keyless_copies_counts(spark, sf_dir):
    """G1 without a key: copies of a row are shared out, so one hot row keeps the 80/20 share."""
    return _side_counts(_prepared(spark, sf_dir, CFG.with_(key_col=None), _copies(spark, sf_dir)).assign())


def q_split_stratified_counts(spark, sf_dir):
    """Rows per (label, side) of the exact stratified split."""
    return _side_counts(_prepared(spark, sf_dir, CFG.with_(split="stratified")).assign())


def q_split_stratified_copies_counts(spark, sf_dir):
    """G2 without a key, a third of the rows copies of one row: the exact quota per label."""
    return _side_counts(_prepared(spark, sf_dir, CFG.with_(key_col=None, split="stratified"), _copies(spark, sf_dir)).assign())


def q_sink_retry(spark, sf_dir):
    """A4: a first attempt that dies in a task, one that dies before its commit, then a retry; the committed result, read back."""
    path = scratch_path(spark, "committed")
    _HELD.append(lambda: delete_path(spark, path))
    rows = cleaning.select_needed(tickets_raw(spark, sf_dir), CFG.needed_cols)
    torn = rows.withColumn("color", F.when(F.col("row_id") % 1000 == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("color")))
    with contextlib.suppress(Py4JError, PySparkException):
        write_committed(torn, path, "tickets")
    rows.limit(10).write.parquet(f"{path}/attempt-without-commit")
    write_committed(rows, path, "tickets")
    write_committed(rows.limit(1), path, "tickets")  # a retry after the commit changes nothing
    return read_committed(spark, path)


def q_split_random_counts(spark, sf_dir):
    """G1 as the original job does it: seeded randomSplit. Which rows fall on
    a side depends on the layout, so the rows per label of both sides together are returned."""
    train, test = _prepared(spark, sf_dir, CFG.with_(split="random")).split()
    return train.unionByName(test).groupBy(CFG.label_col).agg(F.count(F.lit(1)).alias("n"))


def q_label_counts_checkpointed(spark, sf_dir):
    """The cleaned rows written as a reliable checkpoint (lineage cut),
    then counted per label."""
    prep = job.prepare(tickets_raw(spark, sf_dir), CFG, materialize="checkpoint")
    _HELD.append(prep.release)
    return prep.labelled.groupBy(CFG.label_col).agg(F.count(F.lit(1)).alias("count"))


def q_split_stratified_rows(spark, sf_dir):
    """The test rows of the stratified split (row ids)."""
    _, test = _prepared(spark, sf_dir, CFG.with_(split="stratified")).split()
    return test.select("row_id", CFG.label_col)


# ---- H: features ------------------------------------------------------------


def _vocabulary(spark, sf_dir, cfg=CFG, raw=None):
    """Vocabulary and its counts over the training rows."""
    train, _ = _prepared(spark, sf_dir, cfg, raw).split()
    vocab, counts = features.fit_vocabulary(train, cfg)
    _HELD.append(counts.unpersist)
    return vocab, counts


def q_category_index(spark, sf_dir):
    """H1 + H3: fitted vocabulary with index and slot position."""
    return features.category_index_table(_vocabulary(spark, sf_dir)[1], CFG, _HELD)


def q_category_index_many(spark, sf_dir):
    """H1 + H3 with a wide, skewed category."""
    return features.category_index_table(_vocabulary(spark, sf_dir, MANY, _many(spark, sf_dir))[1], MANY, _HELD)


def q_label_index(spark, sf_dir):
    """H4: label -> index (training frequency, ties by name)."""
    return features.label_index_table(_vocabulary(spark, sf_dir)[1], CFG)


def _one_hot(spark, sf_dir, cfg=CFG, raw=None):
    prep = _prepared(spark, sf_dir, cfg, raw)
    fm, _, counts = features.fit_features(prep.split()[0], cfg)
    _HELD.append(counts.unpersist)
    return features.one_hot_long(features.apply_indexers(fm, prep.labelled), fm, cfg, "row_id")


def q_one_hot_long(spark, sf_dir):
    """H1-H3 applied to every usable row: its active one-hot slots."""
    return _one_hot(spark, sf_dir)


def q_one_hot_long_many(spark, sf_dir):
    """H1-H3 with values that training lacks: their blocks are all zero."""
    return _one_hot(spark, sf_dir, MANY, _many(spark, sf_dir))


def _joined(spark, sf_dir, cfg=CFG, raw=None):
    """Numbered rows of all sides and the bucketed vocabulary of the training rows."""
    prep = _prepared(spark, sf_dir, cfg, raw)
    counts = features.vocabulary_counts(prep.split()[0], cfg)
    return joined.numbered(prep.labelled, _HELD), joined.vocabulary_table(counts, cfg, _HELD)


def q_one_hot_long_joined(spark, sf_dir):
    """H1-H3 by a join with the vocabulary table: nothing of its size on the driver."""
    rows, table = _joined(spark, sf_dir, MANY, _many(spark, sf_dir))
    found = joined.one_hot_long_joined(rows, table, MANY, _HELD)
    return rows.select(joined.ROW, "row_id").join(found, joined.ROW).select("row_id", "feature", "slot", "slot_name")


def q_one_hot_sparse(spark, sf_dir):
    """H2 + H3: the sparse vector of every usable row (size, active slots as text, their sum)."""
    rows, table = _joined(spark, sf_dir, MANY_ONLY, _many(spark, sf_dir))
    vectors = joined.sparse_vectors(rows, table, MANY_ONLY, _HELD)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return rows.select(joined.ROW, "row_id").join(vectors, joined.ROW).select("row_id", "size", F.concat_ws(",", "indices").alias("slots"), total.alias("total"))


# ---- I, J: Naive Bayes ---------------------------------------------------------


def _nb(spark, sf_dir, cfg=CFG, raw=None):
    prep, train, test, model = _fitted(spark, sf_dir, "nb", cfg, raw)
    return prep, model, job.evaluate(model, test, cfg)


def q_nb_priors(spark, sf_dir):
    """Class log-priors (smoothed)."""
    vocab, counts = _vocabulary(spark, sf_dir)
    return models.nb_parameters(counts, vocab, CFG, _HELD)[0].select(CFG.label_col, _r(F.col("log_prior"), "log_prior"))


def q_nb_model(spark, sf_dir):
    """Per (class, slot) log-likelihoods."""
    vocab, counts = _vocabulary(spark, sf_dir)
    return models.nb_parameters(counts, vocab, CFG, _HELD)[1].select(CFG.label_col, "slot_name", _r(F.col("theta"), "theta"))


def q_nb_predictions(spark, sf_dir):
    """I2 + H6: predicted class of every test row."""
    _, _, ev = _nb(spark, sf_dir)
    return ev.predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def q_nb_predictions_many(spark, sf_dir):
    """I2 with unseen values among others."""
    _, _, ev = _nb(spark, sf_dir, MANY, _many(spark, sf_dir))
    return ev.predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def q_nb_predictions_unseen(spark, sf_dir):
    """I2 where the only feature is often unseen: such rows get the largest class."""
    _, _, ev = _nb(spark, sf_dir, MANY_ONLY, _many(spark, sf_dir))
    return ev.predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def _nb_sparse(spark, sf_dir, cfg=CFG, raw=None):
    train, test = _prepared(spark, sf_dir, cfg, raw).split()
    counts = features.vocabulary_counts(train, cfg).persist()
    _HELD.append(counts.unpersist)
    model = joined.SparseNaiveBayes(counts, cfg, _HELD)
    return model.predict(joined.numbered(test, _HELD)).select("row_id", cfg.label_col, features.PREDICTED_LABEL)


def q_nb_predictions_sparse(spark, sf_dir):
    """I1 + I2 by joins: a gain per seen (class, slot), a default per class."""
    return _nb_sparse(spark, sf_dir)


def q_nb_predictions_sparse_many(spark, sf_dir):
    """I2 by joins with a wide category, many of its values unseen."""
    return _nb_sparse(spark, sf_dir, MANY, _many(spark, sf_dir))


def q_nb_predictions_sparse_unseen(spark, sf_dir):
    """I2 by joins where rows often have no known value at all."""
    return _nb_sparse(spark, sf_dir, MANY_ONLY, _many(spark, sf_dir))


def q_nb_predictions_reloaded(spark, sf_dir):
    """H5: the model saved, loaded and applied to the test rows."""
    prep, train, test, model = _fitted(spark, sf_dir, "nb")
    path = scratch_path(spark, "model")
    _HELD.append(lambda: [delete_path(spark, x) for x in (path, path + "_top_codes")])
    loaded, codes = job.load_model(spark, job.save_model(model, path, prep.labeller.top_codes, spark))
    again = labels.lump_other(test.drop(CFG.label_col), CFG.code_out, CFG.label_col, codes)
    return job.evaluate(loaded, again, CFG).predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def q_nb_confusion(spark, sf_dir):
    """(actual, predicted, n) over the test rows."""
    return _nb(spark, sf_dir)[2].confusion


def _rounded_metrics(m: DataFrame) -> DataFrame:
    return m.select(
        "n_test",
        *[_r(F.col(c), c) for c in ("accuracy", "f1", "weighted_precision", "weighted_recall")],
    )


def q_nb_metrics(spark, sf_dir):
    """Accuracy, weighted F1 / precision / recall."""
    return _rounded_metrics(_nb(spark, sf_dir)[2].metrics)


def _rounded_per_class(p: DataFrame) -> DataFrame:
    return p.select(CFG.label_col, _r(F.col("class_accuracy"), "class_accuracy"), "n_test_examples")


def q_nb_per_class(spark, sf_dir):
    """J6 + E5 + B8 + B9: per-class accuracy and test rows."""
    return _rounded_per_class(_nb(spark, sf_dir)[2].per_class)


def q_nb_per_class_rows(spark, sf_dir):
    """J6 the row-level way: avg of the per-row correct flag (B8) and count."""
    _, _, ev = _nb(spark, sf_dir)
    return _rounded_per_class(metrics.per_class_from_predictions(ev.predictions, CFG.label_col))


def q_nb_samples(spark, sf_dir):
    """First 20 test rows by key with display columns and prediction."""
    return _nb(spark, sf_dir)[2].samples


def _summary(spark, sf_dir, kind):
    prep = _prepared(spark, sf_dir)
    cleaning.require_rows(prep.baseline.first()["n_rows"] or 0)
    train, test = prep.split()
    ev = job.evaluate(models.fit(train, CFG, kind), test, CFG)
    return report.summary_long(prep.baseline, ev.metrics, DIGITS)


def q_run_summary_nb(spark, sf_dir):
    """J8 + B10 (without timings): rows used, baseline and metrics."""
    return _summary(spark, sf_dir, "nb")


# ---- I3-I5: forest -------------------------------------------------------------


def _rf(spark, sf_dir, cfg=CFG):
    prep, train, test, model = _fitted(spark, sf_dir, "rf", cfg)
    return prep, model, job.evaluate(model, test, cfg)


def _rf_importances(spark, sf_dir, top, cfg=CFG):
    """Model, evaluation and importances of every slot or the top ones."""
    counts: list = []
    _, _, test, model = _fitted(spark, sf_dir, "rf", cfg, counts=counts)
    slots = features.category_index_table(counts[0], cfg, _HELD)
    return model, job.evaluate(model, test, cfg), models.feature_importances_named(spark, model, slots, _HELD, top)


def q_rf_metrics(spark, sf_dir):
    return _rounded_metrics(_rf(spark, sf_dir)[2].metrics)


def q_rf_per_class(spark, sf_dir):
    return _rounded_per_class(_rf(spark, sf_dir)[2].per_class)


def q_rf_confusion(spark, sf_dir):
    return _rf(spark, sf_dir)[2].confusion


def q_rf_importances_top10(spark, sf_dir):
    return _rf_importances(spark, sf_dir, 10)[2]


def q_rf_predictions(spark, sf_dir):
    """I4: predicted class of every test row."""
    return _rf(spark, sf_dir)[2].predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def q_rf_samples(spark, sf_dir):
    """J7 for the forest."""
    return _rf(spark, sf_dir)[2].samples


def q_run_summary_rf(spark, sf_dir):
    """J8 for the forest, with its trees and depth."""
    size = F.array(*[F.struct(F.lit(n).alias("metric"), F.lit(float(v)).alias("value")) for n, v in (("num_trees", CFG.num_trees), ("max_depth", CFG.max_depth))])
    return _summary(spark, sf_dir, "rf").unionByName(spark.range(1).select(F.inline(size)))


def q_rf_facts(spark, sf_dir):
    """What holds for every forest exactly: test rows, importances that add up to one, one slot per
    category, weighted recall equal to accuracy."""
    _, ev, importances = _rf_importances(spark, sf_dir, None)
    total = importances.agg(F.round(F.sum("importance"), DIGITS).alias("importance_sum"), F.count(F.lit(1)).alias("n_slots"))
    m = ev.metrics.select("n_test", (F.abs(F.col("weighted_recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"))
    return m.withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").drop("one")


def q_rf_deep_facts(spark, sf_dir):
    """I3 at depth 20 (cached node ids, checkpoints): test rows, trees, depth between 9 and 20, class counts of children
    that add up at every node, leaves = inner nodes + trees, importances that add up to one over all slots."""
    model, ev, importances = _rf_importances(spark, sf_dir, None, DEEP)
    depth = model.stages[-1].depth
    shape = forest.shape_facts(forest.node_table(spark, model.stages[-1], _HELD)).withColumn("one", F.lit(1))
    total = importances.agg(F.round(F.sum("importance"), DIGITS).alias("importance_sum"), F.count(F.lit(1)).alias("n_slots"))
    out = ev.metrics.select("n_test", F.lit(1).alias("one"), F.lit(9 <= depth <= DEEP.max_depth).alias("depth_9_to_20")).join(shape, "one")
    return out.join(total.withColumn("one", F.lit(1)), "one").drop("one")


def q_rf_test_rows(spark, sf_dir):
    """I4: test rows per actual class that the forest judged."""
    return _rf(spark, sf_dir)[2].per_class.select(CFG.label_col, "n_test_examples")


def _stump(spark, sf_dir):
    """One tree of one split on all rows and all features, the best gini split: model, test rows, node table and slots."""
    prep = _prepared(spark, sf_dir, STUMP)
    train, test = prep.split()
    feats, _, counts = features.fit_features(train, STUMP)
    _HELD.append(counts.unpersist)
    tree = models.random_forest(STUMP).setBootstrap(False).setFeatureSubsetStrategy("all")
    clf = tree.fit(feats.transform(models.canonical_layout(train, STUMP)))
    slots = features.category_index_table(counts, STUMP, _HELD).select("slot", "slot_name")
    return PipelineModel(stages=[*feats.stages, clf]), test, forest.node_table(spark, clf, _HELD), slots


def q_rf_stump_split(spark, sf_dir):
    """The slot of the one split, its impurity and its gain, from the node table."""
    _, _, nodes, slots = _stump(spark, sf_dir)
    return nodes.filter("slot is not null").join(slots, "slot").select("slot_name", _r(F.col("impurity"), "impurity"), _r(F.col("gain"), "gain"))


def q_rf_stump_predictions(spark, sf_dir):
    """I4: the stump's class of every test row."""
    model, test, _, _ = _stump(spark, sf_dir)
    return job.evaluate(model, test, STUMP).predictions.select("row_id", CFG.label_col, features.PREDICTED_LABEL)


def q_rf_stump_importances(spark, sf_dir):
    """The split's slot has importance one, all others zero."""
    _, _, nodes, slots = _stump(spark, sf_dir)
    return forest.named_importances(nodes, slots, None)


def _query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _start(spark)
        return f(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {name[2:]: _query(f) for name, f in list(globals().items()) if name.startswith("q_")}
