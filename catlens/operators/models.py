"""Classifiers on MLlib (I1-I5) and the canonical layout for a reproducible forest."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.operators import deep_forest, splits
from catlens.operators.cleaning import SPLIT_HASH, qcol
from catlens.operators.features import (
    FEATURES,
    LABEL,
    ROWS,
    Vocabulary,
    category_index_table,
    class_counts,
    feature_stages,
    fit_features,
    idx_col,
)
from catlens.operators.forest import fit_memory_mb, named_importances, node_table
from catlens.session import checkpoint_dir


def naive_bayes(cfg: JobConfig) -> NaiveBayes:
    """Multinomial Naive Bayes with additive smoothing (default 1.0)."""
    return NaiveBayes(featuresCol=FEATURES, labelCol=LABEL, modelType="multinomial", smoothing=cfg.smoothing)


def random_forest(cfg: JobConfig, slots: int | None = None, classes: int | None = None) -> RandomForestClassifier:
    """A forest of gini trees (other parameters at MLlib defaults).

    From ``cfg.deep_depth`` on (deep forests fitted from counts are ``deep_forest_model``'s) each row's node is cached and checkpointed every ``cfg.deep_checkpoint`` levels instead of
    sending ever larger trees to the executors, and the node aggregates get memory by the number of slots and classes.
    """
    forest = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=cfg.num_trees, maxDepth=cfg.max_depth, seed=cfg.seed
    )
    if cfg.max_depth < cfg.deep_depth:
        return forest
    return forest.setCacheNodeIds(True).setCheckpointInterval(cfg.deep_checkpoint).setMaxMemoryInMB(fit_memory_mb(slots or 1, classes or cfg.top_n_classes + 1))


def _checkpointed(spark: SparkSession, cfg: JobConfig) -> None:
    """Deep fits checkpoint their node ids to the shared folder."""
    if cfg.max_depth >= cfg.deep_depth and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))


def classifier(cfg: JobConfig, kind: str, slots: int | None = None, classes: int | None = None):
    if kind == "nb":
        return naive_bayes(cfg)
    if kind == "rf":
        return random_forest(cfg, slots, classes)
    raise ValueError(f"unknown model {kind!r}")


def canonical_layout(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """Fixed partitioning and order, so the forest's per-partition bootstrap
    draws do not depend on how the input happened to be split.

    Identical rows are counted (partial aggregation map-side), cut into
    chunks of ``cfg.layout_chunk_rows`` copies, and the chunks are
    hash-partitioned by (split hash, chunk), sorted, and only then expanded
    back to one row per copy inside their partition. The forest sees the
    same rows, a hot group of copies is spread over many partitions, and
    the layout is a function of the data and ``cfg`` alone. The split hash is
    taken over the whole row here, so a repeated key is spread as well.
    """
    if not cfg.canonical_layout:
        return df
    cols = [qcol(c) for c in df.columns]
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    spread = groups.withColumn("_own", F.col(SPLIT_HASH)).withColumn(SPLIT_HASH, F.xxhash64(*cols))
    placed = splits.expand_copies(spread, F.col("_copies"), cfg.layout_partitions, sort=True, chunk_rows=cfg.layout_chunk_rows)
    return placed.withColumn(SPLIT_HASH, F.col("_own")).select(*cols)


def class_slot_counts(counts: DataFrame, vocab: Vocabulary, cfg: JobConfig, keep: list) -> DataFrame:
    """(label, slot, slot_name, n) for every class and slot, 0 where the class never has the value.

    Classes (at most k + 1) are a literal array, so this is classes x slots rows, the size of the model.
    """
    slots = category_index_table(counts, cfg, keep).select("feature", "category", "slot", "slot_name")
    grid = slots.withColumn(cfg.label_col, F.explode(F.array(*[F.lit(lab) for lab in vocab.labels])))
    seen = counts.filter(F.col("feature") != ROWS)
    return grid.join(seen, [cfg.label_col, "feature", "category"], "left").select(
        cfg.label_col, "slot", "slot_name", F.coalesce("n", F.lit(0)).alias("n")
    )


def nb_from_counts(counts: DataFrame, vocab: Vocabulary, cfg: JobConfig):
    """I1 from the sufficient statistics: MLlib NaiveBayes fitted on one
    weighted row per class (weight n_c, features cnt_c / n_c), which gives
    the same class totals and per-slot sums as the full training rows (up to
    one rounding of cnt / n_c * n_c). The class rows are made on the executors
    from the counts; each holds one number per slot, as the model does."""
    keep: list = []
    cells = class_slot_counts(counts, vocab, cfg, keep)
    rows = cells.groupBy(cfg.label_col).agg(F.array_sort(F.collect_list(F.struct("slot", "n"))).alias("cells"))
    index = F.create_map(*[F.lit(x) for i, lab in enumerate(vocab.labels) for x in (lab, float(i))])
    rows = rows.join(class_counts(counts, cfg).withColumnRenamed("n", "w"), cfg.label_col)
    shares = F.transform("cells", lambda x: x["n"] / F.col("w"))
    compact = rows.select(
        F.element_at(index, F.col(cfg.label_col)).alias(LABEL), F.col("w").cast("double").alias("w"), array_to_vector(shares).alias(FEATURES)
    )
    model = naive_bayes(cfg).setWeightCol("w").fit(compact)
    for release in keep:
        release()
    return model


def deep_forest_model(indexed: DataFrame, vocab: Vocabulary, cfg: JobConfig) -> deep_forest.DeepForestModel:
    """I3 from ``cfg.deep_depth`` on: the forest as a table of nodes, with MLlib's split rule (see ``deep_forest``), fitted on indexed rows.

    The caller gives the nodes back with ``release``.
    """
    names, sizes = tuple(idx_col(c) for c in cfg.feature_cols), tuple(len(a) for a in vocab.arrays)
    slots = deep_forest.slot_columns([(qcol(c), n) for c, n in zip(names, sizes)])
    rows = indexed.select(*[x.alias(c) for c, x in slots.items()], F.col(LABEL).cast("int").alias("y"))
    classes = len(vocab.labels) + 1  # and one for labels that training lacks, as in MLlib's label index
    tried = vocab.num_slots if cfg.num_trees == 1 else math.ceil(math.sqrt(vocab.num_slots))
    model = deep_forest.DeepForestModel(None, names, sizes, classes, cfg.num_trees)
    space = deep_forest.Space(model.col, classes, tried, cfg.max_depth, cfg.seed)
    model.path = deep_forest.fit_nodes(rows, space, len(sizes), cfg.num_trees, cfg.layout_partitions, cfg.deep_node_rows, cfg.deep_checkpoint)
    return model


def release(model: PipelineModel) -> None:
    """Give back what a fitted model keeps in the shared folder."""
    for stage in model.stages:
        if isinstance(stage, deep_forest.DeepForestModel):
            stage.release()


def fit(train: DataFrame, cfg: JobConfig, kind: str = "nb", counts: DataFrame | None = None) -> PipelineModel:
    """H5: fit indexers, encoder, assembler and classifier on the training rows.

    Default (``cfg.fit_from_counts``): one distributed aggregation of
    (label, feature, category) counts gives the indexers and, for NB, the
    whole model; the forest then trains on the canonical layout, a deep one as a table of nodes. With
    ``fit_from_counts=False`` MLlib fits every stage itself. ``counts``: persisted vocabulary counts of train, where the caller has them.
    """
    if kind == "rf":
        _checkpointed(train.sparkSession, cfg)
    if not cfg.fit_from_counts:
        if kind == "rf":
            train = canonical_layout(train, cfg)
        return Pipeline(stages=feature_stages(cfg) + [classifier(cfg, kind)]).fit(train)
    feats, vocab, used = fit_features(train, cfg, counts)
    if kind == "nb":
        clf = nb_from_counts(used, vocab, cfg)
    elif kind == "rf" and cfg.max_depth >= cfg.deep_depth:
        clf = deep_forest_model(feats.transform(train), vocab, cfg)
    else:
        clf = classifier(cfg, kind, vocab.num_slots, len(vocab.labels)).fit(feats.transform(canonical_layout(train, cfg)))
    if counts is None:
        used.unpersist()
    return PipelineModel(stages=list(feats.stages) + [clf])


def nb_parameters(counts: DataFrame, vocab: Vocabulary, cfg: JobConfig, keep: list) -> tuple[DataFrame, DataFrame]:
    """I1 as tables from the vocabulary counts: (label, log_prior) and (label, slot_name, theta).

    log_prior = ln(n_c + l) - ln(N + K l); theta = ln(cnt + l) - ln(sum of the class's cnt + D l).
    Nothing is collected: the tables equal the fitted MLlib model's pi and theta. ``keep`` gets what releases the ranked slots.
    """
    lam, lab = cfg.smoothing, cfg.label_col
    total, k, d = sum(vocab.label_n.values()), len(vocab.labels), vocab.num_slots
    priors = class_counts(counts, cfg).select(lab, (F.log(F.col("n") + lam) - F.log(F.lit(total + k * lam))).alias("log_prior"))
    cells = class_slot_counts(counts, vocab, cfg, keep)
    sums = cells.groupBy(lab).agg(F.sum("n").alias("all"))
    theta = F.log(F.col("n") + lam) - F.log(F.col("all") + d * lam)
    return priors, cells.join(sums, lab).select(lab, "slot_name", theta.alias("theta"))


def feature_importances_named(spark: SparkSession, pipeline_model: PipelineModel, slots: DataFrame, keep: list, top: int | None = 10) -> DataFrame:
    """(feature_name, importance) of the forest's one-hot slots (slot, slot_name), biggest first, ties by name.

    Aggregated from the forest's node table and joined with the slot names; no row is made on the driver. ``keep`` gets what
    deletes the node table. ``top`` None: every slot.
    """
    return named_importances(node_table(spark, pipeline_model.stages[-1], keep), slots.select("slot", "slot_name"), top)
