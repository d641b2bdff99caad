"""The whole job: messy table in, model and report tables out.

Data passes (with ``materialize="cache"``):
  1. source scan -> clean -> cache, while the per-code counts are aggregated
     (the top-k codes, row count and baseline all come from these counts);
  2. one indexer pass over the cached training rows (all features + label);
  3. the model fit (NB: one aggregate; forest: MLlib's per-level passes);
  4. one pass over the test rows into the confusion table, plus a top-20
     for the sample. Metrics and the per-class report use the tiny confusion table.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from catlens.config import JobConfig
from catlens.operators import cleaning, features, labels, metrics, models, report, splits
from catlens.session import delete_path, path_exists, scratch_path


@dataclass
class Prepared:
    """Cleaned and labelled rows plus the label statistics."""

    cfg: JobConfig
    cleaned: DataFrame
    labelled: DataFrame
    labeller: labels.Labeller
    counts: DataFrame
    baseline: DataFrame
    written: str | None = None

    def _max_label_rows(self) -> int | None:
        return self.counts.agg({"count": "max"}).first()[0] if self.cfg.split == "stratified" else None

    def assign(self) -> DataFrame:
        """The labelled rows with the split's side (hash and stratified)."""
        return splits.assign(self.labelled, self.cfg, self._max_label_rows())

    def split(self) -> tuple[DataFrame, DataFrame]:
        return splits.split(self.labelled, self.cfg, self._max_label_rows())

    def release(self) -> None:
        """Give back what was cached; delete what was checkpointed."""
        self.cleaned.unpersist()
        self.labeller.freq.unpersist()
        if self.written:
            delete_path(self.cleaned.sparkSession, self.written)


def prepare(df: DataFrame, cfg: JobConfig, materialize: str = "none") -> Prepared:
    """A-D: clean, (optionally) persist, count codes once, label."""
    cleaned = cleaning.clean(df, cfg)
    if materialize == "cache":
        # Filled by the first action below (the code counts); no extra pass.
        cleaned = cleaned.persist(StorageLevel.MEMORY_AND_DISK)
    written = None
    if materialize == "checkpoint":
        written = scratch_path(df.sparkSession, "cleaned")
        cleaned = splits.materialize(cleaned, "checkpoint", written)
    lab = labels.Labeller(cfg).fit(cleaned)
    counts = lab.label_counts()
    return Prepared(cfg, cleaned, lab.transform(cleaned), lab, counts, labels.majority_baseline(counts), written)


@dataclass
class Evaluation:
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    per_class: DataFrame
    samples: DataFrame


def evaluate(model: PipelineModel, test: DataFrame, cfg: JobConfig, persist: bool = False) -> Evaluation:
    """I2/I4 + H6 + J1-J7."""
    pred = features.index_to_label(model, model.transform(test))
    conf = metrics.confusion(pred, cfg.label_col)
    if persist:
        conf = conf.persist(StorageLevel.MEMORY_AND_DISK)  # (classes x classes) rows
    return Evaluation(
        predictions=pred,
        confusion=conf,
        metrics=metrics.metrics(conf, cfg.label_col),
        per_class=metrics.per_class_report(conf, cfg.label_col),
        samples=report.sample_predictions(model, test, cfg),
    )


@dataclass
class JobResult:
    model: PipelineModel
    prepared: Prepared
    evaluation: Evaluation
    summary: dict
    tables: dict[str, DataFrame] = field(default_factory=dict)
    owns_prepared: bool = True
    keep: list = field(default_factory=list)

    def release(self) -> None:
        self.evaluation.confusion.unpersist()
        while self.keep:
            self.keep.pop()()
        if self.owns_prepared:
            self.prepared.release()


def run(
    spark: SparkSession, df: DataFrame, cfg: JobConfig, kind: str = "nb", importances_top: int = 10,
    prepared: Prepared | None = None, started: float | None = None,
) -> JobResult:
    """Run the job on ``df`` and return the model and the report tables.

    ``prepared`` (from ``prepare``) is used instead of preparing ``df`` again, so that
    several models share one scan; the caller releases it. ``started`` is
    when the whole run began (session start included), for its total seconds.
    """
    t0 = time.time()
    prep = prepared or prepare(df, cfg, materialize=cfg.materialize)
    n_rows, _, baseline = prep.baseline.first()
    cleaning.require_rows(n_rows or 0)
    train, test = prep.split()
    prep_s = time.time() - t0

    t1 = time.time()
    # the forest's slot names come from the same counts as its indexers
    keep: list = []
    counts = None
    if kind == "rf":
        counts = features.vocabulary_counts(train, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        keep.append(counts.unpersist)
    model = models.fit(train, cfg, kind, counts)
    keep.append(lambda: models.release(model))
    train_s = time.time() - t1

    ev = evaluate(model, test, cfg, persist=True)
    m = ev.metrics.first().asDict()
    total_s = time.time() - t0

    summary = {
        "model": kind,
        "rows_used": int(n_rows),
        "num_trees": cfg.num_trees if kind == "rf" else None,
        "max_depth": cfg.max_depth if kind == "rf" else None,
        "majority_baseline": float(baseline),
        "prep_seconds": prep_s,
        "train_seconds": train_s,
        "total_seconds": total_s,
        "run_seconds": time.time() - (started if started is not None else t0),
        "accuracy": m["accuracy"],
        "f1": m["f1"],
        "weighted_precision": m["weighted_precision"],
        "weighted_recall": m["weighted_recall"],
    }
    tables = {
        "summary": report.summary_row(spark, summary),
        "metrics": ev.metrics,
        "per_class": ev.per_class,
        "samples": ev.samples,
        "label_counts": prep.counts,
        "top_codes": prep.labeller.top_table(),
        "confusion": ev.confusion,
        "preview": cleaning.preview(prep.labelled.drop(cleaning.SPLIT_HASH), 5, order_by=cfg.key_col),
    }
    if kind == "rf":
        slots = features.category_index_table(counts, cfg, keep)
        tables["importances"] = models.feature_importances_named(spark, model, slots, keep, importances_top)
    return JobResult(model, prep, ev, summary, tables, owns_prepared=prepared is None, keep=keep)


def save_model(model: PipelineModel, path: str, top_codes: list[int] | None = None, spark: SparkSession | None = None) -> str:
    """H5 persistence: the fitted stages (MLlib's own format), plus the top
    codes that define the labels, so a later job can score new rows."""
    model.write().overwrite().save(path)
    if top_codes is not None:
        spark = spark or SparkSession.builder.getOrCreate()
        spark.createDataFrame([(int(c),) for c in top_codes], "code int").coalesce(1).write.mode("overwrite").parquet(
            path.rstrip("/") + "_top_codes"
        )
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[int] | None]:
    """The saved stages and top codes (None if the model was saved without codes; any other fault raises)."""
    model = PipelineModel.load(path)
    codes = path.rstrip("/") + "_top_codes"
    if not path_exists(spark, codes):
        return model, None
    return model, [r[0] for r in spark.read.parquet(codes).collect()]


def run_csv(spark: SparkSession, path: str, cfg: JobConfig | None = None, kind: str = "nb") -> JobResult:
    """The original job's entry: a CSV folder of ticket rows (A1, A2)."""
    from catlens.sources.csv_dir import read_csv_dir

    return run(spark, read_csv_dir(spark, path), cfg or JobConfig(), kind)
