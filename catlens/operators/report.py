"""Reports: sample predictions and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catlens.config import JobConfig
from catlens.operators.cleaning import SPLIT_HASH, qcol
from catlens.operators.features import PREDICTED_LABEL


def sample_columns(cfg: JobConfig) -> list[str]:
    return list(cfg.sample_cols) + [cfg.hour_bucket_out, cfg.label_col, PREDICTED_LABEL]


def _sample_order(cfg: JobConfig) -> list:
    order = [qcol(cfg.key_col)] if cfg.key_col is not None else [F.col(SPLIT_HASH)]
    # the label and display columns make the order total when there is no key
    return order + [qcol(c) for c in [cfg.label_col, *cfg.sample_cols, cfg.hour_bucket_out]]


def sample_predictions(model, test: DataFrame, cfg: JobConfig, n: int = 20) -> DataFrame:
    """The first ``n`` test rows by key with their display columns and
    prediction. The rows are picked first (a per-partition top-n over the
    cleaned columns, then an n-row merge), and only those n rows go through
    the model, not the whole test set."""
    from catlens.operators.features import index_to_label

    picked = test.orderBy(*_sample_order(cfg)).limit(n)
    pred = index_to_label(model, model.transform(picked))
    cols = ([cfg.key_col] if cfg.key_col is not None else []) + sample_columns(cfg)
    return pred.orderBy(*_sample_order(cfg)).select(*[qcol(c) for c in cols])


def summary_long(baseline: DataFrame, metric_row: DataFrame, digits: int | None = 6) -> DataFrame:
    """J8 without timings, as (metric, value) rows; lazily derived from the
    one-row baseline and metrics tables (a union, no join)."""

    def r(c):
        return F.round(c, digits) if digits is not None else c

    def longform(df, names):
        return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), r(F.col(n).cast("double")).alias("value")) for n in names])).alias("m")).select("m.*")

    return longform(baseline, ["n_rows", "majority_baseline"]).unionByName(
        longform(metric_row, ["n_test", "accuracy", "f1", "weighted_precision", "weighted_recall"])
    )


SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("rows_used", T.LongType()),
        T.StructField("num_trees", T.IntegerType()),
        T.StructField("max_depth", T.IntegerType()),
        T.StructField("majority_baseline", T.DoubleType()),
        T.StructField("prep_seconds", T.DoubleType()),
        T.StructField("train_seconds", T.DoubleType()),
        T.StructField("total_seconds", T.DoubleType()),
        T.StructField("run_seconds", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("weighted_precision", T.DoubleType()),
        T.StructField("weighted_recall", T.DoubleType()),
    ]
)


def summary_row(spark: SparkSession, values: dict) -> DataFrame:
    """One row with the run's sizes, timings and metrics (driver scalars)."""
    return spark.createDataFrame([tuple(values.get(f.name) for f in SUMMARY_SCHEMA.fields)], SUMMARY_SCHEMA)
