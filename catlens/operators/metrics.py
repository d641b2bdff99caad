"""Evaluation from one confusion table.

The predictions are read once, into the (actual, predicted, n) table; every
metric and the per-class report are small aggregates of that table. The
original job runs four evaluator jobs, each re-running the model.

Metric rules (as MLlib's MulticlassMetrics): over the classes that occur as
actual labels, precision = tp / predicted (0 when never predicted),
recall = tp / actual, F1 = 2PR / (P + R) (0 when P + R = 0); weighted
versions weight each class by its share of actual rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlens.operators.features import PREDICTED_LABEL


def correct_flag(actual: str, predicted: str = PREDICTED_LABEL):
    """1 when the prediction equals the actual label, else 0."""
    return (F.col(actual) == F.col(predicted)).cast("int")


def confusion(predictions: DataFrame, label_col: str) -> DataFrame:
    """(actual, predicted, n): one pass, partial aggregation."""
    return predictions.groupBy(label_col, PREDICTED_LABEL).agg(F.count(F.lit(1)).alias("n"))


def per_class_scores(conf: DataFrame, label_col: str) -> DataFrame:
    """Per actual class: n_actual, tp, n_predicted, precision, recall, f1.

    Each confusion cell counts once for its actual class and once for its
    predicted class, so one aggregation by class gives all three counts (no
    join); classes that never occur as actual labels are then dropped."""
    a, p, n = F.col(label_col), F.col(PREDICTED_LABEL), F.col("n")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(a.alias("cls"), n.alias("n_actual"), F.when(a == p, n).otherwise(zero).alias("tp"), zero.alias("n_predicted")),
        F.struct(p.alias("cls"), zero.alias("n_actual"), zero.alias("tp"), n.alias("n_predicted")),
    )
    s = (
        conf.select(F.inline(sides))
        .groupBy(F.col("cls").alias(label_col))
        .agg(F.sum("n_actual").alias("n_actual"), F.sum("tp").alias("tp"), F.sum("n_predicted").alias("n_predicted"))
        .filter(F.col("n_actual") > 0)
    )
    p = F.when(F.col("n_predicted") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("n_predicted"))
    r = F.col("tp") / F.col("n_actual")
    s = s.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when((F.col("precision") + F.col("recall")) == 0, F.lit(0.0)).otherwise(
        2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    )
    return s.withColumn("f1", f1)


def metrics(conf: DataFrame, label_col: str) -> DataFrame:
    """One row with n_test, accuracy, f1, weighted_precision, weighted_recall."""
    s = per_class_scores(conf, label_col)
    n = F.sum("n_actual")
    return s.agg(
        n.alias("n_test"),
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("n_actual")) / n).alias("f1"),
        (F.sum(F.col("precision") * F.col("n_actual")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("n_actual")) / n).alias("weighted_recall"),
    )


def per_class_report(conf: DataFrame, label_col: str) -> DataFrame:
    """J6 + E5 + B9: per actual class, accuracy (share correct) and test rows,
    biggest class first."""
    return (
        conf.groupBy(label_col)
        .agg(
            (F.sum(F.when(F.col(label_col) == F.col(PREDICTED_LABEL), F.col("n")).otherwise(0)) / F.sum("n")).alias(
                "class_accuracy"
            ),
            F.sum("n").alias("n_test_examples"),
        )
        .orderBy(F.desc("n_test_examples"), F.asc(label_col))
    )


def per_class_from_predictions(predictions: DataFrame, label_col: str) -> DataFrame:
    """J6 as a row-level aggregate: avg of the ``correct`` flag (B8) and the
    row count per actual class. Equal to ``per_class_report`` on the confusion
    table; that one is used by the job because it needs no second pass."""
    return (
        predictions.withColumn("correct", correct_flag(label_col))
        .groupBy(label_col)
        .agg(F.avg("correct").alias("class_accuracy"), F.count(F.col(label_col)).alias("n_test_examples"))
        .orderBy(F.desc("n_test_examples"), F.asc(label_col))
    )
