"""Class labels: top-k codes, OTHER lumping, class counts, majority baseline
(B6, B7, D1, D2, E1-E4, F1, F2).

The only driver round trip is the k-row top table (bounded by k). Label
counts and the baseline come from the grouped code counts, never from a
second pass over the rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlens.config import OTHER_LABEL, JobConfig
from catlens.functions import int_to_string


def code_frequency(df: DataFrame, code_col: str) -> DataFrame:
    """Rows per code (partial + final hash aggregate, skew-safe)."""
    return df.groupBy(code_col).agg(F.count(F.lit(1)).alias("count"))


def top_k_values(freq: DataFrame, code_col: str, k: int) -> DataFrame:
    """D1 + F1 + F2: the k most frequent codes; ties by code ascending
    (planned as TakeOrderedAndProject: a per-partition top-k, then a k-row merge)."""
    return freq.orderBy(F.desc("count"), F.asc(code_col)).limit(k)


def collect_top_codes(freq: DataFrame, code_col: str, k: int) -> list[int]:
    """The top-k codes on the driver: at most k values."""
    return [r[0] for r in top_k_values(freq, code_col, k).select(code_col).collect()]


def label_expr(code_col: str, top_codes: list[int]):
    """B6 + B7: the code's text when it is a kept code, else OTHER."""
    code = F.col(code_col)
    if not top_codes:
        return F.lit(OTHER_LABEL)
    return F.when(code.isin(top_codes), int_to_string(code)).otherwise(F.lit(OTHER_LABEL))


def lump_other(df: DataFrame, code_col: str, label_col: str, top_codes: list[int]) -> DataFrame:
    """Add the label column (a k-value InSet inside the codegen stage)."""
    return df.withColumn(label_col, label_expr(code_col, top_codes))


def label_counts(freq: DataFrame, code_col: str, label_col: str, top_codes: list[int]) -> DataFrame:
    """E1 per label, from the grouped code counts (tiny input)."""
    return (
        freq.withColumn(label_col, label_expr(code_col, top_codes))
        .groupBy(label_col)
        .agg(F.sum("count").alias("count"))
    )


def majority_baseline(counts: DataFrame) -> DataFrame:
    """One row with usable rows, biggest class size and their ratio."""
    return counts.agg(
        F.sum("count").alias("n_rows"),
        F.max("count").alias("top_class_count"),
        (F.max("count") / F.sum("count")).alias("majority_baseline"),
    )


class Labeller:
    """Top-k labelling fitted on the usable rows (before any split)."""

    def __init__(self, cfg: JobConfig):
        self.cfg = cfg
        self.freq: DataFrame | None = None
        self.top_codes: list[int] = []

    def fit(self, cleaned: DataFrame) -> "Labeller":
        """One aggregation of the code counts, kept (one row per code) for the label counts
        and baseline that follow; the k top codes go to the driver."""
        cfg = self.cfg
        self.freq = code_frequency(cleaned, cfg.code_out).persist(StorageLevel.MEMORY_AND_DISK)
        self.top_codes = collect_top_codes(self.freq, cfg.code_out, cfg.top_n_classes)
        return self

    def transform(self, cleaned: DataFrame) -> DataFrame:
        return lump_other(cleaned, self.cfg.code_out, self.cfg.label_col, self.top_codes)

    def label_counts(self) -> DataFrame:
        return label_counts(self.freq, self.cfg.code_out, self.cfg.label_col, self.top_codes)

    def top_table(self) -> DataFrame:
        return top_k_values(self.freq, self.cfg.code_out, self.cfg.top_n_classes)
