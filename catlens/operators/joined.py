"""Encoding and Naive Bayes by joins, for vocabularies that fit neither the driver nor one row.

MLlib's indexer models hold every category on the driver, and its Naive Bayes model a dense classes x slots
matrix. Here the vocabulary is a bucketed table (feature, category, slot, ...); rows are unpivoted to
(row, feature, category) cells and meet it in a join. Nothing of the size of the vocabulary is collected.

Hot values: the cells are counted per value first (partial aggregation). At most ``HOT_VALUES`` values can hold a share of
1 / ``HOT_VALUES`` of all cells or more; these are looked up once and broadcast, whether the vocabulary knows
them or not, and only the cells of all other values are shuffled, none of which is hot.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.operators import splits
from catlens.operators.cleaning import qcol
from catlens.operators.features import PREDICTED_LABEL, ROWS, category_index_table, class_counts
from catlens.session import delete_path, scratch_path

HOT_VALUES = 1000
KEYS = ["feature", "category"]
ROW = "_row"
# Scores closer than this are ties, which go to the lower label index.
SCORE_DIGITS = 9

Keep = list[Callable[[], None]]


def bucketed(df: DataFrame, keep: Keep, buckets: int | None = None) -> DataFrame:
    """df as a table bucketed and sorted by (feature, category), so that joins on them do not shuffle it again."""
    spark = df.sparkSession
    path, name = scratch_path(spark, "vocabulary"), f"catlens_vocabulary_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)

    def release() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, path)

    keep.append(release)
    return spark.table(name)


def vocabulary_table(counts: DataFrame, cfg: JobConfig, keep: Keep) -> DataFrame:
    """(feature, category, idx, slot, slot_name) of the training rows, bucketed by (feature, category)."""
    own: Keep = []
    out = bucketed(category_index_table(counts, cfg, own), keep)
    for release in own:
        release()
    return out


def numbered(df: DataFrame, keep: Keep) -> DataFrame:
    """df with a row number, written once, so that the numbers stay when an executor is lost."""
    path = scratch_path(df.sparkSession, "rows")
    keep.append(lambda: delete_path(df.sparkSession, path))
    return splits.materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "checkpoint", path)


def cells(rows: DataFrame, cfg: JobConfig) -> DataFrame:
    """(row, feature, category) of every non-NULL feature value: a narrow unpivot."""
    pairs = [F.struct(F.lit(c).alias("feature"), qcol(c).alias("category")) for c in cfg.feature_cols]
    return rows.select(ROW, F.inline(F.array(*pairs))).filter(F.col("category").isNotNull())


def look_up(long: DataFrame, table: DataFrame, keep: Keep) -> DataFrame:
    """The cells that the table knows, with its columns: hot values by a broadcast of at most HOT_VALUES rows, the others by a join on (feature, category)."""
    per_value = long.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_cells")).persist(StorageLevel.MEMORY_AND_DISK)
    keep.append(per_value.unpersist)
    total = per_value.agg(F.sum("_cells")).first()[0] or 0
    hot = per_value.filter(F.col("_cells") * HOT_VALUES >= total).select(*KEYS)
    own = [c for c in table.columns if c not in KEYS]
    known = hot.join(table, KEYS, "left").withColumn("_hot", F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK)
    keep.append(known.unpersist)
    marked = long.join(F.broadcast(known), KEYS, "left")
    # a value the table lacks has NULL in its first own column
    met = marked.filter(F.col("_hot") & F.col(own[0]).isNotNull()).select(ROW, *KEYS, *own)
    others = marked.filter(F.col("_hot").isNull()).select(ROW, *KEYS).join(table, KEYS)
    return met.unionByName(others.select(ROW, *KEYS, *own))


def one_hot_long_joined(rows: DataFrame, table: DataFrame, cfg: JobConfig, keep: Keep) -> DataFrame:
    """H1-H3: (row, feature, slot, slot_name) of every active slot of numbered rows."""
    return look_up(cells(rows, cfg), table.select(*KEYS, "slot", "slot_name"), keep).select(ROW, "feature", "slot", "slot_name")


def _per_row(rows: DataFrame, found: DataFrame, aggs: list[Column], names: list[str]) -> DataFrame:
    """One aggregate per row; a row without any known value keeps its place by an entry of NULLs."""
    own = [c for c in found.columns if c != ROW]
    empty = rows.select(ROW, *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in own])
    return found.unionByName(empty).groupBy(ROW).agg(*[a.alias(n) for a, n in zip(aggs, names)])


def sparse_vectors(rows: DataFrame, table: DataFrame, cfg: JobConfig, keep: Keep) -> DataFrame:
    """H2 + H3: (row, size, indices, values) of numbered rows, a sparse vector in its parts: at most one entry per feature."""
    found = look_up(cells(rows, cfg), table.select(*KEYS, "slot"), keep).select(ROW, "slot")
    size = table.agg(F.count(F.lit(1))).first()[0]
    out = _per_row(rows, found, [F.array_sort(F.collect_list("slot"))], ["indices"])
    return out.select(ROW, F.lit(size).cast("int").alias("size"), "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values"))


class SparseNaiveBayes:
    """I1 + I2 with parameters only where a class has seen a slot.

    theta(c, slot) = default(c) + gain(c, slot) with default = ln(l) - ln(sum of the class's counts + D l) and
    gain = ln(n + l) - ln(l), which is 0 for n = 0. So a table row holds one gain per class (at most k + 1 numbers), the driver the
    priors and defaults, and a row's score is prior + active slots * default + the sum of its gains.
    """

    def __init__(self, counts: DataFrame, cfg: JobConfig, keep: Keep):
        lam, lab = cfg.smoothing, cfg.label_col
        if lam <= 0:
            raise ValueError("smoothing has to be positive: an unseen slot has the default log ln(smoothing)")
        self.cfg, self.keep = cfg, keep
        # (label, n) of at most k + 1 classes, by index: frequency descending, then UTF-16 order
        classes = [tuple(r) for r in class_counts(counts, cfg).collect()]
        classes.sort(key=lambda r: (-r[1], r[0].encode("utf-16-be")))
        self.labels = [r[0] for r in classes]
        seen = counts.filter(F.col("feature") != ROWS)
        n = [F.sum(F.when(F.col(lab) == c, F.col("n")).otherwise(0)).alias(f"n{i}") for i, c in enumerate(self.labels)]
        slots = seen.groupBy(*KEYS).agg(*n)
        gains = [(F.log(F.col(f"n{i}") + F.lit(lam)) - F.log(F.lit(lam))).alias(f"g{i}") for i in range(len(self.labels))]
        self.table = bucketed(slots.select(*KEYS, F.lit(1).alias("active"), *gains), keep)
        d = self.table.agg(F.count(F.lit(1))).first()[0]
        cells_of = {r[0]: r[1] for r in seen.groupBy(lab).agg(F.sum("n")).collect()}
        rows, k = sum(r[1] for r in classes), len(classes)
        log = F.log
        self.priors = [log(F.lit(c + lam)) - log(F.lit(rows + k * lam)) for _, c in classes]
        self.defaults = [log(F.lit(float(lam))) - log(F.lit(cells_of.get(c, 0) + d * lam)) for c, _ in classes]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Numbered rows with PREDICTED_LABEL: the class with the best score, ties to the lower label index."""
        found = look_up(cells(rows, self.cfg), self.table, self.keep).drop(*KEYS)
        k = range(len(self.labels))
        sums = [F.coalesce(F.sum(f"g{i}"), F.lit(0.0)) for i in k]
        active = F.coalesce(F.sum("active"), F.lit(0))
        per_row = _per_row(rows, found, [active, *sums], ["active", *[f"g{i}" for i in k]])
        scores = F.array(*[F.round(self.priors[i] + F.col("active") * self.defaults[i] + F.col(f"g{i}"), SCORE_DIGITS) for i in k])
        best = F.array_position(scores, F.array_max(scores)).cast("int")
        label = F.element_at(F.array(*[F.lit(c) for c in self.labels]), best)
        return rows.join(per_row.select(ROW, label.alias(PREDICTED_LABEL)), ROW)
