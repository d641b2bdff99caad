"""Train/test splits and materialisation.

Every split is first an assignment: the rows with a boolean ``IS_TEST`` column
(``assign``); ``split`` filters on it. No row is lost: a NULL key is hashed by
the row's content, and train + test always hold every row.

* ``hash``: a row is test when ``rank >= T``, where ``rank`` orders the 32-bit
  hash ``h`` by (h % 100, h div 100) in [0, M) and ``T = ceil((1 - f) * M)``; whole
  percents are ``h % 100 >= 100 * (1 - f)`` and any other share is met to
  1 / M. Narrow; the same rows land on each side for any cluster size. A key
  that repeats keeps its rows on one side. Without a key equal rows are
  counted (partial aggregation) and ``floor((n * (M - T) + rank) / M)`` of n copies go
  to test, which is the rule above for n = 1 and keeps the share for any n.
* ``random``: ``randomSplit`` as the original job does (depends on layout).
* ``stratified``: per label exactly ``floor(f * n + 0.5)`` test rows, the
  first ones in ``(h, key, content)`` order; of copies at the border just as many
  as are needed. Rows are counted per (label, hash bucket) with partial
  aggregation, a tiny per-label table finds the bucket where the quota is
  crossed, and a running count runs only inside that one boundary bucket per
  label (about n / buckets rows, copies counted once), which yields one
  threshold tuple per label. Neither a hot label nor a hot group of copies
  goes through one task whole.
"""

from __future__ import annotations

import math
from decimal import ROUND_CEILING, Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catlens.config import JobConfig
from catlens.operators.cleaning import SPLIT_HASH, qcol
from catlens.session import scratch_path

TRAIN = "train"
TEST = "test"
HASH_BITS = 32


IS_TEST = "_is_test"
# M: the number of hash ranks; 100 blocks (h % 100) of the values h div 100 can take.
RANK_BLOCK = 42_949_673
RANKS = 100 * RANK_BLOCK
# Copies of one row that are expanded in one place.
CHUNK_ROWS = 10_000
# The threshold rows of the stratified split are broadcast up to this many bytes.
BROADCAST_BYTES = 8 << 20


def rank_threshold(test_fraction: float) -> int:
    """T: ranks at or above it are test."""
    return int(((1 - Decimal(str(test_fraction))) * RANKS).to_integral_value(ROUND_CEILING))


def hash_rank() -> Column:
    h = F.col(SPLIT_HASH)
    return (h % 100) * RANK_BLOCK + F.floor(h / 100)


def is_test_hash(test_fraction: float) -> Column:
    return hash_rank() >= F.lit(rank_threshold(test_fraction))


def expand_copies(df: DataFrame, n: Column, partitions: int | None = None, sort: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Each row n times (not at all for n < 1), in chunks of ``chunk_rows`` copies.

    No array is longer than ``chunk_rows``: chunks are numbered in two steps. With
    ``partitions`` the chunks are hash-partitioned by (split hash, chunk) before they
    are expanded, so a hot row is spread, and with ``sort`` each partition is put in order.
    """
    cols = [qcol(c) for c in df.columns]
    c = F.lit(chunk_rows).cast("long")
    outer = df.withColumn("_n", n.cast("long")).filter("_n > 0")
    outer = outer.withColumn("_c2", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / (c * c)).cast("long"))))
    outer = outer.withColumn("_n", F.least(c * c, F.col("_n") - F.col("_c2") * c * c))
    inner = outer.withColumn("_c1", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / c).cast("long"))))
    inner = inner.withColumn("_n", F.least(c, F.col("_n") - F.col("_c1") * c))
    if partitions:
        inner = inner.repartition(partitions, F.col(SPLIT_HASH), F.col("_c2"), F.col("_c1"))
    if sort:
        inner = inner.sortWithinPartitions(F.col(SPLIT_HASH), *cols, F.col("_c2"), F.col("_c1"))
    return inner.withColumn("_c0", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(*cols)


def _copies_to_sides(groups: DataFrame, n: str, n_test: Column) -> DataFrame:
    """groups (distinct rows with a count n) back to rows with IS_TEST: n_test copies are test, the rest train."""
    t = n_test.cast("long")
    sides = F.array(
        F.struct(F.lit(True).alias(IS_TEST), t.alias("_side_n")), F.struct(F.lit(False).alias(IS_TEST), (F.col(n) - t).alias("_side_n"))
    )
    cols = [qcol(c) for c in groups.columns if c != n]
    flat = groups.select(*cols, F.col(n), F.explode(sides).alias("_s")).select(*cols, F.col(f"_s.{IS_TEST}").alias(IS_TEST), F.col("_s._side_n").alias("_side_n"))
    p = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return expand_copies(flat, F.col("_side_n"), p).select(*cols, F.col(IS_TEST))


def assign_hash(df: DataFrame, test_fraction: float, keyed: bool = True) -> DataFrame:
    """G1: narrow with a key; without one, copies are counted and shared out."""
    if keyed:
        return df.withColumn(IS_TEST, is_test_hash(test_fraction))
    t = rank_threshold(test_fraction)
    groups = df.groupBy(*[qcol(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    wide = F.col("_copies").cast("decimal(20,0)") * F.lit(RANKS - t).cast("decimal(12,0)") + hash_rank().cast("decimal(12,0)")
    return _copies_to_sides(groups.withColumn("_wide", wide), "_copies", F.expr(f"_wide div {RANKS}")).drop("_wide")


def split_random(df: DataFrame, test_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """G1 as in the original job: seeded ``randomSplit`` (layout dependent)."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    return train, test


def auto_bucket_bits(max_label_rows: int) -> int:
    """Buckets ~ sqrt(largest label): balances the per-label bucket table
    against the boundary bucket that gets a running count."""
    want = max(1, int(math.isqrt(max(1, max_label_rows))))
    return min(24, max(10, (want - 1).bit_length()))


def _bucket(bucket_bits: int):
    return F.shiftright(F.col(SPLIT_HASH), HASH_BITS - bucket_bits)


def stratified_plan(df: DataFrame, label_col: str, test_fraction: float, bucket_bits: int) -> DataFrame:
    """Per label: the boundary bucket ``_b_star`` and how many of its rows
    (``_need``) go to test; one row per label (at most k + 1 rows). Labels
    whose quota is 0 have no row. Input: one partial+final aggregate to
    (label, bucket) counts, then a window over that small table."""
    counts = df.groupBy(label_col, _bucket(bucket_bits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w_cum = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (
        counts.withColumn("_cum", F.sum("_n").over(w_cum))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(label_col)))
        .withColumn("_m", F.floor(F.col("_total") * F.lit(test_fraction) + F.lit(0.5)))
    )
    crossing = counts.filter((F.col("_cum") >= F.col("_m")) & (F.col("_m") > 0))
    best = crossing.groupBy(label_col).agg(
        F.min(F.struct("_b", (F.col("_m") - (F.col("_cum") - F.col("_n"))).alias("need"))).alias("s")
    )
    return best.select(label_col, F.col("s._b").alias("_b_star"), F.col("s.need").alias("_need"))


def _tie_cols(df: DataFrame, key_col: str | None, label_col: str) -> list[str]:
    """Order after the hash: the key, then the row's cleaned content; rows equal in all of them are copies."""
    rest = [c for c in df.columns if c not in (SPLIT_HASH, label_col, key_col)]
    return ([key_col] if key_col is not None else []) + rest


def _row(names: list[str]) -> Column:
    """The columns as one value; structs compare column by column, NULL first, and NULLs are equal."""
    return F.struct(*[qcol(n).alias(f"_{i}") for i, n in enumerate(names)])


def stratified_thresholds(
    df: DataFrame, label_col: str, test_fraction: float, key_col: str | None, bucket_bits: int
) -> tuple[list, T.StructType]:
    """One row (label, _copies, _take, _edge) for every label with a quota, and their schema: the last test row, i.e. the m-th
    row in (hash, tie) order, how many copies of it there are and how many of them are test. Two passes: bucket counts,
    and a running count over only the boundary bucket of each label (about
    n_label / 2^bits rows). At most k + 1 entries."""
    plan = stratified_plan(df, label_col, test_fraction, bucket_bits).collect()
    names = [SPLIT_HASH, *_tie_cols(df, key_col, label_col)]
    b_star = F.create_map(*[x for r in plan for x in (F.lit(r[0]), F.lit(r[1]))]) if plan else F.lit(None)
    need = F.create_map(*[x for r in plan for x in (F.lit(r[0]), F.lit(r[2]))]) if plan else F.lit(None)
    boundary = df.filter(_bucket(bucket_bits) == F.element_at(b_star, F.col(label_col))) if plan else df.limit(0)
    # Copies collapse to one row with a count, partially aggregated map-side,
    # so a hot group of identical rows never reaches the window task whole.
    tuples = boundary.groupBy(F.col(label_col), _row(names).alias("_edge")).agg(F.count(F.lit(1)).alias("_copies"))
    w = Window.partitionBy(label_col).orderBy("_edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = tuples.withColumn("_cum", F.sum("_copies").over(w))
    m = F.element_at(need, F.col(label_col)) if plan else F.lit(0)
    picked = ranked.filter((F.col("_cum") >= m) & (F.col("_cum") - F.col("_copies") < m))
    picked = picked.select(label_col, "_copies", (m - F.col("_cum") + F.col("_copies")).cast("long").alias("_take"), "_edge")
    return picked.collect() if plan else [], picked.schema


def _fits_broadcast(rows: list, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the threshold rows, as text, stay below the limit (a row may hold long values)."""
    return sum(len(str(r)) for r in rows) <= limit


def assign_stratified(
    df: DataFrame, label_col: str, test_fraction: float, key_col: str | None, bucket_bits: int | None = None, max_label_rows: int | None = None
) -> DataFrame:
    """Exact stratified assignment (see module doc): each row is compared with its label's threshold row, which
    comes by a join with a table of one row per label; only the copies of a threshold row that lies on both sides are counted and expanded.

    The table is broadcast after a check of its size. Its rows are compared as structs, so the plan has the same size for any
    number of columns and labels.
    """
    if bucket_bits is None:
        if max_label_rows is None:
            max_label_rows = df.groupBy(label_col).count().agg(F.max("count")).first()[0] or 1
        bucket_bits = auto_bucket_bits(max_label_rows)
    rows, schema = stratified_thresholds(df, label_col, test_fraction, key_col, bucket_bits)
    edges = df.sparkSession.createDataFrame(rows, schema).withColumnRenamed(label_col, "_label")
    if _fits_broadcast(rows):
        edges = F.broadcast(edges)
    own = _row([SPLIT_HASH, *_tie_cols(df, key_col, label_col)])
    cols = [qcol(c) for c in df.columns]
    judged = df.join(edges, F.col(label_col).eqNullSafe(F.col("_label")), "left")
    at = F.coalesce(own == F.col("_edge"), F.lit(False))
    whole = F.col("_copies") == F.col("_take")
    test = F.coalesce((own < F.col("_edge")) | (at & whole), F.lit(False))
    if all(r["_copies"] == r["_take"] for r in rows):
        return judged.select(*cols, test.alias(IS_TEST))
    cut = at & ~whole
    groups = judged.filter(cut).groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"), F.first("_take").alias("_take"))
    shared = _copies_to_sides(groups, "_copies", F.col("_take")).select(*cols, IS_TEST)
    return judged.filter(~cut).select(*cols, test.alias(IS_TEST)).unionByName(shared)


def assign(df: DataFrame, cfg: JobConfig, max_label_rows: int | None = None) -> DataFrame:
    """The rows with IS_TEST (hash and stratified splits)."""
    if cfg.split == "hash":
        return assign_hash(df, cfg.test_fraction, cfg.key_col is not None)
    if cfg.split == "stratified":
        bits = None if cfg.stratify_buckets is None else max(1, int(cfg.stratify_buckets - 1).bit_length())
        return assign_stratified(df, cfg.label_col, cfg.test_fraction, cfg.key_col, bits, max_label_rows)
    raise ValueError(f"unknown split {cfg.split!r}")


def sides(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of assigned rows."""
    return assigned.filter(~F.col(IS_TEST)).drop(IS_TEST), assigned.filter(F.col(IS_TEST)).drop(IS_TEST)


def split(df: DataFrame, cfg: JobConfig, max_label_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    if cfg.split == "random":
        return split_random(df, cfg.test_fraction, cfg.seed)
    return sides(assign(df, cfg, max_label_rows))


def materialize(df: DataFrame, how: str = "cache", path: str | None = None) -> DataFrame:
    """Persist once. ``cache`` keeps MEMORY_AND_DISK blocks (lost blocks are
    recomputed from the short lineage); ``checkpoint`` writes a reliable copy as Parquet to
    ``path`` (default: a new folder in the session's shared folder) and cuts the lineage; the caller deletes it."""
    if how == "cache":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    if how == "checkpoint":
        path = path or scratch_path(df.sparkSession, "materialized")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if how in ("none", None):
        return df
    raise ValueError(f"unknown materialize mode {how!r}")
