"""Positions in an order without a window over the whole group (H1 at a large vocabulary)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id: the partition number above these bits, the row's place in the partition below.
PLACE_BITS = 33


def position_in_group(
    df: DataFrame, group: str, order: list[Column], name: str, keep: list[Callable[[], None]], n: int | None = None
) -> tuple[DataFrame, dict]:
    """df with each row's position (from 0) among the rows of its group, and the size of every group.

    The rows are range-partitioned by (group, order) and sorted, so a large group fills several
    tasks. A row's place in its partition is known there; one aggregate gives the rows of each (group, partition), at most
    groups + partitions rows, whose running sums are the offsets. ``order`` has to be total within a group. The sorted rows are
    persisted, since the range bounds are sampled: ``keep`` gets what releases them. The groups have to
    be few (their sizes go to the driver).
    """
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_place", F.monotonically_increasing_id())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    keep.append(placed.unpersist)
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    spans = placed.groupBy(group, part).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    spans = spans.persist(StorageLevel.MEMORY_AND_DISK)
    keep.append(spans.unpersist)
    sizes = {r[0]: r[1] for r in spans.groupBy(group).agg(F.sum("_n")).collect()}
    # at most groups + partitions rows: a bound that does not grow with the rows
    offsets = F.broadcast(spans.select(F.col(group).alias("_group"), "_part", (F.col("_before") - F.col("_first")).alias("_shift")))
    same = (F.col(group) == F.col("_group")) & (F.shiftright(F.col("_place"), PLACE_BITS) == F.col("_part"))
    cols = [F.col(f"`{c}`") for c in df.columns]
    return placed.join(offsets, same).select(*cols, (F.col("_place") + F.col("_shift")).alias(name)), sizes
