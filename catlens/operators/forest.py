"""The fitted forest as a table of nodes: importances and splits by aggregation (I5), memory of deep fits."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.operators.deep_forest import DeepForestModel
from catlens.session import delete_path, scratch_path

# Nodes of a level that one pass over the rows should be able to split.
NODES_PER_PASS = 1 << 14
MEMORY_MB = (256, 2048)


def fit_memory_mb(slots: int, classes: int) -> int:
    """MLlib's maxMemoryInMB for a deep forest: the histograms of NODES_PER_PASS nodes, within MEMORY_MB.

    A node keeps, for about sqrt(slots) candidate slots, two bins of one number per class (and one for labels that training lacks). A level
    with more nodes takes further passes; the bound keeps the aggregates of a task and of the driver small.
    """
    node_bytes = math.ceil(math.sqrt(max(1, slots))) * 2 * (classes + 1) * 8
    return min(MEMORY_MB[1], max(MEMORY_MB[0], math.ceil(NODES_PER_PASS * node_bytes / 2**20)))


def node_table(spark: SparkSession, forest, keep: list[Callable[[], None]]) -> DataFrame:
    """(tree, node, slot, gain, impurity, rows, stats, left, right) of every node, from the model's saved form; leaves have no slot.

    MLlib's nodes are written in its own format and read back as a table; ``keep`` gets what deletes them. A deep forest is such a table.
    """
    if isinstance(forest, DeepForestModel):
        rows = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
        child = F.when(F.col("slot").isNotNull(), 2 * F.col("node"))
        return forest.nodes().select("tree", "node", "slot", "gain", "impurity", rows.alias("rows"), "stats", child.alias("left"), (child + 1).alias("right"))
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    keep.append(lambda: delete_path(spark, path))
    inner = F.col("nodeData.leftChild") >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("slot"),
        F.when(inner, F.col("nodeData.gain")).alias("gain"),
        F.col("nodeData.impurity").alias("impurity"),
        F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, x: a + x).alias("rows"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
    )


def slot_importances(nodes: DataFrame) -> DataFrame:
    """(slot, importance) of every slot that splits a node: gains weighted by the node's rows, each tree scaled to 1, then the
    sum over the trees scaled to 1. A tree without a split adds nothing."""
    gains = nodes.filter(F.col("slot").isNotNull()).groupBy("tree", "slot").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    per_tree = gains.groupBy("tree").agg(F.sum("g").alias("all"))  # one row per tree
    shares = gains.join(per_tree, "tree").filter("all != 0").withColumn("share", F.col("g") / F.col("all"))
    per_slot = shares.groupBy("slot").agg(F.sum("share").alias("share"))
    whole = shares.agg(F.countDistinct("tree").alias("trees"), F.lit(1).alias("one"))  # the shares of a tree add up to 1
    return per_slot.withColumn("one", F.lit(1)).join(F.broadcast(whole), "one").select("slot", (F.col("share") / F.col("trees")).alias("importance"))


def named_importances(nodes: DataFrame, slots: DataFrame, top: int | None = 10) -> DataFrame:
    """(feature_name, importance) for slots (slot, slot_name), biggest first, ties by name; slots without a split have 0."""
    named = slots.join(slot_importances(nodes), "slot", "left").select(
        F.col("slot_name").alias("feature_name"), F.coalesce("importance", F.lit(0.0)).alias("importance")
    )
    ranked = named.orderBy(F.desc("importance"), F.asc("feature_name"))
    return ranked if top is None else ranked.limit(top)


def shape_facts(nodes: DataFrame) -> DataFrame:
    """One row: trees, whether every inner node's class counts are the sum of its children's, and whether leaves = inner nodes + trees."""
    child = nodes.select("tree", F.col("node").alias("child"), F.col("stats").alias("child_stats"))
    ends = nodes.filter(F.col("slot").isNotNull()).select("tree", "node", "stats", F.explode(F.array("left", "right")).alias("child"))
    pairs = ends.join(child, ["tree", "child"]).groupBy("tree", "node").agg(F.first("stats").alias("stats"), F.collect_list("child_stats").alias("two"))
    added = F.zip_with(F.element_at("two", 1), F.element_at("two", 2), lambda a, b: a + b)
    off = F.exists(F.zip_with("stats", added, lambda a, b: F.abs(a - b)), lambda x: x > 1e-6)
    sums = pairs.agg(F.coalesce(F.max(off.cast("int")), F.lit(0)).alias("off"), F.count(F.lit(1)).alias("inner_joined"), F.lit(1).alias("one"))
    shape = nodes.agg(
        F.countDistinct("tree").alias("n_trees"), F.count(F.when(F.col("slot").isNull(), 1)).alias("leaves"), F.count("slot").alias("inner_nodes"), F.lit(1).alias("one")
    )
    both = shape.join(F.broadcast(sums), "one")
    return both.select(
        "n_trees",
        ((F.col("off") == 0) & (F.col("inner_joined") == F.col("inner_nodes"))).alias("children_add_up"),
        (F.col("leaves") == F.col("inner_nodes") + F.col("n_trees")).alias("leaves_fit"),
    )
