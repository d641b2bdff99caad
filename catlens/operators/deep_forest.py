"""A deep gini forest as a table of nodes, fitted and applied by Spark tasks.

MLlib sends the histograms of all open nodes from every partition, level by level, and keeps the whole forest on the driver; at
depth 20 both outgrow the rows. Here equal rows are counted once, each tree's bootstrap weight of n equal rows is a Poisson(n) draw
(the sum of n Poisson(1) draws), and the nodes that hold more than ``deep_node_rows`` rows are split level by level from summed
histograms. The others are dealt with their rows by (tree, node), each group small enough for a task, which splits it to the end.

The rules are MLlib's: ceil(sqrt(slots)) random slots per node (all for a single tree), the biggest gini gain above zero, left
without the slot's value, right with it; at last, two leaves of one parent with the same class are joined into one. Nodes have heap numbers (root 1, children 2n and 2n + 1). No part of the fit or of the
predictions depends on the input's layout.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.session import delete_path, scratch_path

# The workers get these functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A gain at or below this is rounding.
MIN_GAIN = 1e-15
# Votes are added as whole numbers of this fraction, so their sum has no order.
VOTE = 1 << 40
# The rows of one group of a prediction are cut into shares of about this many.
SHARE_ROWS = 1 << 22
NODES = "tree int, grp long, node long, slot int, gain double, impurity double, stats array<double>"


@dataclass(frozen=True)
class Space:
    """What tasks know of the forest to grow: each slot's feature, classes, slots tried per node, depth and seed."""

    col: np.ndarray
    classes: int
    tried: int
    depth: int
    seed: int


@dataclass(frozen=True)
class Top:
    """The nodes of a tree, or of a part of it, by heap number; slot -1: the walk ends here. left: the place of the left child."""

    heap: np.ndarray
    slot: np.ndarray
    left: np.ndarray


def _top(heap: np.ndarray, slot: np.ndarray) -> Top:
    """heap in ascending order; a right child is the left one's neighbour."""
    return Top(heap, slot, np.searchsorted(heap, 2 * heap))


def _mix(z: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def tried_slots(space: Space, tree: int, heap: np.ndarray) -> np.ndarray:
    """(nodes, tried) slots of each node, without repeats (Floyd's sampling on a hash of seed, tree, node and draw)."""
    step = np.uint64(0x9E3779B97F4A7C15)
    start = np.array([(space.seed * 0x9E3779B1 + tree + 1) & (2**64 - 1)], dtype=np.uint64)
    key = _mix(_mix(start * step) ^ heap.astype(np.uint64))
    out = np.empty((len(heap), space.tried), dtype=np.int64)
    for i in range(space.tried):
        last = len(space.col) - space.tried + i
        key = key + step
        drawn = (_mix(key) % np.uint64(last + 1)).astype(np.int64)
        out[:, i] = np.where((out[:, :i] == drawn[:, None]).any(axis=1), last, drawn)
    return out


def _present(x: np.ndarray, col: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Whether each row has its slot's value."""
    return x.ravel()[np.arange(len(x)) * x.shape[1] + col[slot]] == slot


def best_splits(total: np.ndarray, rights: Iterator[tuple[np.ndarray, np.ndarray]]):
    """(slot or -1, gain, impurity, right class counts) of nodes with class counts total; rights: (slot, right counts) per try."""
    n = np.maximum(total.sum(axis=1), 1)
    whole = (total * total).sum(axis=1) / n
    slot, most, best = np.full(len(total), -1, dtype=np.int64), np.full(len(total), MIN_GAIN), np.zeros_like(total)
    for tried, right in rights:
        left = total - right
        n_left, n_right = left.sum(axis=1), right.sum(axis=1)
        parts = (left * left).sum(axis=1) / np.maximum(n_left, 1) + (right * right).sum(axis=1) / np.maximum(n_right, 1)
        gain = (parts - whole) / n
        better = (n_left > 0) & (n_right > 0) & (gain > most)
        slot[better], most[better], best[better] = tried[better], gain[better], right[better]
    return slot, np.where(slot >= 0, most, 0.0), 1 - whole / n, best


def split_levels(space: Space, tree: int, root: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Iterator[tuple]:
    """The unpruned subtree of root over its rows, level by level: (heap, slot or -1, gain, impurity, class counts) of each level's nodes."""
    k, heap, at = space.classes, np.array([root], dtype=np.int64), np.zeros(len(y), dtype=np.int64)
    total = np.bincount(y, w, k).reshape(1, k)
    for depth in range(root.bit_length() - 1, space.depth + 1):
        tried = tried_slots(space, tree, heap)
        mixed = ((total > 0).sum(axis=1) > 1) & (depth < space.depth)
        keep = np.flatnonzero(mixed[at])
        x, y, w, at = x[keep], y[keep], w[keep], at[keep]

        def rights(x=x, w=w, at=at, tried=tried, cell=at * k + y, size=len(heap) * k):
            for i in range(tried.shape[1] if len(at) else 0):
                has = np.flatnonzero(_present(x, space.col, tried[at, i]))
                yield tried[:, i], np.bincount(cell[has], w[has], size).reshape(-1, k)

        slot, gain, impurity, right = best_splits(total, rights())
        yield heap, slot, gain, impurity, total
        split = slot >= 0
        if not split.any():
            return
        keep = np.flatnonzero(split[at])
        x, y, w, at = x[keep], y[keep], w[keep], at[keep]
        at = 2 * (np.cumsum(split) - 1)[at] + _present(x, space.col, slot[at])
        heap = np.stack([2 * heap[split], 2 * heap[split] + 1], axis=1).ravel()
        total = np.stack([total[split] - right[split], right[split]], axis=1).reshape(-1, k)


def grow(space: Space, tree: int, root: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple]:
    """The levels of ``split_levels`` where, from the bottom up, two leaves of one parent with the same class are cut."""
    out: list[tuple] = []
    for level in reversed([*split_levels(space, tree, root, x, y, w)]):
        if out:
            slot, (_, low, _, _, counts) = level[1], out[-1]  # the nodes below are the children of the split nodes, in their order
            leaf, label = low < 0, counts.argmax(axis=1)
            cut = leaf[::2] & leaf[1::2] & (label[::2] == label[1::2])
            slot[np.flatnonzero(slot >= 0)[cut]] = -1
            out[-1] = tuple(a[np.repeat(~cut, 2)] for a in out[-1])
        out.append(level)
    return [level for level in out if len(level[0])]  # Spark ends a table at an empty Arrow batch


def _cut_above(levels: list[tuple], roots: dict[int, int]) -> tuple[list[tuple], list[int]]:
    """The same for the top levels of a tree, and which groups go; roots: the class of each group that is one leaf."""
    leaf, gone = dict(roots), set()
    for heap, slot, _, _, total in reversed(levels):
        for i, h in enumerate(heap.tolist()):
            label = int(total[i].argmax())
            if slot[i] >= 0 and 2 * h in leaf and leaf[2 * h] == leaf.get(2 * h + 1):
                slot[i] = -1
                gone |= {2 * h, 2 * h + 1}
            if slot[i] < 0:
                leaf[h] = label
    kept = [~np.isin(level[0], [*gone]) for level in levels]
    return [tuple(a[k] for a in level) for level, k in zip(levels, kept) if k.any()], [h for h in roots if h in gone]


def walk(top: Top, col: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places in top where rows end that start at the places ``at``."""
    at, rows = at.copy(), np.arange(len(x))
    while len(rows):
        slot = top.slot[at[rows]]
        rows, slot = rows[slot >= 0], slot[slot >= 0]
        at[rows] = top.left[at[rows]] + _present(x[rows], col, slot)
    return at


def _x(batch, n: int) -> np.ndarray:
    return np.stack([batch.column(f"_x{i}").to_numpy() for i in range(n)], axis=1) if n else np.zeros((batch.num_rows, 0), np.int32)


def _lists(values: np.ndarray) -> pa.ListArray:
    """A list column of the matrix's rows."""
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], values.ravel())


def _matrix(batch, name: str) -> np.ndarray:
    c = batch.column(name)
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _names(n: int) -> list[str]:
    return [f"_x{i}" for i in range(n)]


def _ints(n: int) -> str:
    return "".join(f"{c} int, " for c in _names(n))


def slot_columns(blocks: list[tuple[Column, int]]) -> dict[str, Column]:
    """_x0, _x1, ...: the slot of each feature's value, -1 where training lacks it. blocks: (index column, values in training)."""
    out, offset = {}, 0
    for i, (idx, size) in enumerate(blocks):
        out[f"_x{i}"] = F.when(idx < size, (idx + offset).cast("int")).otherwise(F.lit(-1))
        offset += size
    return out


def bootstrap(rows: DataFrame, n_features: int, trees: int, seed: int, partitions: int) -> DataFrame:
    """Distinct rows (_x0.., y) with their weight in every tree and their node there (1, the root). The draws follow a layout fixed by the rows."""
    cols = [*_names(n_features), "y"]

    def draw(batches):
        rngs = [np.random.default_rng([seed, TaskContext.get().partitionId(), t]) for t in range(trees)]
        for b in batches:
            n = b.column("n").to_numpy()
            w = np.stack([r.poisson(n) for r in rngs], axis=1)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in cols], _lists(w), _lists(np.ones_like(w))], names=[*cols, "w", "at"])

    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    placed = counted.repartition(partitions, *cols).sortWithinPartitions(*cols)
    return placed.mapInArrow(draw, f"{_ints(n_features)}y int, w array<long>, at array<long>")


def _moved(batch, space: Space, tops: list[Top], n_features: int):
    """(tree, places of the batch's rows in the tree's top, their slots, weights) of each tree, for the rows the tree drew."""
    x, w, at = _x(batch, n_features), _matrix(batch, "w"), _matrix(batch, "at")
    for t, top in enumerate(tops):
        rows = np.flatnonzero(w[:, t] > 0)
        own = x[rows]
        yield t, rows, walk(top, space.col, own, np.searchsorted(top.heap, at[rows, t])), own, w[rows, t]


def _counted(bag: DataFrame, space: Space, tops: list[Top], fronts: list[np.ndarray], n_features: int) -> list[np.ndarray]:
    """Per tree, (front nodes, tries + 1, classes + 1): class counts and number of rows with each tried slot; last, of the whole node."""
    k, tries = space.classes, space.tried
    tried = [tried_slots(space, t, heap) for t, heap in enumerate(fronts)]

    def count(batches):
        cells = [np.zeros((tries + 1, len(f) * (k + 1))) for f in fronts]
        place = [np.full(len(top.heap), -1) for top in tops]
        for t, f in enumerate(fronts):
            place[t][np.searchsorted(tops[t].heap, f)] = np.arange(len(f))
        for b in batches:
            labels = b.column("y").to_numpy()
            for t, rows, at, x, w in _moved(b, space, tops, n_features):
                keep = np.flatnonzero(place[t][at] >= 0)
                if not len(keep):
                    continue
                f, x, w, y = place[t][at[keep]], x[keep], w[keep], labels[rows[keep]]
                for i in range(tries + 1):
                    has = np.flatnonzero(_present(x, space.col, tried[t][f, i])) if i < tries else np.arange(len(f))
                    cells[t][i] += np.bincount(f[has] * (k + 1) + y[has], w[has], cells[t].shape[1])
                    cells[t][i] += np.bincount(f[has] * (k + 1) + k, minlength=cells[t].shape[1])
        for t, c in enumerate(cells):
            c = c.reshape(tries + 1, -1, k + 1)
            i, f = np.nonzero(c[:, :, k])
            if len(i):
                ids = [np.full(len(i), t, dtype=np.int32), f.astype(np.int32), i.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, ids), *[pa.array(c[i, f, j]) for j in range(k + 1)]], names=["t", "f", "i", *[f"c{j}" for j in range(k + 1)]])

    sums = bag.mapInArrow(count, "t int, f int, i int, " + ", ".join(f"c{j} double" for j in range(k + 1)))
    got = sums.groupBy("t", "f", "i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(k + 1)]).toArrow()
    out = [np.zeros((len(f), tries + 1, k + 1)) for f in fronts]
    t, f, i = (got.column(c).to_numpy() for c in ("t", "f", "i"))
    values = np.stack([got.column(f"c{j}").to_numpy() for j in range(k + 1)], axis=1)
    for tree in range(len(fronts)):
        own = t == tree
        out[tree][f[own], i[own]] = values[own]
    return out


def _place_rows(bag: DataFrame, space: Space, tops: list[Top], n_features: int) -> DataFrame:
    """The bag with each row's node in every tree moved on to where the tops end."""

    def move(batches):
        for b in batches:
            at = _matrix(b, "at").copy()
            for t, rows, end, _, _ in _moved(b, space, tops, n_features):
                at[rows, t] = tops[t].heap[end]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _lists(at)], names=b.schema.names)

    return bag.mapInArrow(move, bag.schema)


def _dealt(bag: DataFrame, space: Space, tops: list[Top], groups: list[np.ndarray], n_features: int) -> DataFrame:
    """One row per tree and row whose node is a group."""

    def deal(batches):
        for b in batches:
            labels = b.column("y").to_numpy()
            for t, rows, at, x, w in _moved(b, space, tops, n_features):
                node = tops[t].heap[at]
                keep = np.isin(node, groups[t])
                if keep.any():
                    ids = [np.full(keep.sum(), t, dtype=np.int32), node[keep]]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, [*ids, *x[keep].T, labels[rows[keep]], w[keep]])], names=["tree", "grp", *_names(n_features), "y", "w"])

    return bag.mapInArrow(deal, f"tree int, grp long, {_ints(n_features)}y int, w long")


def _node_rows(tree: int, grp, heap, slot, gain, impurity, total) -> pa.Table:
    leaf = slot < 0
    cols = [np.full(len(heap), tree, dtype=np.int32), np.broadcast_to(grp, len(heap)).astype(np.int64), heap.astype(np.int64)]
    return pa.table(
        [*map(pa.array, cols), pa.array(slot.astype(np.int32), mask=leaf), pa.array(gain, mask=leaf), pa.array(impurity), _lists(total)],
        names=["tree", "grp", "node", "slot", "gain", "impurity", "stats"],
    )


def _grown(dealt: DataFrame, space: Space, n_features: int) -> DataFrame:
    """The nodes of every group."""

    def work(key, rows):
        tree, root = key[0].as_py(), key[1].as_py()
        x, y, w = _x(rows, n_features), rows.column("y").to_numpy(), rows.column("w").to_numpy()
        order = np.lexsort([y, *x.T])  # rows come from the shuffle in any order
        return pa.concat_tables(_node_rows(tree, root, *level) for level in grow(space, tree, root, x[order], y[order], w[order]))

    return dealt.groupBy("tree", "grp").applyInArrow(work, NODES)


def fit_nodes(rows: DataFrame, space: Space, n_features: int, trees: int, partitions: int, node_rows: int, checkpoint: int) -> str:
    """The path of the forest's nodes (NODES), fitted on rows (_x0.., y).

    Nodes with more than node_rows distinct rows are split level by level, one pass each; every ``checkpoint`` levels the rows are
    written to the shared folder with their nodes. To the driver go the tried histograms of these nodes only, at most about
    rows / node_rows per tree and level. Nodes of the top levels have grp 0, a group's nodes its root's number.
    """
    spark = rows.sparkSession
    written: list[str] = []

    def saved(df: DataFrame) -> DataFrame:
        written.append(scratch_path(spark, "forest-rows"))
        df.write.parquet(written[-1])
        return spark.read.schema(df.schema).parquet(written[-1])

    bag = saved(bootstrap(rows, n_features, trees, space.seed, partitions))
    drawn = bag.agg(*[F.coalesce(F.count_if(F.col("w")[t] > 0), F.lit(0)) for t in range(trees)]).first()
    one = np.array([1], dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    done: list[list[tuple]] = [[] for _ in range(trees)]  # (heap, slot, gain, impurity, class counts), level by level
    fronts = [one if n > node_rows else none for n in drawn]
    groups = [one if 0 < n <= node_rows else none for n in drawn]
    for t, n in enumerate(drawn):
        if n == 0:  # a tree that drew no row is one leaf without counts
            done[t].append((one, -one, np.zeros(1), np.zeros(1), np.zeros((1, space.classes))))

    def tops() -> list[Top]:
        out = []
        for t in range(trees):
            ends = np.concatenate([fronts[t], groups[t]])
            heap = np.concatenate([*[d[0] for d in done[t]], ends])
            slot = np.concatenate([*[d[1] for d in done[t]], np.full(len(ends), -1)])
            order = np.argsort(heap)
            out.append(_top(heap[order], slot[order]))
        return out

    depth = 0
    while any(map(len, fronts)):
        if depth and depth % checkpoint == 0:
            bag = saved(_place_rows(bag, space, tops(), n_features))
        cells = _counted(bag, space, tops(), fronts, n_features)
        for t, heap in enumerate(fronts):
            tried, c = tried_slots(space, t, heap), cells[t]
            total, n = c[:, -1, :-1], c[:, -1, -1]
            ends = depth >= space.depth
            slot, gain, impurity, right = best_splits(total, ((tried[:, i], c[:, i, :-1]) for i in range(0 if ends else space.tried)))
            done[t].append((heap, slot, gain, impurity, total))
            split = slot >= 0
            at = np.flatnonzero(split)
            n_right = c[at, (tried[at] == slot[at, None]).argmax(axis=1), -1] if len(at) else np.zeros(0)
            child = np.stack([2 * heap[at], 2 * heap[at] + 1], axis=1).ravel()
            size = np.stack([n[at] - n_right, n_right], axis=1).ravel()
            fronts[t], groups[t] = child[size > node_rows], np.concatenate([groups[t], child[size <= node_rows]])
        depth += 1
    nodes = saved(_grown(_dealt(bag, space, tops(), groups, n_features), space, n_features))
    roots: list[dict[int, int]] = [{} for _ in range(trees)]
    for t, h, stats in nodes.filter("grp = node and slot is null").select("tree", "grp", "stats").collect():
        roots[t][h] = int(np.argmax(stats))
    gone = []
    for t in range(trees):
        done[t], dropped = _cut_above(done[t], roots[t])
        gone += [(t, h) for h in dropped]
    if gone:
        nodes = nodes.join(F.broadcast(spark.createDataFrame(gone, "tree int, grp long")), ["tree", "grp"], "left_anti")
    above = [_node_rows(t, 0, *level) for t in range(trees) for level in done[t]]
    if above:
        nodes = nodes.unionByName(spark.createDataFrame(pa.concat_tables(above)))
    path = scratch_path(spark, "forest")
    nodes.write.parquet(path)
    for p in written:
        delete_path(spark, p)
    return path


class DeepForestModel(Model, MLWritable, MLReadable):
    """The fitted forest: its nodes in the shared folder, of which the driver reads the top levels and the groups' roots."""

    def __init__(self, path: str | None = None, features: tuple[str, ...] = (), sizes: tuple[int, ...] = (), classes: int = 0, trees: int = 0):
        super().__init__()
        self.path, self.features, self.sizes, self.classes, self.num_trees = path, tuple(features), tuple(sizes), classes, trees
        self.owned = True
        self._tops: list | None = None

    def nodes(self) -> DataFrame:
        return SparkSession.active().read.schema(NODES).parquet(self.path)

    def release(self) -> None:
        """Delete the nodes, unless the model was loaded from where they are."""
        if self.owned:
            delete_path(SparkSession.active(), self.path)

    @property
    def depth(self) -> int:
        return int(self.nodes().agg(F.max(F.length(F.bin("node")))).first()[0]) - 1

    @property
    def col(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def tops(self) -> list[tuple[Top, np.ndarray, np.ndarray]]:
        """Per tree: its nodes down to the groups' roots, whether each is a group, and its votes where it is a leaf."""
        if self._tops is None:
            got = self.nodes().filter("grp = 0 or grp = node").select("tree", "grp", "node", "slot", "stats").orderBy("tree", "node").toArrow()
            tree, grp, node = (got.column(c).to_numpy() for c in ("tree", "grp", "node"))
            slot = got.column("slot").fill_null(-1).to_numpy()
            slot, votes = np.where(grp > 0, -1, slot), _votes(_matrix(got, "stats"))
            own = [np.flatnonzero(tree == t) for t in range(self.num_trees)]
            self._tops = [(_top(node[o], slot[o]), grp[o] > 0, votes[o]) for o in own]
        return self._tops

    def _transform(self, df: DataFrame) -> DataFrame:
        """rawPrediction, probability and prediction: every tree votes with its leaf's class shares; ties go to the lower class."""
        n, k, col, names = len(self.sizes), self.classes, self.col, _names(len(self.sizes))
        votes = [f"_v{j}" for j in range(k)]
        schema = _ints(n) + ", ".join(f"{v} long" for v in votes)
        tops = self.tops()

        def high(batches):
            """The votes of the trees where the walk ends above the groups."""
            for b in batches:
                x, sums = _x(b, n), np.zeros((b.num_rows, k), dtype=np.int64)
                for top, group, vote in tops:
                    at = walk(top, col, x, np.zeros(len(x), dtype=np.int64))
                    sums += np.where(group[at][:, None], 0, vote[at])
                yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, sums.T)], names=[*names, *votes])

        def deal(batches):
            for b in batches:
                x = _x(b, n)
                for t, (top, group, _) in enumerate(tops):
                    at = walk(top, col, x, np.zeros(len(x), dtype=np.int64))
                    keep = group[at]
                    if keep.any():
                        ids = [np.full(keep.sum(), t, dtype=np.int32), top.heap[at[keep]]]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, [*ids, *x[keep].T])], names=["tree", "grp", *names])

        def low(rows, nodes):
            nodes = nodes.sort_by("node")
            top = _top(nodes.column("node").to_numpy(), nodes.column("slot").fill_null(-1).to_numpy())
            found = np.zeros((0, k), dtype=np.int64)
            if rows.num_rows:
                at = walk(top, col, _x(rows, n), np.zeros(rows.num_rows, dtype=np.int64))
                found = _votes(_matrix(nodes, "stats"))[at]
            return pa.table([*[rows.column(c) for c in names], *map(pa.array, found.T)], names=[*names, *votes])

        shares = 1 + df.count() // SHARE_ROWS
        share = F.pmod(F.xxhash64(*names), F.lit(shares)).cast("int").alias("share")
        keyed = df.withColumns(slot_columns([(F.col(f"`{c}`"), s) for c, s in zip(self.features, self.sizes)]))
        distinct = keyed.select(*names).distinct()
        dealt = distinct.mapInArrow(deal, f"tree int, grp long, {_ints(n).removesuffix(', ')}").select("*", share).groupBy("tree", "grp", "share")
        parts = self.nodes().filter("grp > 0").select("tree", "grp", "node", "slot", "stats", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
        found = dealt.cogroup(parts.groupBy("tree", "grp", "share")).applyInArrow(low, schema)
        if any((~group & (top.slot < 0)).any() for top, group, _ in tops):
            found = found.union(distinct.mapInArrow(high, schema))
        sums = found.groupBy(*names).agg(*[F.sum(v).alias(v) for v in votes])
        raw, total = F.array(*[F.col(v) / VOTE for v in votes]), sum((F.col(v) for v in votes[1:]), F.col(votes[0]))
        most = F.array_position(F.array(*votes), F.greatest(*votes) if k > 1 else F.col(votes[0])) - 1
        shown = sums.select(
            *names,
            array_to_vector(raw).alias("rawPrediction"),
            array_to_vector(F.array(*[F.col(v) / total for v in votes])).alias("probability"),
            most.cast("double").alias("prediction"),
        )
        return keyed.join(shown, names).drop(*names)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _votes(stats: np.ndarray) -> np.ndarray:
    """Class shares as whole numbers of 1 / VOTE; no counts, no vote."""
    return np.rint(stats / np.maximum(stats.sum(axis=1, keepdims=True), 1) * VOTE).astype(np.int64)


class _Writer(MLWriter):
    def __init__(self, model: DeepForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"features": m.features, "sizes": m.sizes, "classes": m.classes, "trees": m.num_trees})
        m.nodes().write.parquet(f"{path}/data")


class _Reader(MLReader):
    def load(self, path: str) -> DeepForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = DeepForestModel(f"{path}/data", meta["features"], meta["sizes"], meta["classes"], meta["trees"])
        m._resetUid(meta["uid"])
        m.owned = False
        return m
