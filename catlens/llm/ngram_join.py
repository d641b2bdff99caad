"""Operator 3: Jaccard self-join on word n-grams by PartEnum signatures.

Sets are the distinct n-word shingles of a document. Sets of about equal size (one size band)
partition the shingle domain into cells by hash, and every cell into `PARTS` parts. A pair at or
above the threshold differs in at most K shingles, so at most K // 2 cells differ in more than one
part: the enumeration of the subsets "all parts of the cell but one" gives both sets a common
signature in every other cell. A set emits the signatures of its cells in order until K // 2 + 1 cells
had no empty subset; that is enough for each of its partners, the larger partner emits at least as much.

Signatures of empty subsets, which unrelated sets would share, are never emitted. A set whose cells run
out before enough of them are without an empty subset goes on with another hash of the domain, and so does a similar set
with the same fate; the first domain in which one of them has enough gives them a common signature. Sets for which K is 0 can
only be linked with equal ones. So no pair at or above the threshold is missed, up to 64-bit hash
collisions, and no bucket is capped.

Candidates are verified exactly on their shingle sets, after an upper bound from histograms of their hashes. Equal sets are one node from the start, a
signature that many sets of one Arrow batch share is pre-aggregated there, and a bucket compares its
members with one pivot, in ROUNDS rounds with other pivots as long as it holds several components. What is then
still apart in small buckets is compared pair by pair, in larger ones if a second exact condition holds (common rare
shingles, `_by_prefix`), so components are exact and a large group of near copies, above or below the threshold, costs comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import LONG_MIN, drop, lean, partitions, runs, saved, text_buffers
from .words import U, mix, mix_int, shingles, split_rows, word_hashes, words

PARTS = 3
DOMAINS = 32
BAND_RATIO = 1.5
#: So many sets of one Arrow batch with one signature needn't meet in one task.
CROWD = 8
#: Rows whose signatures a task holds at once.
SLICE = 3000
#: Rounds of pivots before the pairs that are left are compared.
ROUNDS = 2
#: Buckets of at most so many sets are then compared pair by pair, larger ones by prefixes.
FEW = 32


def most_different(size: int, percent: int) -> int:
    """The largest symmetric difference that a set of `size` can have with a linked set of at least its size."""
    partner = size * 100 // percent
    return (100 - percent) * (size + partner) // (100 + percent)


def cells_needed(size: int, percent: int) -> int:
    """How many cells without an empty subset a set of `size` must emit: one more than can differ in two parts."""
    return most_different(size, percent) // 2 + 1


def _band_end(low: int) -> int:
    return max(low + 1, int(low * BAND_RATIO))


def bands(size: int, percent: int) -> list[int]:
    """Lower ends of the size bands in which a set of `size` takes part: its own, and the next if a partner can lie there."""
    low = 1
    while _band_end(low) <= size:
        low = _band_end(low)
    return [low, _band_end(low)] if size * 100 // percent >= _band_end(low) else [low]


def signatures(shingle_set: np.ndarray, percent: int) -> np.ndarray:
    """The PartEnum signatures of one set of distinct 64-bit shingle hashes (none if only equal sets can be linked with it)."""
    size = len(shingle_set)
    if most_different(size, percent) == 0:
        return np.zeros(0, dtype=U)
    out = []
    for low in bands(size, percent):
        largest = cells_needed(_band_end(low), percent)
        for domain in range(DOMAINS):
            keys, enough = _cell_signatures(shingle_set, low, domain, largest + largest // 8, cells_needed(size, percent))
            out.append(keys)
            if enough:
                break
        else:
            out.append(np.array([low], dtype=U))  # such sets share one bucket: chance less than 2^-100
    return np.concatenate(out)


def _cell_signatures(shingle_set: np.ndarray, low: int, domain: int, n_cells: int, needed: int) -> tuple[np.ndarray, bool]:
    """The non-empty signatures of the first cells up to the needed-th one without an empty subset, and whether there are so many."""
    h = mix(shingle_set + U(low + (domain << 32)))
    slot = ((h >> U(32)) % U(n_cells * PARTS)).astype(np.int64)
    sums = np.zeros(n_cells * PARTS, dtype=U)
    np.add.at(sums, slot, mix(h))
    counts = np.bincount(slot, minlength=n_cells * PARTS).reshape(n_cells, PARTS)
    left = counts.sum(axis=1)[:, None] - counts
    whole = np.cumsum((left > 0).all(axis=1))
    enough = bool(whole[-1] >= needed)
    emitted = int(np.searchsorted(whole, needed)) + 1 if enough else n_cells
    sums, left = sums.reshape(n_cells, PARTS)[:emitted], left[:emitted]
    rest = sums.sum(axis=1, dtype=U)[:, None] - sums
    where = (np.arange(emitted * PARTS, dtype=U) + U((low << 32) + (domain << 26))).reshape(emitted, PARTS)
    keys = mix(mix(rest + left.astype(U) * U(0x9E3779B97F4A7C15)) ^ mix(where + U(1)))
    return keys[left > 0], enough


def shingle_sets(col: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row number, sorted distinct shingle hashes of each row) for runs of rows of a text column."""
    data, offsets = text_buffers(col)
    for i, j in runs(offsets, 1 << 18):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, rows = words(part, off)
        h, r = shingles(word_hashes(part, starts, ends), rows, j - i, size)
        yield i, [np.unique(x) for x in split_rows(h, r, j - i)]


def node_of(shingle_set: np.ndarray) -> int:
    """A 63-bit name of a set; equal sets have one name."""
    total = (int(mix(shingle_set).sum(dtype=U)) + len(shingle_set) * 0x9E3779B97F4A7C15) & (2**64 - 1)
    return mix_int(total) >> 1


def _nodes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, nodes = [], []
        for _, sets in shingle_sets(b.column("text"), size):
            counts += [len(s) for s in sets]
            nodes += [node_of(s) if len(s) else None for s in sets]
        own = [b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64())]
        yield pa.RecordBatch.from_arrays(own, ["doc_id", "k1", "k2", "n_shingles", "node"])


def _signature_rows(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """sig, node: one row per signature and distinct set of a slice of SLICE rows.

    Of a signature that CROWD sets of the slice share, only the least and the greatest node go on as
    ordinary rows; the others are known to share it and needn't meet in one task: they carry -1 - node.
    """
    for b in (x.slice(i, SLICE) for x in batches for i in range(0, x.num_rows, SLICE)):
        seen: set[int] = set()
        sigs, nodes = [], []
        for _, sets in shingle_sets(b.column("text"), size):
            for s in sets:
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    sigs.append(signatures(s, percent).view(np.int64))
                    nodes.append(np.full(len(sigs[-1]), node, dtype=np.int64))
        if not sigs:
            continue
        sig, node = np.concatenate(sigs), np.concatenate(nodes)
        del sigs, nodes
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        del order
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        length = np.diff(np.r_[first, len(sig)])
        group = np.repeat(np.arange(len(first)), length)
        place = np.arange(len(sig)) - first[group]
        crowd = (length[group] >= CROWD) & (place > 0) & (place < length[group] - 1)
        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(np.where(crowd, -1 - node, node))], ["sig", "node"])


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sig and node: the crowds' rows, and those of signatures with several nodes."""
    held_sig, held_node = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def several(sig: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        length = np.diff(np.r_[first, len(sig)])
        keep = np.repeat(node[first] != node[first + length - 1], length)
        return pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(node[keep])], ["sig", "node"])

    for b in batches:
        sig, node = b.column("sig").to_numpy(), b.column("node").to_numpy()
        crowd = node < 0
        if crowd.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[crowd]), pa.array(-1 - node[crowd])], ["sig", "node"])
        sig, node = np.r_[held_sig, sig[~crowd]], np.r_[held_node, node[~crowd]]
        if not len(sig):
            continue
        cut = np.searchsorted(sig, sig[-1])  # the last signature may go on in the next batch
        if cut:
            yield several(sig[:cut], node[:cut])
        held_sig, held_node = sig[cut:], node[cut:]
    if len(held_sig):
        yield several(held_sig, held_node)


def _set_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        nodes = b.column("node")
        for i, sets in shingle_sets(b.column("text"), size):
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32), pa.array(np.concatenate(sets).view(np.int64)))
            hists = pa.array([histogram(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([nodes.slice(i, len(sets)), lists, hists], ["node", "shingles", "hist"])


def histogram(shingle_set: np.ndarray) -> bytes:
    """How many shingles lie in each range of hashes, one byte a range; about two a range, the ranges a power of two (empty bytes: a count beyond a byte)."""
    bits = min(16, max(5, (len(shingle_set) // 2).bit_length()))
    counts = np.bincount((shingle_set >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def most_common(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """An upper bound of the number of common shingles, from two histograms: the sum of the lesser counts."""
    if not a or not b:
        return min(size_a, size_b)
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    n = min(len(x), len(y))
    return int(np.minimum(x.reshape(n, -1).sum(axis=1), y.reshape(n, -1).sum(axis=1)).sum())


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, x, y) whose histograms allow the threshold. A histogram is a tenth of its set, and pairs that only share a
    passage fail here, so the sets of few others are moved. No pair at the threshold is lost, since the bound is never below the truth."""
    hists = sets.select("node", F.size("shingles").alias("n"), "hist")
    both = pairs.join(hists.toDF("b", "nb", "hb"), "b").join(hists.toDF("a", "na", "ha"), "a").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            rows = zip(*(t.column(c).to_pylist() for c in ("ha", "hb", "na", "nb")))
            keep = [100 * (c := most_common(*r)) >= percent * (r[2] + r[3] - c) for r in rows]
            yield t.select(["a", "b", "x", "y"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y", "ha", "hb", "na", "nb").mapInArrow(lambda it: lean(work(it)), "a long, b long, x long, y long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a: a pivot, b) of nodes whose shingle sets reach the threshold.

    sets is kept partitioned by node, so only the pairs move. A pivot that meets very many nodes is a hot
    key of the last join alone, both sides of which are shuffled and can be split by adaptive execution.
    """
    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    left = sets.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (
        right.join(left, "a")
        .where(small * 100 >= large * percent)
        .where(both * 100 >= (F.size("sa") + F.size("sb") - both) * percent)
        .select("a", "b")
    )


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, node, component_id of every row of docs (doc_id long, text string).

    Two rows are linked when 100 * |intersection| >= percent * |union| of their sets of lower-cased
    `size`-word shingles (fewer words: the whole sequence is one shingle). component_id is the least
    doc_id that links reach, the row's own included. Rows with null or blank text have no shingles
    and stay alone (component_id = doc_id); equal texts are linked; rows that share a doc_id keep a
    row each and are judged by their own texts; a null doc_id is never a component's least id unless
    all its ids are null. percent lies between 70 and 100 (below, partners could skip a size band). Other columns are ignored.
    """
    return components_of(docs, size, percent).select("doc_id", "n_shingles", "node", "component_id")


def components_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """ngram_components with the row's keys k1 (doc_id) and k2 (text hash) and the component's node g (null without shingles)."""
    if not 70 <= percent <= 100:
        raise ValueError("percent must lie between 70 and 100")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = [F.coalesce("doc_id", F.lit(LONG_MIN)).alias("k1"), F.xxhash64("text").alias("k2")]
    named = saved(base.select("doc_id", "text", *key).mapInArrow(lambda it: lean(_nodes(it, size)), "doc_id long, k1 long, k2 long, n_shingles long, node long"), "nodes")

    sigs = base.select("text").mapInArrow(lambda it: lean(_signature_rows(it, size, percent)), "sig long, node long")
    meet = F.when(F.col("node") < 0, F.xxhash64("sig", "node")).otherwise(F.col("sig"))
    placed = sigs.repartition(partitions(docs.sparkSession), meet).sortWithinPartitions("sig", "node")
    shared = saved(placed.mapInArrow(lambda it: lean(_shared_rows(it)), "sig long, node long"), "signatures")

    # one document's text for each node that has a candidate
    reps = named.join(shared.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("r")).select("node", "r.k1", "r.k2")
    texts = base.where("text is not null").select("text", *key).join(reps, ["k1", "k2"]).select("node", "text")
    sets = saved(texts.mapInArrow(lambda it: lean(_set_rows(it, size)), "node long, shingles array<long>, hist binary").groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("hist").alias("hist")), "sets")
    return _link(named, shared, sets, percent)


def _link(named: DataFrame, shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rounds: the members of every open bucket that aren't yet in its pivot's component meet the pivot. Then the pairs that are left."""
    kept = sets.select("node", "shingles").repartition(partitions(sets.sparkSession), "node").persist(StorageLevel.MEMORY_AND_DISK)
    rows = shared.select("sig", "node", F.col("node").alias("root"))
    roots = tried = None
    held, used = shared, [sets]  # the written table that rows reads, and those that go at the end
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            # one pivot for all buckets of a group of near copies first, then one of each bucket's own
            order = F.xxhash64(F.lit(turn), "node") if turn == 0 else F.xxhash64(F.lit(turn), "sig", "node")
            pivot = F.min(F.struct(order, "node", "root")).alias("p")
            met = rows.join(rows.groupBy("sig").agg(pivot), "sig").where("root != p.root").select(F.col("p.node").alias("a"), F.col("node").alias("b"))
        else:
            counted = rows.join(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n")), "sig")
            few, many = counted.where(F.col("n") <= FEW), counted.where(F.col("n") > FEW)
            x, y = few.alias("x"), few.alias("y")
            pairs = x.join(y, "sig").where("x.node < y.node and x.root != y.root").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
            met = pairs.union(_by_prefix(many, kept, percent, used))
        met = met.select("a", "b", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).dropDuplicates(["x", "y"])
        met = saved(met if tried is None else met.join(tried, ["x", "y"], "left_anti"), "pairs")
        near = saved(_possible(met, sets, percent), "near")
        links = saved(_verified(near.select("a", "b"), kept, percent), "links")
        used += [met, near, links]
        tried = met.select("x", "y") if tried is None else tried.union(met.select("x", "y"))
        if roots is None or not links.isEmpty():
            roots = components(links if roots is None else links.union(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))
            if turn < ROUNDS:
                rows = _open_buckets(rows, roots)
                drop(held)
                held = rows
        if rows.isEmpty():
            break
    kept.unpersist()
    drop(held, *used)
    group = F.coalesce("root", "node").alias("g")
    placed = named.join(roots, "node", "left").select("doc_id", "k1", "k2", "n_shingles", "node", group)
    least = placed.where("g is not null").groupBy("g").agg(F.min("doc_id").alias("least"))
    out = placed.join(least, "g", "left").select("doc_id", "k1", "k2", "n_shingles", "node", F.coalesce("least", "doc_id").alias("component_id"), "g")
    out._scratch = [named]
    return out


def _by_prefix(rows: DataFrame, sets: DataFrame, percent: int, used: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) of different components among the nodes of the open buckets that may still be linked.

    Linked sets of sizes s share more than s - p elements, p = s - ceil(percent * s / 100) + 1, so in any order of all
    shingles their first p have one in common, and the first common one stands early enough for the rest to
    suffice. Here rare shingles come first: near copies below the threshold start with shingles of their
    own, which leaves too few, so they meet nobody however large their group is.
    """
    nodes = rows.select("node", "root").distinct()
    own = sets.join(nodes, "node").select("node", "root", F.size("shingles").alias("n"), "shingles")
    held = own.select("node", F.explode("shingles").alias("token"))
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = held.join(counts, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    known = known.join(own.select("node", "root", "n"), "node")
    prefix = F.expr(f"cast(n - (n * {percent} + 99) div 100 + 1 - (n - size(t)) as int)")  # shingles of its own stand before the shared ones
    first = known.withColumn("p", prefix).where("p > 0").select("node", "root", "n", F.size("t").alias("m"), F.posexplode(F.slice("t", F.lit(1), F.col("p"))).alias("i", "e"))
    used.append(first := saved(first.select("node", "root", "n", (F.col("n") - F.col("m") + F.col("i") + 1).alias("at"), F.col("e.token").alias("token")), "prefixes"))
    x, y = first.alias("x"), first.alias("y")
    # if this is the first element in common, so many can follow in each set
    enough = f"1 + least(x.n - x.at, y.n - y.at) >= ({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}"
    return x.join(y, F.col("x.token") == F.col("y.token")).where(f"x.node < y.node and x.root != y.root and {enough}").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _open_buckets(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """sig, node, root of the buckets that still hold several components."""
    now = rows.drop("root").join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
    ends = now.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("sig")
    return saved(now.join(ends, "sig", "left_semi"), "open")


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, that are first of their component (least doc_id, then least text hash).

    Rows without shingles all stay, repeated rows without shingles included; of exact repeated rows with
    shingles one stays; a row with a null doc_id comes before all others of its component.
    """
    rows = components_of(docs, size, percent)
    first = rows.where("g is not null").groupBy("g").agg(F.min(F.struct("k1", "k2")).alias("f")).select("f.k1", "f.k2")
    empty = rows.where("g is null").select("k1", "k2").distinct()
    keep = saved(first.withColumn("once", F.lit(True)).union(empty.withColumn("once", F.lit(False))), "keep")
    drop(*rows._scratch)
    own = {"keep_k1_": F.coalesce(F.col("doc_id").cast("long"), F.lit(LONG_MIN)), "keep_k2_": F.xxhash64(F.col("text").cast("string"))}
    kept = docs.withColumns(own).join(keep.select(F.col("k1").alias("keep_k1_"), F.col("k2").alias("keep_k2_"), F.col("once").alias("keep_once_")), list(own))
    once = kept.where("keep_once_").dropDuplicates(list(own))
    return once.unionByName(kept.where("not keep_once_")).select(*docs.columns)
