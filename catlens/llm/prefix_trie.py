"""Operator 12: the prefix trie of conversations, from ternary search trees per range shard.

A turn is 20 bytes: the MD5 of its role and text and the byte length of its text, so a conversation is a
byte string whose order is that of its turns, and texts are never shuffled. Conversations are sorted
by (turns, conv_id) over range partitions; many equal conversations lie side by side and may fill several
partitions. A partition is cut into shards of `SHARD_TURNS` turns. In a shard the turns are encoded by a dictionary
(their order is kept), and the distinct conversations are inserted into a ternary search tree, the median first, so that siblings
form balanced trees. A node of the tree is a node of the trie. Children are made after their parents, so one loop back over the
nodes adds up members, leaves and savings.

A node can lie in several shards only if it is on the path of a shard's first or last conversation. Those boundary nodes
leave the shard open, named by the MD5 of their path, with the sums of their closed children. `MERGED`
neighbouring partitions at a time are then merged: equal open nodes are added up, and what lies on neither the first nor
the last path of the merged range is closed from the deepest node up. The rounds end when one range is left; their
number is the logarithm of the number of partitions, and a task holds two paths a shard. Conversations that end in an open node send their ids as
short texts, which one pass hashes in order of conv_id.

One conversation is held whole in a task, as 20 bytes a turn.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, partitions, saved

UNIT = 20
#: A tree is built of at most about this many turns (or of one longer conversation).
SHARD_TURNS = 100_000
#: Partitions aimed at hold this many turns.
PARTITION_TURNS = 400_000
#: Partitions merged in one task of a round.
MERGED = 64
#: Conversation ids in one text of a node's ends.
ENDS = 512
FAMILY = 5
SHARED_TURNS = 9

FINAL, LOOSE, OPEN, IDS = range(4)
ROOT = hashlib.md5(b"root").digest()

_ROW = pa.schema(
    [("kind", pa.int8()), ("node", pa.binary()), ("parent", pa.binary()), ("shard", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_bytes")]
    + [("first", pa.bool_()), ("last", pa.bool_()), ("ends", pa.string())]
)
_DDL = (
    "kind tinyint, node binary, parent binary, shard long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, n_bytes long, first boolean, last boolean, ends string"
)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROW)], schema=_ROW)


def child_name(name: bytes, unit: bytes) -> bytes:
    return hashlib.md5(name + unit).digest()


def n_shared(conv_id: int) -> int:
    """How many of the first turns come from the family's first conversation."""
    return zlib.crc32(str(conv_id).encode()) % SHARED_TURNS


# --- conversations as byte strings ------------------------------------------------------------


def sequences(conversations: DataFrame, n: int | None = None) -> DataFrame:
    """conv_id, turns (binary, 20 bytes a turn) of every rebuilt conversation.

    Turns are ordered by number, null first; turns with equal numbers by digest. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text)
    digest = F.md5(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    unit = F.unhex(F.concat(digest, F.lpad(F.hex(size.cast("long")), 8, "0")))
    c = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id is not null").select((c - F.pmod(c, F.lit(FAMILY))).alias("family"), c.alias("conv_id"), F.col("turn").alias("number"), unit.alias("unit"))
    turns = turns.repartition(n or partitions(conversations.sparkSession), "family")
    turns = turns.sortWithinPartitions("family", "conv_id", F.col("number").asc_nulls_first(), "unit")
    schema = pa.schema([("conv_id", pa.int64()), ("turns", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, donor, conv, own = None, [], None, []

        def done() -> tuple[int, bytes]:
            h = n_shared(conv)
            return conv, b"".join(donor[:h] + own[h:])

        for batch in batches:
            out = []
            for f, c, u in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if c != conv:
                    if conv is not None:
                        out.append(done())
                    if f != family:
                        family, donor = f, []
                    conv, own = c, []
                own.append(u)
                if c == f and len(donor) < SHARED_TURNS - 1:
                    donor.append(u)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), schema)], schema=schema)
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(done(), schema)], schema=schema)

    return turns.mapInArrow(work, "conv_id long, turns binary")


# --- one shard --------------------------------------------------------------------------------


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the median of every range before the rest of it."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


class TernaryTree:
    """A ternary search tree over sequences of dictionary ids: node 0 is the empty sequence, and a
    node's eq link leads to the search tree (lo, hi) of the turns that follow it."""

    def __init__(self):
        self.turn, self.lo, self.hi, self.eq, self.up, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _new(self, turn: int, up: int) -> int:
        self.turn.append(turn)
        self.lo.append(-1)
        self.hi.append(-1)
        self.eq.append(-1)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the sequence, which is made if there is none."""
        turn, lo, hi, eq = self.turn, self.lo, self.hi, self.eq
        at = 0
        for x in sequence:
            links, link, here = eq, at, eq[at]
            while here >= 0 and turn[here] != x:
                links, link = (lo, here) if x < turn[here] else (hi, here)
                here = links[link]
            if here < 0:
                here = self._new(x, at)
                links[link] = here
            at = here
        return at

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of all prefixes of an inserted sequence, the root first."""
        at, out = self.insert(sequence), []
        while at >= 0:
            out.append(at)
            at = self.up[at]
        return out[::-1]


def _shard(number: int, convs: list[tuple[bytes, list[int]]]) -> list[tuple]:
    """Rows of one shard: convs are its distinct sequences in order, with the ascending ids of each."""
    units = [[s[i : i + UNIT] for i in range(0, len(s), UNIT)] for s, _ in convs]
    names = sorted({u for x in units for u in x})
    code = {u: i for i, u in enumerate(names)}
    coded = [[code[u] for u in x] for x in units]
    tree = TernaryTree()
    ending = [(tree.insert(coded[i]), i) for i in medians(len(convs))]
    ends = dict(ending)
    n = len(tree.turn)
    members, least, children, leaves, savings = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for v, i in ends.items():
        members[v], least[v] = len(convs[i][1]), convs[i][1][0]
    size = [int.from_bytes(u[16:], "big") for u in names]
    paths = [tree.path(coded[0]), tree.path(coded[-1])]
    name = {0: ROOT}
    for path in paths:
        for v in path[1:]:
            name[v] = child_name(name[tree.up[v]], names[tree.turn[v]])
    on_first, on_last = map(set, paths)
    up, turn, depth = tree.up, tree.turn, tree.depth
    for v in range(n - 1, 0, -1):
        p = up[v]
        members[p] += members[v]
        if least[p] is None or least[v] < least[p]:
            least[p] = least[v]
        if v in name:
            continue
        leaves[v] = leaves[v] or 1
        savings[v] += (members[v] - 1) * size[turn[v]]
        children[p] += 1
        leaves[p] += leaves[v]
        savings[p] += savings[v]
    out = []
    for v in range(n):
        p = up[v]
        sums = (members[v], children[v], leaves[v], savings[v])
        if v in name:
            out.append((OPEN, name[v], name.get(p), number, least[v], depth[v], None, *sums, size[turn[v]] if v else 0, v in on_first, v in on_last, None))
            ids = convs[ends[v]][1] if v in ends else []
            for i in range(0, len(ids), ENDS):
                out.append((IDS, name[v], None, None, ids[i], *[None] * 9, ",".join(map(str, ids[i : i + ENDS]))))
        else:
            ids = hashlib.sha256(",".join(map(str, convs[ends[v]][1])).encode()).hexdigest() if v in ends else None
            kind, above = (LOOSE, None) if p in name else (FINAL, least[p])
            out.append((kind, None, name.get(p), None, least[v], depth[v], above, *sums, None, None, None, ids))
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (partition, turns, conv_id) rows to trie rows, shard by shard."""
    convs, held, number = [], 0, None
    for batch in batches:
        for part, turns, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            number = part << 32 if number is None else number
            if convs and convs[-1][0] == turns:
                convs[-1][1].append(conv)
                held += 1
            else:
                convs.append((turns, [conv]))
                held += 1 + len(turns) // UNIT
            if held >= SHARD_TURNS:
                yield _rows(_shard(number, convs))
                convs, held, number = [], 0, number + 1
    if convs:
        yield _rows(_shard(number, convs))


# --- boundary nodes ---------------------------------------------------------------------------


def _merged(rows: list[dict], final: bool) -> list[tuple]:
    """Open nodes of neighbouring shards, added up; those off the first and last path are closed (all of them if final)."""
    low, high = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
    nodes: dict[bytes, dict] = {}
    for r in rows:
        first, last = r["first"] and r["shard"] == low, r["last"] and r["shard"] == high
        have = nodes.get(r["node"])
        if have is None:
            nodes[r["node"]] = {**r, "first": first, "last": last}
            continue
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            have[c] += r[c]
        have["conv_id"] = min(have["conv_id"], r["conv_id"])
        have["first"], have["last"] = have["first"] or first, have["last"] or last
    out, closed = [], []
    for r in sorted(nodes.values(), key=lambda x: -x["depth"]):
        if not final and (r["first"] or r["last"]):
            # a range has a first and a last path of its own: both are marked by its least shard number
            out.append((OPEN, r["node"], r["parent"], low, r["conv_id"], r["depth"], None, *(r[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_bytes")), r["first"], r["last"], None))
            continue
        r["n_leaves"] = r["n_leaves"] or 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["n_bytes"]
        above = nodes.get(r["parent"])
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
        closed.append((r, above))
    for r, above in closed:
        settled = above is None or final or not (above["first"] or above["last"])
        kind, conv = (FINAL, above and above["conv_id"]) if settled else (LOOSE, None)
        out.append((kind, r["node"], r["parent"], None, r["conv_id"], r["depth"], conv, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], None, None, None, None))
    return out


def _merge(final: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            groups = batch.column(0).to_pylist()
            for g, r in zip(groups, batch.drop_columns(["group"]).to_pylist()):
                if g != group and rows:
                    yield _rows(_merged(rows, final))
                    rows = []
                group = g
                rows.append(r)
        if rows:
            yield _rows(_merged(rows, final))

    return work


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, conv_id, ends) in order to (node, sha256); a node's ids are never held together."""
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
    node, state = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((node, state.hexdigest()))
            node, state = k, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((node, state.hexdigest()), schema)], schema=schema)


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text).

    Null roles and texts are empty; a null turn comes first, and equal turn numbers are ordered by digest, so repeated rows
    are repeated turns. Rows with a null conv_id belong to no conversation. An empty table has no node,
    not even a root. Other columns are not read, whatever their names. shards: range partitions (by default from the number of turns).
    """
    spark = conversations.sparkSession
    convs = saved(sequences(conversations), "trie-sequences")
    if shards is None:
        turns = convs.agg(F.sum(F.octet_length("turns")).alias("n")).first()["n"] or 0
        shards = max(1, min(partitions(spark), turns // UNIT // 10_000), -(-turns // UNIT // PARTITION_TURNS))
    by_range = convs.repartitionByRange(shards, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    built = saved(by_range.select(F.spark_partition_id().alias("part"), "turns", "conv_id").mapInArrow(_build, _DDL), "trie-shards")
    parts = [built]
    drop(convs)
    opened = built.where(F.col("kind") == OPEN)
    top = opened.agg(F.max(F.shiftright("shard", 32)).alias("m")).first()["m"]
    left, width = 1 if top is None else top + 1, 1
    while True:
        width *= MERGED
        final = width >= left
        group = F.floor(F.shiftright(F.col("shard"), 32) / F.lit(width)).alias("group")
        rows = opened.select(group, *opened.columns)
        rows = rows.repartition(max(1, min(partitions(spark), -(-left // width))), "group").sortWithinPartitions("group", "shard")
        merged = saved(rows.mapInArrow(_merge(final), _DDL), "trie-merged")
        parts.append(merged)
        opened = merged.where(F.col("kind") == OPEN)
        if final:
            break
    ids = built.where(F.col("kind") == IDS).select("node", "conv_id", "ends")
    ids = ids.repartition(partitions(spark), "node").sortWithinPartitions("node", "conv_id")
    ends = saved(ids.mapInArrow(_hash_ends, "node binary, ends string"), "trie-ends")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    # settled rows need no parent; the others find it among the closed boundary nodes (a table as big as two paths a shard)
    settled = built.where(F.col("kind") == FINAL).select(*out, "ends")
    loose = built.where(F.col("kind") == LOOSE).select("parent", *out, "ends")
    closed = functools.reduce(DataFrame.unionByName, parts[1:]).where(F.col("kind").isin(FINAL, LOOSE))
    named = closed.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    closed = closed.drop("ends").join(ends, "node", "left")
    settled = settled.unionByName(closed.where(F.col("kind") == FINAL).select(*out, "ends"))
    loose = loose.unionByName(closed.where(F.col("kind") == LOOSE).select("parent", *out, "ends")).join(named, "parent", "left")
    rows = settled.unionByName(loose.withColumn("parent_conv_id", F.col("above")).select(*out, "ends"))
    return rows.withColumn("ends_sha256", F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest()))).drop("ends")
