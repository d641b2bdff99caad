import hashlib
import random
import zlib

import catlens.llm.prefix_trie as P
import pytest


def conversations(spark, rows):
    full = [(x, r, t, c, "k", 1.5) for c, t, r, x in rows]
    return spark.createDataFrame(full, "text string, role string, turn long, conv_id long, node string, n_convs double")


def brute(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
            turns.setdefault(c, []).append(((t is not None, t or 0), digest, (r, x)))
    own = {c: [z for *_, z in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    nodes = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    children = {}
    for v in nodes:
        if v:
            children.setdefault(v[:-1], []).append(v)
    out = []
    for v, members in nodes.items():
        below = [u for u in nodes if u[: len(v)] == v]
        saved = sum((len(nodes[u]) - 1) * len(u[-1][1].encode()) for u in below if u)
        ends = ",".join(map(str, sorted(c for c in members if built[c] == v)))
        leaves = sum(u not in children for u in below)
        parent = min(nodes[v[:-1]]) if v else None
        out.append((min(members), len(v), parent, len(members), len(children.get(v, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, rows, **kw):
    return sorted((tuple(r[c] for c in COLUMNS) for r in P.prefix_trie(conversations(spark, rows), **kw).collect()), key=str)


def random_rows(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        kind = rng.random()
        for t in range(rng.choice([1, 2, 3, 5, 12])):
            x = f"hot {t}" if kind < 0.4 else rng.choice(["a", "b", "ü", None, "", f"own {c}"])
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None, "assistant"]) if kind > 0.6 else "user", x))
    rows += rng.sample(rows, 20) + [(None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == brute(rows)


def test_many_small_shards_and_rounds(spark, monkeypatch):
    """A shard, a text of ids and a merge hold next to nothing, so every node is once a boundary node."""
    monkeypatch.setattr(P, "SHARD_TURNS", 8)
    monkeypatch.setattr(P, "MERGED", 2)
    monkeypatch.setattr(P, "ENDS", 3)
    rows = random_rows(3)
    assert run(spark, rows, shards=7) == brute(rows)
    assert run(spark, rows, shards=1) == brute(rows)


def test_turnless_alone_and_deep(spark):
    rows = [(1, 0, "user", "x"), (5, 0, "user", "x"), (6, 0, "user", "x"), (6, 1, "u", "y")]
    rows += [(c, 0, "u", "t") for c in range(10, 60) if c % 5]  # no first conversation of the family: some have no turn left
    rows += [(200, t, "user", f"t{t % 7}") for t in range(3000)] + [(204, t, "user", f"t{t % 7}") for t in range(3000)]
    got = run(spark, rows)
    assert got == deep_brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def deep_brute(rows):
    """The same as brute, bottom-up, for deep paths."""
    own = {}
    for c, t, r, x in rows:
        own.setdefault(c, []).append((t, (r, x)))
    own = {c: [z for _, z in sorted(v)] for c, v in own.items()}
    name, parent, depth, size, members, ends = {}, [None], [0], [0], [[]], [[]]
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        at = 0
        members[0].append(c)
        for z in own.get(c - c % 5, [])[:h] + v[h:]:
            if (at, z) not in name:
                name[at, z] = len(parent)
                parent.append(at)
                depth.append(depth[at] + 1)
                size.append(len(z[1].encode()))
                members.append([])
                ends.append([])
            at = name[at, z]
            members[at].append(c)
        ends[at].append(c)
    n = len(parent)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for v in range(n - 1, -1, -1):
        leaves[v] = leaves[v] or 1
        saved[v] += (len(members[v]) - 1) * size[v]
        if v:
            p = parent[v]
            children[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v]
    return sorted(
        ((min(members[v]), depth[v], min(members[parent[v]]) if v else None, len(members[v]), children[v], leaves[v], saved[v], hashlib.sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest()) for v in range(n)),
        key=str,
    )


def test_a_third_in_one_leaf(spark):
    rows = [(5 * c, 0, "user", "same words") for c in range(3000)] + [(5 * c, 0, "user", f"own {c}") for c in range(3000, 9000)]
    assert run(spark, rows, shards=5) == deep_brute(rows)


def test_medians_and_tree():
    for n in (0, 1, 2, 7, 100):
        assert sorted(P.medians(n)) == list(range(n))
    tree = P.TernaryTree()
    for x in P.medians(1023):
        tree.insert([x])
    height, todo = 0, [(tree.eq[0], 1)]
    while todo:
        v, h = todo.pop()
        if v >= 0:
            height = max(height, h)
            todo += [(tree.lo[v], h + 1), (tree.hi[v], h + 1)]
    assert height == 10 and len(tree.path([512, 3])) == 3


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
