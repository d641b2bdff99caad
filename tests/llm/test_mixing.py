import hashlib
import random

import pytest
from catlens.llm.mixing import budgets, mix


def fill(given, children):
    """children: (capacity, weight); repeated proportional sharing until nothing is over capacity."""
    out, open_ = [0.0] * len(children), set(range(len(children)))
    rest = given
    while open_:
        total = sum(children[i][1] for i in open_)
        over = {i for i in open_ if children[i][0] <= rest * children[i][1] / total * (1 + 1e-12)}
        if not over:
            for i in open_:
                out[i] = rest * children[i][1] / total
            break
        for i in over:
            out[i] = children[i][0]
        rest -= sum(children[i][0] for i in over)
        open_ -= over
    return out


def brute_budgets(leaves, total, epochs, weights):
    w = lambda level, name: weights.get(level, {}).get(name, 1.0)
    cap = lambda want: sum(t * epochs for *p, t in leaves if tuple(p[: len(want)]) == want)
    level = {(): float(min(total, cap(())))}
    for i, name in enumerate(("domain", "lang", "source")):
        nxt = {}
        for parent, given in level.items():
            kids = sorted({tuple(p[: i + 1]) for *p, _ in leaves if tuple(p[:i]) == parent})
            for k, b in zip(kids, fill(given, [(cap(k), w(name, k[-1])) for k in kids]), strict=True):
                nxt[k] = b
        level = nxt
    return {k: int(b + 1e-6) for k, b in level.items()}


@pytest.mark.parametrize("total", [0, 500, 9000, 10**9])
def test_budgets_equal_repeated_sharing(spark, total):
    rng = random.Random(total)
    leaves = [(f"d{rng.randrange(3)}", f"l{i % 4}", f"s{i}", rng.choice([0, 1, 10, 200, 3000])) for i in range(40)]
    weights = {"domain": {"d0": 5.0, "d2": 0.5}, "lang": {"l1": 3.0}, "source": {"s3": 9.0}}
    got = budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), total, max_epochs=2, weights=weights).collect()
    assert {(r.domain, r.lang, r.source): r.budget for r in got} == brute_budgets(leaves, total, 2, weights)
    with pytest.raises(ValueError):
        budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), 5, weights={"lang": {"l1": 0}})


def test_prefixes_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 60, 700]), rng.choice(["en", "de", None]), rng.choice(["web1", "web2", "book", None, " "]), 3, "clash") for i in range(300)]
    rows += [(None, "no id here", "en", "web1", 1, "x"), (17, rows[17][1], rows[17][2], rows[17][3], 0, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_tokens long, cut string")
    got = mix(docs, share=0.7, max_epochs=3)
    assert got.columns[:4] == ["doc_id", "text", "lang", "source"] and "cut" in got.columns
    got = got.collect()
    assert len(got) == len(rows)
    node = lambda s: s if s and s.strip() else "none"
    leaf = lambda s, l: ("".join(c for c in s or "" if c.isalpha()) or "none", node(l), node(s))
    tokens, by_leaf = {}, {}
    for d, t, l, s, *_ in rows:
        tokens[leaf(s, l)] = tokens.get(leaf(s, l), 0) + len(t.split())
        by_leaf.setdefault(leaf(s, l), []).append((d, len(t.split())))
    plan = brute_budgets([(*k, v) for k, v in tokens.items()], 0.7 * sum(tokens.values()), 3, {})
    want = []
    for k, members in by_leaf.items():
        epochs = plan[k] // tokens[k] if tokens[k] else 0
        rest = plan[k] - epochs * tokens[k]
        key = lambda d: hashlib.md5(f"5:{epochs}:{'' if d is None else d}".encode()).hexdigest()  # noqa: B023, E731
        for d, n in members:
            before = sum(m for e, m in members if key(e) < key(d))
            want.append((d, n, plan[k], epochs + (1 if tokens[k] and before < rest else 0)))
    assert sorted(((r.doc_id, r.mix_tokens, r.mix_budget, r.mix_copies) for r in got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
