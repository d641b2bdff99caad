"""Operator 5: mixing sources to target weights by hierarchical budgets.

Documents hang in a tree domain > language > source. A total of tokens is handed down by weight; what
a leaf can give is its tokens times max_epochs. Where a share exceeds what its subtree can give, the
rest goes to its siblings by their weights, and only if all of them are exhausted to the siblings of
their parent. With exact capacities of all subtrees this is one water-filling per parent: the level L
with sum(min(capacity, L * weight)) = budget, found by cumulative sums over children in the order of
capacity / weight. A leaf then takes whole epochs and the token-prefix of the next one: documents in
the order of md5(seed:epoch:doc_id), up to the budget. Prefixes come from sums by leaf and key prefix,
so a hot leaf is never sorted in one task; only the one key range in which a leaf's budget ends is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop, saved

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
#: Up to so many leaves (a row of about 100 bytes each) their budgets are broadcast to the documents.
BROADCAST_LEAVES = 100_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """nodes (parent columns, node columns, weight, capacity, given: the parent's budget) with budget."""
    by_ratio = Window.partitionBy(*parent).orderBy("ratio", *[c for c in LEVELS if c in nodes.columns and c not in parent])
    every = Window.partitionBy(*parent)
    ranked = nodes.withColumn("ratio", F.col("capacity") / F.col("weight"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("cap_before", F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast("double"))
    ranked = ranked.withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("weight_all", F.sum("weight").over(every))
    # the level if this child and all after it are not exhausted
    level = (F.col("given") - F.col("cap_before")) / F.greatest(F.col("weight_all") - F.col("weight_before"), F.lit(1e-300))
    ranked = ranked.withColumn("full", F.col("capacity") <= level * F.col("weight") * (1 + 1e-12)).withColumn("level", level)
    ranked = ranked.withColumn("at", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    budget = F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(F.least(F.col("capacity").cast("double"), F.col("at") * F.col("weight")))
    return ranked.withColumn("budget", budget).drop("ratio", "cap_before", "weight_before", "weight_all", "full", "level", "at")


def budgets(leaves: DataFrame, total: float | None = None, share: float = 0.5, max_epochs: int = 2, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """domain, lang, source, tokens, budget (long) of every leaf of leaves (domain, lang, source, tokens).

    total is the number of tokens wanted (default: `share` of all tokens); more than max_epochs of everything isn't given.
    weights holds weights by level and node name; a missing one is 1. Weights must be positive.
    """
    weights = weights or {}
    if any(w <= 0 for level in weights.values() for w in level.values()):
        raise ValueError("weights must be positive")

    def weight(level: str) -> Column:
        own = weights.get(level, {})
        if not own:
            return F.lit(1.0)
        table = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])
        return F.coalesce(table[F.col(level)], F.lit(1.0)).cast("double")

    base = leaves.select(*LEVELS, F.col("tokens"), (F.col("tokens") * max_epochs).alias("capacity"))
    # the total is one number: it joins as a column of a one-row aggregate of the leaves
    everything = base.agg(F.sum("tokens").alias("t"), F.sum("capacity").alias("c")).first()
    wanted = float(total) if total is not None else share * float(everything["t"] or 0)
    given = F.lit(min(wanted, float(everything["c"] or 0)))
    parent: DataFrame | None = None
    for i, level in enumerate(LEVELS):
        cols = list(LEVELS[: i + 1])
        nodes = base.groupBy(*cols).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight(level))
        nodes = nodes.withColumn("given", given) if parent is None else nodes.join(parent, cols[:-1])
        filled = _filled(nodes, cols[:-1])
        parent = filled.select(*cols, F.col("budget").alias("given"))
    return filled.select(*LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix(docs: DataFrame, domain: Column | None = None, total: float | None = None, share: float = 0.5, max_epochs: int = 2, weights: dict[str, dict[str, float]] | None = None, seed: int = 5) -> DataFrame:
    """All rows and columns of docs with mix_domain, mix_tokens (words), mix_budget (of the leaf) and mix_copies (times taken).

    domain is a string column (default: the letters that source begins with). Null or blank tree columns are the node
    'none'; rows without words cost nothing and are taken with their key's turn; rows that share a doc_id are taken together;
    null doc_ids share one key. A document is taken if the tokens before it in its epoch's order are fewer
    than the budget left, so a leaf exceeds its budget by less than one document. An empty table gives no rows.
    """
    name = lambda c: F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), F.lit("none"))
    domain = domain if domain is not None else F.regexp_extract(F.col("source").cast("string"), "^[A-Za-z]+", 0)
    tree = [name(domain).alias("domain"), name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source")]
    rows = docs.select(*tree, F.col("doc_id").cast("long").alias("doc_id"), token_count(F.col("text").cast("string")).alias("n"))
    rows = saved(rows, "mix")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    plan_table = saved(budgets(leaves, total, share, max_epochs, weights), "budgets")
    plan = plan_table.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0))

    keyed = rows.join(plan.where("rest > 0").select(*LEVELS, "epochs", "rest"), list(LEVELS))
    keyed = keyed.withColumn("key", _key(seed, F.col("epochs"), F.col("doc_id"))).withColumn("slot", F.substring("key", 1, 3))
    slots = keyed.groupBy(*LEVELS, "rest", "slot").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy(*LEVELS).orderBy("slot")
    slots = slots.withColumn("end", F.sum("n").over(so_far)).withColumn("begin", F.col("end") - F.col("n"))
    last = slots.where("begin < rest").groupBy(*LEVELS).agg(F.max(F.struct("slot", "begin")).alias("l")).select(*LEVELS, F.col("l.slot").alias("slot"), F.col("l.begin").alias("begin"))
    inside = keyed.join(last, [*LEVELS, "slot"]).groupBy(*LEVELS, "rest", "begin", "key").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("begin") + F.coalesce(F.sum("n").over(order), F.lit(0)))
    cuts = saved(inside.where("before < rest").groupBy(*LEVELS).agg(F.max("key").alias("cut")), "cuts")

    m = [f"mix_{c}" for c in LEVELS]
    epochs, cut = "mix_epochs_", "mix_cut_"
    decided = plan.join(cuts, list(LEVELS), "left").select(*(F.col(c).alias(x) for c, x in zip(LEVELS, m, strict=True)), F.col("budget").alias("mix_budget"), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    decided = saved(decided, "decided")
    drop(rows, plan_table, cuts)
    if decided.count() <= BROADCAST_LEAVES:
        decided = F.broadcast(decided)  # so the texts stay where they are
    bare = docs.drop("mix_budget", "mix_tokens", "mix_copies", epochs, cut, *m)
    named = bare.withColumns(dict(zip(m, tree, strict=True)))
    joined = named.join(decided, m, "left")
    taken = F.coalesce(_key(seed, F.col(epochs), F.col("doc_id").cast("long")) <= F.col(cut), F.lit(False))
    joined = joined.withColumn("mix_copies", (F.col(epochs) + taken.cast("long")).cast("long")).withColumn("mix_tokens", token_count(F.col("text").cast("string")))
    return joined.select(*bare.columns, "mix_domain", "mix_tokens", "mix_budget", "mix_copies")
