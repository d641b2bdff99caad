"""Labels (D1, D2, E1-E4) and splits (G1-G3): invariants and partition independence."""

import math

import pytest
from pyspark.sql import functions as F

from catlens.config import FIXTURE_CONFIG as CFG
from catlens.operators import labels, splits
from catlens.operators.cleaning import clean, require_rows
from catlens.plans import job
from catlens.sources.tickets import tickets_raw

from conftest import SF001, SF01


def test_top_k_ties_break_by_code(spark):
    df = spark.createDataFrame([(c,) for c in [5, 5, 3, 3, 9, 9, 1]], "violation_code int")
    freq = labels.code_frequency(df, "violation_code")
    assert labels.collect_top_codes(freq, "violation_code", 2) == [3, 5]
    assert labels.collect_top_codes(freq, "violation_code", 10) == [3, 5, 9, 1]


def test_majority_baseline_golden(spark):
    prep = job.prepare(tickets_raw(spark, SF01), CFG)
    n, top, base = prep.baseline.first()
    assert (n, top) == (14238, 7783)
    assert base == pytest.approx(7783 / 14238)
    counts = {r[0]: r[1] for r in prep.counts.collect()}
    assert counts["OTHER"] == 7783 and counts["0"] == 2569 and len(counts) == 9


def test_require_rows_raises():
    with pytest.raises(ValueError):
        require_rows(0)
    assert require_rows(3) == 3


def test_hash_split_disjoint_and_complete(spark):
    prep = job.prepare(tickets_raw(spark, SF01), CFG)
    train, test = prep.split()
    ids_train = {r[0] for r in train.select("row_id").collect()}
    ids_test = {r[0] for r in test.select("row_id").collect()}
    assert not ids_train & ids_test
    assert len(ids_train) + len(ids_test) == 14238
    assert (len(ids_train), len(ids_test)) == (11353, 2885)


def _stratified_ids(spark, df, bucket_bits=None):
    prep = job.prepare(df, CFG.with_(split="stratified"))
    train, test = splits.sides(splits.assign_stratified(prep.labelled, CFG.label_col, 0.2, "row_id", bucket_bits))
    return prep, train, test


@pytest.mark.parametrize("bits", [None, 1, 4, 12])
def test_stratified_split_exact_quota_any_bucketing(spark, bits):
    prep, train, test = _stratified_ids(spark, tickets_raw(spark, SF01), bits)
    counts = {r[0]: r[1] for r in prep.counts.collect()}
    got = {r[0]: r[1] for r in test.groupBy(CFG.label_col).count().collect()}
    for lab, n in counts.items():
        assert got.get(lab, 0) == int(n * 0.2 + 0.5), lab
    tr = {r[0] for r in train.select("row_id").collect()}
    te = {r[0] for r in test.select("row_id").collect()}
    assert not tr & te and len(tr) + len(te) == sum(counts.values())


def test_stratified_rows_independent_of_bucketing(spark):
    raw = tickets_raw(spark, SF01)
    ref = None
    for bits in (2, 8, 16):
        _, _, test = _stratified_ids(spark, raw, bits)
        ids = sorted(r[0] for r in test.select("row_id").collect())
        ref = ref or ids
        assert ids == ref


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_splits_do_not_depend_on_partitioning(spark, parts):
    raw = tickets_raw(spark, SF001)
    base = job.prepare(raw, CFG)
    b_tr, b_te = base.split()
    p = job.prepare(raw.repartition(parts), CFG)
    p_tr, p_te = p.split()
    assert sorted(r[0] for r in p_te.select("row_id").collect()) == sorted(r[0] for r in b_te.select("row_id").collect())
    assert p.labeller.top_codes == base.labeller.top_codes
    s = CFG.with_(split="stratified")
    s_a = job.prepare(raw, s).split()[1]
    s_b = job.prepare(raw.repartition(parts), s).split()[1]
    assert sorted(r[0] for r in s_a.select("row_id").collect()) == sorted(r[0] for r in s_b.select("row_id").collect())


def _assigned(prep):
    rows = prep.assign()
    n = rows.count()
    assert n == prep.labelled.count()
    assert rows.drop(splits.IS_TEST).exceptAll(prep.labelled).count() == 0
    return n, rows.filter(splits.IS_TEST).count()


def _hot(raw, share=3):
    """A third of the rows are copies of one row."""
    one = raw.filter("code_raw = '0'").orderBy("row_id").first().asDict()
    return raw.withColumns({c: F.when(F.col("row_id") % share == 0, F.lit(one[c])).otherwise(F.col(c)) for c in raw.columns if c != "row_id"})


@pytest.mark.parametrize("split", ["hash", "stratified"])
@pytest.mark.parametrize("kind", ["null", "repeated", "missing", "all_null"])
def test_no_row_is_lost(spark, split, kind):
    raw = _hot(tickets_raw(spark, SF001))
    cfg = CFG.with_(split=split, key_col=None if kind == "missing" else "row_id")
    if kind == "null":
        raw = raw.withColumn("row_id", F.when(F.col("row_id") % 3 != 0, F.col("row_id")))
    elif kind == "repeated":
        raw = raw.withColumn("row_id", F.col("row_id") % 200)
    elif kind == "all_null":
        raw = raw.withColumn("row_id", F.lit(None).cast("long"))
    elif kind == "missing":
        raw = raw.drop("row_id")
    prep = job.prepare(raw, cfg)
    n, test = _assigned(prep)
    if split == "stratified":
        counts = {r[0]: r[1] for r in prep.counts.collect()}
        got = {r[0]: r[1] for r in prep.split()[1].groupBy(cfg.label_col).count().collect()}
        assert {k: got.get(k, 0) for k in counts} == {k: int(v * 0.2 + 0.5) for k, v in counts.items()}
    elif kind in ("missing", "repeated"):
        assert abs(test / n - 0.2) < 0.05
    else:
        assert 0 < test < n


@pytest.mark.parametrize("fraction", [0.0, 0.004, 0.2, 0.5, 0.996, 1.0])
def test_any_share_is_met(spark, fraction):
    n, test = _assigned(job.prepare(tickets_raw(spark, SF01), CFG.with_(test_fraction=fraction)))
    assert abs(test - n * fraction) <= 4 * math.sqrt(n * fraction * (1 - fraction)) + 1e-9


def test_whole_percents_keep_their_rows(spark):
    prep = job.prepare(tickets_raw(spark, SF01), CFG)
    old = prep.labelled.filter(F.col("_split_h") % 100 >= 80).select("row_id")
    new = prep.split()[1].select("row_id")
    assert old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0


def test_copies_are_shared_out(spark):
    """n copies of a row: floor((n * (M - T) + rank) / M) of them are test."""
    rows = [(n, h) for n in (1, 2, 3, 5, 49, 1000) for h in (0, 79, 4_000_000_080, 4_294_967_295)]
    df = spark.createDataFrame([(f"r{n}-{h}", h) for n, h in rows for _ in range(n)], "v string, _split_h long")
    got = {r["v"]: (r["n"], r["t"]) for r in splits.assign_hash(df, 0.2, keyed=False).groupBy("v").agg(F.count("v").alias("n"), F.sum(F.col(splits.IS_TEST).cast("int")).alias("t")).collect()}
    t = splits.rank_threshold(0.2)
    for n, h in rows:
        rank = (h % 100) * splits.RANK_BLOCK + h // 100
        assert got[f"r{n}-{h}"] == (n, (n * (splits.RANKS - t) + rank) // splits.RANKS)


def test_expansion_in_chunks(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 250), ("c", 3, 7), ("d", 4, -2)], "v string, _split_h long, n long")
    for chunk in (1, 3, 100):
        out = splits.expand_copies(df, F.col("n"), 4, True, chunk)
        assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {"b": 250, "c": 7}


def test_materialize_modes(spark, tmp_dir):
    import os

    df = clean(tickets_raw(spark, SF001), CFG)
    n = df.count()
    c = splits.materialize(df, "cache")
    assert c.count() == n
    c.unpersist()
    path = os.path.join(tmp_dir, "copy")
    k = splits.materialize(df, "checkpoint", path)
    assert k.count() == n and k.dtypes == df.dtypes
    prep = job.prepare(tickets_raw(spark, SF001), CFG, materialize="checkpoint")
    assert prep.labelled.count() == n
    files = prep.cleaned.inputFiles()
    prep.release()
    assert files and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in files)


def test_stratified_split_with_copies_matches_brute_force(spark):
    """No key, every row three times: per label exactly m = floor(0.2 n + 0.5) rows are
    test, the first in (hash, content) order, computed here in plain Python."""
    raw = tickets_raw(spark, SF001).drop("row_id")
    cfg = CFG.with_(key_col=None, split="stratified")
    prep = job.prepare(raw.unionByName(raw).unionByName(raw), cfg)
    tr, te = prep.split()
    content = [cfg.code_out, cfg.hour_bucket_out, cfg.year_bucket_out, *cfg.categorical_cols]
    cols = [cfg.label_col, "_split_h", *content]
    rows = sorted(tuple(r) for r in prep.labelled.select(*cols).collect())
    by_label = {}
    for r in rows:
        by_label.setdefault(r[0], []).append(r)
    want = sorted(x for items in by_label.values() for x in items[: int(math.floor(0.2 * len(items) + 0.5))])
    assert sorted(tuple(r) for r in te.select(*cols).collect()) == want
    assert tr.count() + te.count() == len(rows)
