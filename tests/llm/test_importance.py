import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from catlens.llm.importance import BUCKETS, PRIOR, TEMPERATURE, fit, ngrams, resample, sample_key
from catlens.llm.shared import kth_largest, text_buffers
from pyspark.sql import functions as F


def corpus():
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(500):
        text = [f"{rng.choice('abcde')}word{rng.randrange(3000)}" for _ in range(rng.choice([15, 80, 300]))]
        good = i % 6 != 0
        if not good:
            kind = rng.randrange(3)
            text = [w.upper() + "!!" for w in text] if kind == 0 else [w + rng.choice(["***", "%%%"]) for w in text] if kind == 1 else [w for w in text[: len(text) // 5] for _ in range(5)]
        docs.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, int(good), 0))
        elif i % 12 == 0:
            labels.append((i, int(good), 0))
    return docs, labels


def test_rejects_junk_and_keeps_clean(spark, make_docs):
    docs, labels = corpus()
    table = spark.createDataFrame(labels + [(None, 0, 0), (7, None, 0), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    got = resample(make_docs(docs + [(1000, None), (1001, "")]), table)
    again = {r.doc_id: r.selected for r in got.collect()}
    assert {r.doc_id: r.selected for r in got.collect()} == again and len(again) == 502
    clean, junk = [again[i] for i in range(500) if i % 6], [again[i] for i in range(0, 500, 6)]
    assert sum(clean) / len(clean) > 0.98 and sum(junk) / len(junk) < 0.1


def test_edges(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resample(make_docs([]), none).count() == 0
    rows = resample(make_docs([(1, "a b"), (1, "a b"), (None, None)]), none).collect()
    assert [r.selected for r in rows] == [True] * 3


def test_given_k(spark, make_docs):
    docs, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for k in (-1, 0, 100, 500, 9999):
        rows = resample(make_docs(docs), table, k=k).collect()
        keys = sorted((r.sample_key for r in rows), reverse=True)
        assert sum(r.selected for r in rows) == min(max(k, 0), 500)
        assert all(r.selected == (k > 0 and r.sample_key >= keys[min(k, 500) - 1] - 1e-6) for r in rows)
    # among clean rows it is the noise that decides, not only the weight
    drawn = [{r.doc_id for r in resample(make_docs(docs), table, k=100, seed=s).where("selected").collect()} for s in (1, 2)]
    assert 5 < len(drawn[0] & drawn[1]) < 60


def test_inclusion_frequencies(spark):
    """Over 1,500 seeds rows are drawn as often as by successive draws in proportion to exp(weight / temperature)."""
    weights, k, seeds = [0.02 * i - 0.1 for i in range(20)], 6, 1500
    rows = spark.createDataFrame([(i, f"t{i}", w) for i, w in enumerate(weights)], "doc_id long, text string, w double")
    rows = rows.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    keys = rows.select("doc_id", "seed", sample_key(F.col("w"), F.col("doc_id"), F.col("text"), F.col("seed"), TEMPERATURE).alias("key")).toPandas()
    top = keys.sort_values("key", ascending=False).groupby("seed").head(k)
    got = top["doc_id"].value_counts().reindex(range(20), fill_value=0).to_numpy() / seeds
    rng, want = random.Random(5), np.zeros(20)
    for _ in range(6000):
        left = list(range(20))
        for _ in range(k):
            i = rng.choices(left, [math.exp(weights[j] / TEMPERATURE) for j in left])[0]
            left.remove(i)
            want[i] += 1 / 6000
    assert abs(got - want).max() < 0.05
    assert 0 < got[5] < got[-1] < 1


def test_weights_against_brute_force(spark, make_docs):
    docs, labels = corpus()
    docs = docs + [(1000, None), (1001, ""), (1002, " ".join(f"long{i % 977}" for i in range(200_000)))]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fitted = {r.doc_id for r in table.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)) != 0).where("quality = 1").collect()}
    own = {}
    for i, text in docs:
        own[i] = Counter(ngrams(*text_buffers(pa.array([text or ""])))[0].tolist())
    raw, good = Counter(), Counter()
    for i, found in own.items():
        raw.update(found)
        if i in fitted:
            good.update(found)
    n_raw, n_good = raw.total() + BUCKETS, good.total() + BUCKETS
    rows = {r.doc_id: r for r in resample(make_docs(docs), table).collect()}
    for i, found in own.items():
        total = sum(n * (math.log((good[b] + 1) / n_good) - math.log((raw[b] + 1) / n_raw)) for b, n in found.items())
        assert rows[i].log_weight == pytest.approx(total / (found.total() + PRIOR), abs=1e-9)
    cut = fit(make_docs(docs), table).cut
    k = sum(r.log_weight >= cut for r in rows.values())
    assert {i for i, r in rows.items() if r.selected} == set(sorted(rows, key=lambda i: -rows[i].sample_key)[:k])


@pytest.mark.parametrize("k", [1, 2, 50, 499, 500])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.randrange(-(2**63), 2**63), rng.randrange(-5, 5)]) for _ in range(500)]
    assert kth_largest(spark.createDataFrame([(v,) for v in values], "x long"), "x", k) == sorted(values, reverse=True)[k - 1]
