"""Operator 2: quality selection by importance resampling.

Two bags of hashed n-grams are estimated: the target's, from a bounded sample of rows labelled good, and
the raw one, from all documents. A document's log weight is the log ratio of the two models per n-gram, so
it doesn't grow with the text; PRIOR n-grams of ratio 0 are added, so a few n-grams alone decide nothing. Documents are sampled
without replacement by Gumbel top-k: the k greatest of log weight / temperature + Gumbel noise, where the noise is
a hash of the row and the seed. A row's chance to be drawn next is thus proportional to exp(log weight / temperature). k is
given, or the number of documents whose log weight reaches a cut that labelled rows calibrate, none of which the target model has seen.

n-grams: one and two tokens (words or runs of punctuation, lower-cased A-Z, a token that repeats the one before
as a mark of its own) and one to three token shapes (capitals, digits, punctuation itself).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop, give_back, kth_largest, lean, runs, saved, text_buffers
from .words import U, _SPACE, mix, mix_int, word_hashes

BUCKETS = 1 << 14
TARGET_ROWS = 5000
CALIBRATION_ROWS = 5000
#: Of log weights per n-gram: a difference of 0.05 makes a row e times as likely to be drawn next.
TEMPERATURE = 0.05
PRIOR = 20
#: One labelled row in five calibrates the cut; the others are fitted.
CALIBRATION_SHARE = 5

_CLASS = np.full(256, 2, dtype=np.uint8)  # 0 white space, 1 letters, digits and all beyond ASCII, 2 the rest
_CLASS[_SPACE] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, dtype=np.int32)
_DIGIT[0x30:0x3A] = 1


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends, rows and classes of the tokens of the texts."""
    cls = _CLASS[data]
    edge = np.ones(len(data), dtype=bool)
    edge[1:] = cls[1:] != cls[:-1]
    edge[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    at = np.flatnonzero(edge)
    ends = np.concatenate([at[1:], [len(data)]])
    black = cls[at] > 0
    starts, ends = at[black], ends[black]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1, cls[starts]


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and row numbers of all n-grams of the texts data[offsets[i]:offsets[i+1]]."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z
    starts, ends, rows, cls = _tokens(data, offsets)
    h = word_hashes(data, starts, ends)
    same_row = np.zeros(len(h), dtype=bool)
    same_row[1:] = rows[1:] == rows[:-1]
    again = same_row.copy()
    again[1:] &= h[1:] == h[:-1]
    upper, digit = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _DIGIT))
    n_upper, n_digit, size = upper[ends] - upper[starts], digit[ends] - digit[starts], ends - starts
    shape = np.select([cls == 2, n_digit > 0, n_upper == 0, (n_upper == 1) & (size > 1), 2 * n_upper >= size], [h, U(2), U(3), U(4), U(5)], U(6)).astype(U)
    shape = np.where(again, U(1), shape)
    token = np.where(again, U(mix_int(99)), h)
    two, three = same_row, same_row.copy()
    three[1:] &= same_row[:-1]
    out, own = [], []

    def add(x: np.ndarray, kind: int, keep: np.ndarray) -> None:
        out.append((mix(x[keep] + U(mix_int(kind))) % U(BUCKETS)).astype(np.int64))
        own.append(rows[keep])

    every = np.ones(len(h), dtype=bool)
    before = lambda x, d: np.concatenate([np.zeros(d, dtype=U), x[: max(0, len(x) - d)]])[: len(x)]
    s1, s2 = before(shape, 1), before(shape, 2)
    add(token, 1, every)
    add(mix(before(token, 1)) * U(3) + token, 2, two)
    add(shape, 3, every)
    add(mix(s1) * U(3) + shape, 4, two)
    add(mix(mix(s2) * U(3) + s1) * U(3) + shape, 5, three)
    return np.concatenate(out), np.concatenate(own)


@dataclass
class Weights:
    """The log ratio of the two models by bucket, and the cut of the log weight."""

    ratio: np.ndarray
    cut: float = 0.0

    def of_texts(self, col: pa.Array) -> np.ndarray:
        """Log weight per n-gram of every text; 0 of a text without tokens."""
        data, offsets = text_buffers(col)
        out = np.zeros(len(offsets) - 1)
        for i, j in runs(offsets, 1 << 19):
            b, r = ngrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out[i:j] = np.bincount(r, weights=self.ratio[b], minlength=j - i) / (np.bincount(r, minlength=j - i) + PRIOR)
        return out


def _labelled(docs: DataFrame, labels: DataFrame, target_rows: int, calibration_rows: int) -> DataFrame:
    """doc_id, quality, fitted: at most target_rows good rows that are fitted, calibration_rows of each quality that aren't, by least hash of the doc_id."""
    usable = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"])
    usable = usable.withColumn("fitted", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(CALIBRATION_SHARE)) != 0)
    least = lambda rows, n: rows.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(n)
    parts = [least(usable.where(~F.col("fitted") & (F.col("quality") == y)), calibration_rows) for y in (0, 1)]
    return parts[0].union(parts[1]).union(least(usable.where("fitted and quality = 1"), target_rows))


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> Weights:
    """Estimate both models and the cut.

    The raw model counts all documents. The target model uses at most target_rows good rows, the cut at most
    calibration_rows other labelled rows of each quality (documented bounds). Without good rows the ratio is 0 everywhere; without
    rows of both kinds to calibrate on the cut lets everything pass.
    """
    sample = _labelled(docs, labels, target_rows, calibration_rows)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = sample.where("fitted").select("doc_id", "quality")
    marked = base.join(F.broadcast(target), "doc_id", "left").select("text", "quality")  # at most target_rows rows of two numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for b in batches:
            quality = b.column("quality").fill_null(-1).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(b.column("text"))
            for i, j in runs(offsets, 1 << 19):
                buckets, rows = ngrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                raw += np.bincount(buckets, minlength=BUCKETS)
                good += np.bincount(buckets[quality[i + rows] == 1], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], ["bucket", "raw", "good"])

    # one row a bucket: at most BUCKETS rows
    counts = marked.mapInArrow(lambda it: lean(count(it)), "bucket long, raw double, good double").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts.column("bucket").to_numpy()
    raw[at], good[at] = counts.column("raw").to_numpy(), counts.column("good").to_numpy()
    weights = Weights(np.zeros(BUCKETS))
    if good.sum():
        weights.ratio = np.log((good + 1) / (good.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    known = base.where("text is not null").join(F.broadcast(sample.where("not fitted")), "doc_id").select(log_weight(F.col("text"), weights).alias("w"), "quality").toPandas()
    if len(set(known["quality"])) == 2:
        weights.cut = _cut(known["w"].to_numpy(), known["quality"].to_numpy())
    else:
        weights.cut = -np.inf
    return weights


def _cut(w: np.ndarray, quality: np.ndarray) -> float:
    """The cut with the greatest share of good rows kept plus bad rows dropped, in the middle of its gap; a lost good row counts twice."""
    order = np.argsort(w, kind="stable")
    w, good = w[order], quality[order] == 1
    lost, dropped = np.concatenate([[0], np.cumsum(good)]) / good.sum(), np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    value = dropped - 2 * lost
    k = int(np.argmax(value))
    if k == 0:
        return float(w[0] - 1)
    return float((w[k - 1] + w[k]) / 2) if k < len(w) else float(w[-1] + 1)


def log_weight(text: Column, weights: Weights) -> Column:
    @F.arrow_udf("double")
    def weigh(col: pa.Array) -> pa.Array:
        out = pa.array(weights.of_texts(col))
        give_back()
        return out

    return weigh(text)


def sample_key(weight: Column, doc_id: Column, text: Column, seed: int | Column, temperature: float) -> Column:
    """weight / temperature + Gumbel noise that depends on the row and the seed only."""
    uniform = (F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") + 0.5) / float(1 << 52)
    return weight / temperature - F.log(-F.log(uniform))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 11, temperature: float = TEMPERATURE) -> DataFrame:
    """The rows of docs, all columns, with log_weight double, sample_key double and selected boolean.

    Selected are the k rows with the greatest sample_key = log_weight / temperature + Gumbel noise (rows at the
    threshold, such as exact repeated rows, all count). Without k it is the number of rows whose log weight reaches the cut: then
    the noise decides among rows near the cut, and with a smaller k also among good ones. k from the row count on selects all, k below 1 none.
    Null and blank texts have weight 0; null doc_ids and repeated rows are sampled as they are; an empty table gives no rows.
    Columns of docs named like the new ones are replaced.
    """
    weights = fit(docs, labels)
    text = F.col("text").cast("string")
    scored = docs.withColumn("log_weight", log_weight(text, weights))
    scored = scored.withColumn("sample_key", sample_key(F.col("log_weight"), F.col("doc_id").cast("long"), text, seed, temperature))
    # the key as a long in units of 2^-20 orders like the key
    rank = F.floor(F.col("sample_key") * float(1 << 20))
    ranks = saved(scored.select(rank.alias("r"), (F.col("log_weight") >= F.lit(weights.cut)).alias("good")), "ranks")
    wanted = ranks.where("good").count() if k is None else min(k, ranks.count())
    least = kth_largest(ranks, "r", wanted) if wanted > 0 else None
    drop(ranks)
    return scored.withColumn("selected", F.lit(False) if least is None else rank >= F.lit(least))
