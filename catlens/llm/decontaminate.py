"""Operator 4: benchmark decontamination by latent semantic retrieval.

1. Document frequencies of words are counted over all documents. A word's weight falls with them to 0.1 and never to 0, so
   an item that copies or a hot source carry into many documents keeps all its words.
2. Benchmark passages (PASSAGE words, half overlapping) become TF-IDF rows. Their randomised SVD is distributed:
   a random projection Y = A R and Z = A'Y are summed by feature over tasks, Q = orth(Z), the Gram matrix of A Q is summed
   over tasks, and its eigenvectors turn Q into the right singular vectors V.
3. Document windows are folded into the latent space (a running sum of idf * V over their words, so a window costs two
   lookups), and benchmark passages with a cosine of at least COSINE are candidates. A passage is compared with windows of
   the least of LENGTHS that holds it, so it fills most of a window whatever its length.
4. A candidate is a leak if the longest common subsequence of the item's words (all of them) and the window's surroundings
   covers LCS of the item, or LCS_ANSWER of it and ANSWER of the item's answer (its last sentence, or what follows its last question mark).
   The item's words that stand there must have that share of its weight (the sum of its idf) too: common words alone are no leak.

The benchmark is worked through in blocks of BLOCK passages, small beside RANK, so that passages stay apart in the latent space
however many items there are. A block's V and vectors are bounded: BLOCK * PASSAGE features of RANK 4-byte numbers, 8 MB, and as
much for the items' word counts. Blocks are made one after another and broadcast in batches of at most SENT bytes (or one block): a
benchmark of one batch is searched in one pass; of more, each batch has a pass of its own over the texts, writes the few leaks it
finds and is taken back from the executors before the next one is made. Only the hashes of the benchmark's words stay on the driver. Documents
are never joined with the benchmark.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import runs, saved, text_buffers
from .words import BARE, U, mix, word_hashes, words

PASSAGE = 64
#: Words of a window, and words from one window to the next.
LENGTHS = {8: 2, 12: 4, 16: 4, 24: 8, 32: 8, 48: 16, 64: 16}
STRIDE = 16
RANK = 128
BLOCK = 256
TASK_PASSAGES = 32  # passages of a task of the SVD
SENT = 256 << 20
CHUNK = 1 << 14  # words whose running sum is held at once
COSINE = 0.5
LCS = 0.7
LCS_ANSWER = 0.5
ANSWER = 0.8
LEAST_WORDS = 5


def bare_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of the words without ASCII punctuation; texts come in lower case."""
    starts, ends, rows = words(data, offsets, BARE)
    return word_hashes(data, starts, ends), rows


def _hashes(text: str) -> np.ndarray:
    data, offsets = text_buffers(pc.utf8_lower(pa.array([text], type=pa.large_string())))
    return bare_words(data, offsets)[0]


def answer_of(text: str) -> str:
    """What follows the last question mark, else the last sentence or line."""
    text = text.strip()
    tail = text.rpartition("?")[2].strip()
    if tail and "?" in text:
        return tail
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if p.strip()]
    return parts[-1] if parts else ""


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    if not len(a) or not len(b):
        return 0
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        m = masks.get(y)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@dataclass
class Space:
    """The latent space of one block of benchmark passages."""

    words: np.ndarray  # sorted feature words
    v: np.ndarray  # features x rank, float32, times the features' idf, and a row of zeros
    vectors: np.ndarray  # passages x rank, unit length
    length: np.ndarray  # words of the windows that each passage is compared with
    item: np.ndarray  # item number of each passage
    items: list[tuple[int, np.ndarray, np.ndarray]]  # item id, its words as features, those of the answer
    size: np.ndarray  # words of each item
    counts: np.ndarray  # items x (features and one), how often the item has the word
    idf: np.ndarray  # of the features and one
    mass: np.ndarray  # sum of the idf of each item's words
    filter: np.ndarray  # which low hash bits occur
    least: dict[int, int]  # so many feature words a window of each length needs to be looked at; it settles no leak

    def features(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of h that are feature words, and their features."""
        at = np.flatnonzero(self.filter[(h & U(0xFFFFF)).astype(np.int64)])
        if not len(self.words):
            return at[:0], at[:0]
        f = np.searchsorted(self.words, h[at])
        f[f == len(self.words)] = 0
        hit = self.words[f] == h[at]
        return at[hit], f[hit]

    def leaks(self, h: np.ndarray, cuts: np.ndarray) -> dict[int, list[tuple[int, float, float]]]:
        """(item id, cosine, LCS share) of the benchmark items in each document that holds any; document i has the words h[cuts[i] : cuts[i + 1]]."""
        found: dict[tuple[int, int], tuple[float, float]] = {}
        at, f = self.features(h)
        if len(at):
            # documents begin at multiples of STRIDE places, so that windows begin at multiples of their strides, and PASSAGE empty places apart
            size = np.diff(cuts)
            base = np.full(len(size) + 1, PASSAGE, dtype=np.int64)
            base[1:] += np.cumsum(-(-size // STRIDE) * STRIDE + PASSAGE)
            row = np.searchsorted(cuts, at, side="right") - 1
            text = np.full(base[-1] + CHUNK + PASSAGE, len(self.words), dtype=np.int32)  # the feature at each place, or the last row of zeros
            text[at - cuts[row] + base[row]] = f
            for lo in range(0, int(base[-1]), CHUNK):
                self._chunk(text, base, size, lo, found)
        out: dict[int, list[tuple[int, float, float]]] = {}
        for (d, n), (share, cosine) in sorted(found.items()):
            out.setdefault(d, []).append((self.items[n][0], cosine, share))
        return out

    def _chunk(self, text: np.ndarray, base: np.ndarray, size: np.ndarray, lo: int, found: dict[tuple[int, int], tuple[float, float]]) -> None:
        """Leaks of the windows that begin at places lo to lo + CHUNK."""
        kinds = np.unique(self.length).tolist()
        unit = min(LENGTHS[k] for k in kinds)  # windows are runs of cells of so many words
        part = text[lo : lo + CHUNK + PASSAGE]
        sums = {unit: sum(self.v[part[j::unit]] for j in range(unit))}
        for n in (4, 8, 12, 16, 24, 32, 48, 64):  # sums of n words from each cell on, each of two shorter ones
            if unit < n <= max(kinds) and n % unit == 0:
                x = 1 << n.bit_length() - 1 if n & n - 1 else n // 2
                left, right = sums[x], sums[n - x][x // unit :]
                sums[n] = left[: len(right)] + right
        filled = np.append(0, np.cumsum(part < len(self.words)))
        for k in kinds:
            stride, passages = LENGTHS[k], np.flatnonzero(self.length == k)
            begin = np.arange(0, CHUNK, stride)
            row = np.searchsorted(base, begin + lo, side="right") - 1
            inside = begin + lo - base[row]
            begin = begin[(row >= 0) & (row < len(size)) & (inside < np.maximum(1, size[np.clip(row, 0, len(size) - 1)] - k + stride))]
            begin = begin[filled[begin + k] - filled[begin] >= self.least[k]]
            x = sums[k][begin // unit]
            cosine = x @ self.vectors[passages].T
            cosine /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-6)[:, None]
            w, p = np.nonzero(cosine >= COSINE)
            for i in range(0, len(w), 1 << 14):
                self._verify(text, base, size, begin[w[i : i + (1 << 14)]] + lo, k, self.item[passages[p[i : i + (1 << 14)]]], cosine[w[i : i + (1 << 14)], p[i : i + (1 << 14)]], found)

    def _verify(self, text: np.ndarray, base: np.ndarray, size: np.ndarray, begin: np.ndarray, k: int, item: np.ndarray, cosine: np.ndarray, found: dict[tuple[int, int], tuple[float, float]]) -> None:
        """Enters the leaks among candidates (windows of k words from begin, items) in found."""
        need = LCS_ANSWER * self.size[item]
        reach = np.maximum(LENGTHS[k], self.size[item] - k)  # a long item reaches beyond the window
        weight = np.zeros(len(item))
        for r in np.unique(reach):
            c = np.flatnonzero(reach == r)
            row = np.searchsorted(base, begin[c], side="right") - 1
            a, b = np.maximum(base[row], begin[c] - r), np.minimum(base[row] + size[row], begin[c] + k + r)
            # words of the item in the surroundings, then each at most as often as the item has it: bounds of the common subsequence
            for once in (False, True):
                keep = []
                for i in range(0, len(c), max(1, (1 << 20) // (k + 2 * int(r)))):
                    j = slice(i, i + max(1, (1 << 20) // (k + 2 * int(r))))
                    place = a[j, None] + np.arange(k + 2 * r)
                    near = np.where(place < b[j, None], text[np.minimum(place, len(text) - 1)], len(self.words))
                    if once:
                        near.sort(axis=1)
                        n = self.counts[item[c[j], None], near]
                        n[:, 1:][near[:, 1:] == near[:, :-1]] = 0
                        weight[c[j]] = (n * self.idf[near]).sum(axis=1) / self.mass[item[c[j]]]
                    else:
                        n = self.counts[item[c[j], None], near] > 0
                    keep.append(n.sum(axis=1, dtype=np.int64) >= need[c[j]])
                keep = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
                c, row, a, b = c[keep], row[keep], a[keep], b[keep]
            for i, d, x, y in zip(c.tolist(), row.tolist(), a.tolist(), b.tolist(), strict=True):
                n = int(item[i])
                old = found.get((d, n), (0.0, 0.0))
                if old[0] == 1 and old[1] >= cosine[i]:
                    continue
                _, mine, answer = self.items[n]
                share = lcs_length(mine, text[x:y]) / len(mine)
                sure = min(share, weight[i])
                if sure >= LCS or sure >= LCS_ANSWER and len(answer) and lcs_length(answer, text[x:y]) >= ANSWER * len(answer):
                    found[d, n] = max(old, (share, float(cosine[i])))


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each word of the sorted vocabulary stands, and how many documents have words."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        filter_ = _filter(own)
        df = np.zeros(len(own) + 1, dtype=np.int64)
        for b in batches:
            data, offsets = text_buffers(pc.utf8_lower(b.column("text")))
            for i, j in runs(offsets):
                h, rows = bare_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                df[-1] += len(np.unique(rows))
                at = np.flatnonzero(filter_[(h & U(0xFFFFF)).astype(np.int64)])
                f = np.searchsorted(own, h[at])
                f[f == len(own)] = 0
                hit = own[f] == h[at]
                df[:-1] += np.bincount(np.unique(rows[at[hit]] * len(own) + f[hit]) % len(own), minlength=len(own))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["f", "n"])

    got = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()  # one row a word of the benchmark
    df = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    df[got.column("f").to_numpy()] = got.column("n").to_numpy()
    return df[:-1], int(df[-1])


def _filter(sorted_words: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, dtype=bool)
    out[(sorted_words & U(0xFFFFF)).astype(np.int64)] = True
    return out


def _tfidf(h: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    f, n = np.unique(np.searchsorted(vocabulary, h), return_counts=True)
    value = n * idf[f]
    norm = np.sqrt((value**2).sum())
    keep = value > 0
    return f[keep], (value[keep] / norm) if norm else value[keep]


def randomised_svd(passages: DataFrame, n_features: int, rank: int, seed: int = 3) -> np.ndarray:
    """Right singular vectors (n_features x rank) of the sparse rows of passages (f array<int>, x array<double>).

    Two passes; each task sums its share of Z = A'(A R) or of the Gram matrix of A Q, and Spark adds the shares.
    """
    wide = rank + 10

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = np.random.default_rng(seed).standard_normal((n_features, wide), dtype=np.float32)
        z: dict[int, np.ndarray] = {}
        for frame in frames:
            for f, x in zip(frame["f"], frame["x"], strict=True):
                y = np.asarray(x) @ r[np.asarray(f)]
                for i, value in zip(f, x, strict=True):
                    z[i] = z.get(i, 0) + value * y
        for i, row in z.items():
            yield pd.DataFrame({"i": np.full(wide, i), "j": np.arange(wide), "x": row})

    def dense(df: DataFrame, n: int, m: int) -> np.ndarray:
        out = np.zeros((n, m))
        got = df.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()  # n * m cells, bounded by the block
        out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("x").to_numpy()
        return out

    q, _ = np.linalg.qr(dense(passages.mapInPandas(project, "i int, j int, x double"), n_features, wide))
    sent = passages.sparkSession.sparkContext.broadcast(q.astype(np.float32))

    def gram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, g = sent.value, np.zeros((q.shape[1], q.shape[1]))
        for frame in frames:
            for f, x in zip(frame["f"], frame["x"], strict=True):
                y = np.asarray(x) @ own[np.asarray(f)]
                g += np.outer(y, y)
        i, j = np.nonzero(g)
        yield pd.DataFrame({"i": i, "j": j, "x": g[i, j]})

    values, vectors = np.linalg.eigh(dense(passages.mapInPandas(gram, "i int, j int, x double"), q.shape[1], q.shape[1]))
    best = np.argsort(-values)[:rank]
    best = best[values[best] > 1e-9 * max(values.max(), 1e-30)]
    return (q @ vectors[:, best]).astype(np.float32)


def spaces(docs: DataFrame, benchmark: DataFrame) -> Iterator[Space]:
    """The latent spaces of the benchmark's blocks (benchmark: item_id, text), made as they are asked for. Null and wordless items are left out; equal ids are kept apart."""
    items = []
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        h = _hashes(row["text"] or "")
        if len(h):
            items.append((row["item_id"], h, _hashes(answer_of(row["text"]))))
    items.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1].tobytes()))
    blocks: list[list[int]] = [[]]
    size = 0
    for n, (_, h, _) in enumerate(items):
        cut = 1 + max(0, -(-(len(h) - PASSAGE) // (PASSAGE // 2)))
        if size and size + cut > BLOCK:
            blocks.append([])
            size = 0
        blocks[-1].append(n)
        size += cut
    if not items:
        return
    every = np.unique(np.concatenate([h for _, h, _ in items]))
    df, n = _frequencies(docs, every)  # of all blocks' words in one scan
    for b in blocks:
        yield _space(docs.sparkSession, [items[k] for k in b], every, df, n)


def batches(found: Iterator[Space], limit: int) -> Iterator[list[Space]]:
    """Consecutive spaces of at most `limit` bytes together; a larger one is a batch of its own. At least one batch, which may be empty."""
    held, size = [], 0
    for s in found:
        own = s.v.nbytes + s.vectors.nbytes + s.counts.nbytes + s.filter.nbytes
        if held and size + own > limit:
            yield held
            held, size = [], 0
        held.append(s)
        size += own
    yield held


def _space(spark, items: list[tuple[int, np.ndarray, np.ndarray]], every: np.ndarray, df: np.ndarray, n: int) -> Space:
    """The space of one block; df: in how many of the n documents each word of every stands."""
    vocabulary = np.unique(np.concatenate([h for _, h, _ in items]))
    df = df[np.searchsorted(every, vocabulary)]
    idf = np.log((n + 1) / (df + 1)) + 0.1
    rows, owner, length = [], [], []
    for k, (_, h, _) in enumerate(items):
        for a in range(0, max(1, len(h) - PASSAGE // 2), PASSAGE // 2):
            passage = h[a : a + PASSAGE]
            f, x = _tfidf(passage, vocabulary, idf)
            rows.append((f.tolist(), x.tolist()))
            owner.append(k)
            length.append(min(n for n in LENGTHS if n >= len(passage)))
    passages = spark.createDataFrame(rows, "f array<int>, x array<double>").repartition(-(-len(rows) // TASK_PASSAGES))
    v = randomised_svd(passages, len(vocabulary), min(RANK, len(rows)))
    vectors = np.stack([np.asarray(x, dtype=np.float32) @ v[np.asarray(f)] for f, x in rows])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)
    least = {n: min(LEAST_WORDS, min(len(f) for (f, _), k in zip(rows, length, strict=True) if k == n)) for n in set(length)}
    v = np.append(v * idf[:, None], np.zeros((1, v.shape[1])), axis=0).astype(np.float32)
    own = [(i, np.searchsorted(vocabulary, h), np.searchsorted(vocabulary, answer)) for i, h, answer in items]
    counts = np.zeros((len(own), len(vocabulary) + 1), dtype=np.uint16)
    for n, (_, h, _) in enumerate(own):
        counts[n] = np.minimum(np.bincount(h, minlength=len(vocabulary) + 1), 65535)
    size, idf = np.asarray([len(h) for _, h, _ in own]), np.append(idf, 0)
    return Space(vocabulary, v, vectors, np.asarray(length), np.asarray(owner), own, size, counts, idf, counts @ idf, _filter(vocabulary), least)


def leaks(text: Column, sent: list[Broadcast[Space]]) -> Column:
    """array<struct<item_id, cosine, lcs>> of the benchmark items that the whole text holds (empty if none)."""
    kind = "array<struct<item_id:long,cosine:double,lcs:double>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64())]))

    @F.arrow_udf(kind)
    def search(col: pa.Array) -> pa.Array:
        own = [s.value for s in sent]
        data, offsets = text_buffers(pc.utf8_lower(col))
        out = []
        for i, j in runs(offsets):
            h, rows = bare_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            cuts = np.searchsorted(rows, np.arange(j - i + 1))
            hits = [s.leaks(h, cuts) for s in own]
            for k in range(j - i):
                out.append([{"item_id": a, "cosine": c, "lcs": s} for x in hits for a, c, s in x.get(k, ())])
        return pa.array(out, type=arrow)

    return search(text)


def contamination(docs: DataFrame, benchmark: DataFrame, sent_bytes: int = SENT) -> DataFrame:
    """All rows and columns of docs with `leaks` (array of item_id, cosine, lcs) and `contaminated` boolean.

    Null and blank texts hold nothing; repeated rows are judged alike; an empty benchmark leaks nothing; an empty
    table gives no rows. Columns of docs named like the new ones are replaced. sent_bytes bounds what is broadcast at a time, not the result.
    """
    sc, text = docs.sparkSession.sparkContext, F.col("text").cast("string")
    todo = batches(spaces(docs, benchmark), sent_bytes)
    batch, following = next(todo), next(todo, None)
    if following is None:
        found = leaks(text, [sc.broadcast(s) for s in batch])
        return docs.withColumn("leaks", found).withColumn("contaminated", F.size("leaks") > 0)
    row = f"row_{uuid.uuid4().hex}"
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    hits, number = [], 0
    while batch is not None:
        sent = [sc.broadcast(s) for s in batch]
        hits.append(saved(numbered.select(F.col(row).alias("row"), F.lit(number).alias("batch"), F.posexplode(leaks(text, sent)).alias("place", "leak")), "leaks"))
        for b in sent:
            b.destroy()
        batch, following = following, next(todo, None)
        number += 1
    # a row has at most one leak an item
    every = reduce(DataFrame.union, hits).groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("batch", "place", "leak")))["leak"].alias("leaks"))
    out = numbered.drop("leaks").join(every, row, "left").drop(row)
    out = out.withColumn("leaks", F.coalesce("leaks", F.array().cast(every.schema["leaks"].dataType)))
    names = [*docs.columns, *(["leaks"] if "leaks" not in docs.columns else [])]
    return out.select(*names).withColumn("contaminated", F.size("leaks") > 0)
