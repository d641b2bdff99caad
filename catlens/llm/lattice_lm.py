"""Operator 13: a language model by subword lattices over an existing vocabulary.

A text is its lower-cased words, each with the word mark of the vocabulary before it, and one end. Every way to cut
it into pieces of the vocabulary is weighted by the product of the pieces' probabilities, and the
probability of the text is the sum over all of them. No piece holds a word mark behind its first character, so
no piece crosses a word and the marginal probability of a text is the product over its words: each distinct
word's lattice is summed once, by the forward recursion in log space, for all words of equal length at a time.

The vocabulary's own scores give the first weights: as log probabilities, or by Zipf's law (1 / (1 + rank)) where the scores
are ranks, as those of merge vocabularies are. `ROUNDS` rounds of expectation maximisation then fit the weights to the training words: a forward-backward
pass over each distinct word, weighted with its count, and a sum per piece. The first weights stay as a prior of
`PRIOR` pieces, so no piece has probability 0. A character without a piece is spelled in byte pieces, so every
text has a probability. The vocabulary itself is never trained.

The corpus is gathered as one row per distinct word, (word, rows of all texts, of training texts): partial counts per
Arrow batch, then a groupBy. The `COMMON` most frequent words of at most `COMMON_BYTES` bytes, which is a table of a fixed size, go to the
tasks that read the texts a second time. A text keeps its other words as (word, n) pairs, which are joined
with the word table and added up. None of these words is hot, since the common ones are gone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop, kth_largest, runs, saved, text_buffers
from .words import _BYTE, U, coded_words
from .words import _powers as powers

ROUNDS = 3
#: The first weights count as this many pieces.
PRIOR = 3_000.0
COMMON = 400_000
COMMON_BYTES = 64
FOLDS, HELD = 7, 2
MARK = "▁"
#: Cells (words x bytes) of a lattice at a time.
CELLS = 1 << 17
_KEY = U(0xFF51AFD7ED558CCD)
_LN10 = float(np.log(10.0))


class Vocabulary:
    """Pieces of a SentencePiece model with their first log weights, and a lookup of substrings by hash."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray, end: int, bytes_: np.ndarray):
        self.weights, self.end, self.bytes = weights, end, bytes_
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.filter = np.zeros(1 << 20, dtype=bool)
        sizes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p:
                sizes.setdefault(len(p), []).append(i)
        for n, ids in sorted(sizes.items()):
            matrix = np.array([np.frombuffer(pieces[i], dtype=np.uint8) for i in ids]).T
            keys = _keys(_sums(matrix), n)[0]
            order = np.argsort(keys)
            self.by_length[n] = (keys[order], np.asarray(ids, dtype=np.int32)[order])
            self.filter[(keys >> U(44)).astype(np.int64)] = True

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        pieces, byte_ids = [], np.zeros(256, dtype=np.int32)
        for i in range(n):
            text = model.id_to_piece(i)
            usable = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)) and MARK not in text[1:]
            pieces.append(text.encode() if usable else b"")
            if model.is_byte(i):
                byte_ids[int(text[1:-1], 16)] = i
        end = model.eos_id() if model.eos_id() >= 0 else n
        usable = np.array([bool(p) for p in pieces] + [False] * (end == n))
        scores = np.append(scores, [0.0] * (end == n))
        ranks = usable.any() and bool((scores[usable] == np.rint(scores[usable])).all())  # whole numbers: ranks, not log probabilities
        weights = np.full(len(usable), -np.inf)
        weights[usable] = -np.log1p(np.maximum(-scores[usable], 0)) if ranks else scores[usable]
        # bytes and the end have no score of their own: as rare as the rarest piece
        weights[byte_ids] = weights[end] = weights[usable].min()
        return cls(pieces, weights - _logsum(weights), end, byte_ids)


def _logsum(x: np.ndarray) -> float:
    top = x.max()
    return float(top + np.log(np.exp(x - top).sum()))


def _sums(matrix: np.ndarray) -> np.ndarray:
    """Running hash sums down the columns of a byte matrix (positions x words)."""
    out = np.zeros((matrix.shape[0] + 1, matrix.shape[1]), dtype=U)
    np.cumsum(_BYTE[matrix] * powers("up", matrix.shape[0])[: matrix.shape[0], None], axis=0, out=out[1:])
    return out


def _keys(sums: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n bytes from each position."""
    m = sums.shape[0] - n
    return ((sums[n:] - sums[:m]) * powers("down", m + 1)[:m, None] + U(n)) * _KEY


class Lattice:
    """All pieces of words of about equal length: for each piece length, the piece that begins at (position, word) or -1."""

    def __init__(self, vocabulary: Vocabulary, matrix: np.ndarray, sizes: np.ndarray):
        self.sizes, self.n, self.m = sizes, matrix.shape[0], matrix.shape[1]
        sums = _sums(matrix)
        found: dict[int, np.ndarray] = {}
        for n, (keys, ids) in vocabulary.by_length.items():
            if n > self.n:
                break
            k = _keys(sums, n)
            flat = k.ravel()
            at = np.flatnonzero(vocabulary.filter[(flat >> U(44)).astype(np.int64)])
            where = np.searchsorted(keys, flat[at])
            hit = keys[np.minimum(where, len(keys) - 1)] == flat[at]
            if hit.any():
                piece = np.full(k.shape, -1, dtype=np.int32)
                piece.ravel()[at[hit]] = ids[where[hit]]
                found[n] = piece
        # characters without a piece of their own are spelled in bytes
        lead = (matrix & 0xC0) != 0x80
        width = np.where(matrix < 0x80, 1, np.where(matrix < 0xE0, 2, np.where(matrix < 0xF0, 3, 4)))
        bare = lead & (np.arange(self.n)[:, None] < sizes)
        for n in (1, 2, 3, 4):
            if n in found:
                bare[: self.n - n + 1] &= ~((width[: self.n - n + 1] == n) & (found[n] >= 0))
        if bare.any():
            spelled = bare.copy()
            for k in (1, 2, 3):
                spelled[k:] |= (bare & (width > k))[:-k] if k < self.n else False
            single = found.setdefault(1, np.full(matrix.shape, -1, dtype=np.int32))
            single[spelled] = vocabulary.bytes[matrix[spelled]]
        self.pieces = {n: (p, (p >= 0).any(axis=1)) for n, p in found.items()}

    def _step(self, terms: list[np.ndarray]) -> np.ndarray:
        if len(terms) == 1:
            return terms[0]
        x = np.stack(terms)
        top = x.max(axis=0)
        safe = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            return safe + np.log(np.exp(x - safe).sum(axis=0))

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log of the summed weight of all segmentations of each prefix (positions + 1 x words); weights end with -inf."""
        a = np.full((self.n + 1, self.m), -np.inf)
        a[0] = 0.0
        for t in range(1, self.n + 1):
            terms = [a[t - n] + weights[p[t - n]] for n, (p, some) in self.pieces.items() if n <= t and some[t - n]]
            if terms:
                a[t] = self._step(terms)
        return a

    def totals(self, a: np.ndarray) -> np.ndarray:
        return a[self.sizes, np.arange(self.m)]

    def expected(self, weights: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected number of uses of each piece in counts copies of each word to out."""
        a = self.forward(weights)
        total = self.totals(a)
        b = np.full((self.n + 1, self.m), -np.inf)
        own_end = np.arange(self.n + 1)[:, None] == self.sizes
        b[own_end] = 0.0
        for t in range(self.n - 1, -1, -1):
            terms = [weights[p[t]] + b[t + n] for n, (p, some) in self.pieces.items() if t + n <= self.n and some[t]]
            if terms:
                b[t] = np.where(own_end[t], b[t], self._step(terms))
        for n, (p, _) in self.pieces.items():
            at = np.flatnonzero(p.ravel() >= 0)
            ids, word = p.ravel()[at], at % self.m
            share = np.exp(a[: self.n - n + 1].ravel()[at] + weights[ids] + b[n:].ravel()[at] - total[word])
            out += np.bincount(ids, share * counts[word], minlength=len(out))[: len(out)]


def lattices(vocabulary: Vocabulary, col: pa.Array) -> Iterator[tuple[np.ndarray, Lattice]]:
    """(row numbers, lattice) for all words of a string column, words of about equal length together."""
    data, offsets = text_buffers(col)
    mark = np.frombuffer(MARK.encode(), dtype=np.uint8)
    sizes = np.diff(offsets)
    order = np.argsort(sizes, kind="stable")
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i) < max(1, CELLS // (int(sizes[order[j]]) + 3)) and sizes[order[j]] <= sizes[order[i]] * 1.2 + 1:
            j += 1
        rows = order[i:j]
        own = sizes[rows]
        width = int(own.max())
        matrix = np.zeros((width + 3, len(rows)), dtype=np.uint8)
        matrix[:3] = mark[:, None]
        at = np.arange(width)[:, None]
        inside = at < own
        matrix[3:][inside] = data[(offsets[rows] + at)[inside]]
        yield rows, Lattice(vocabulary, matrix, own + 3)
        i = j


def held_out(key: Column) -> Column:
    """Whether crc32(key as text) mod 7 is 2; a null key is a training row."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(FOLDS)) == HELD, F.lit(False))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("long").alias("id"), held_out(F.col(f"`{key}`")).alias("held"), F.col(f"`{text}`").cast("string").alias("t"))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n (in all texts), c (in training texts) of every distinct word."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("c", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = text_buffers(batch.column(1))
            for i, j in runs(offsets, 1 << 22):
                distinct, code, rows = coded_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n = np.bincount(code, minlength=len(distinct))
                c = np.bincount(code[~held[i:j][rows]], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([distinct, pa.array(n), pa.array(c)], schema=schema)

    parts = _texts(docs, key, text).select("held", "t").mapInArrow(work, "word string, n long, c long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def fit(counts: DataFrame, n_ends: int, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of the pieces after expectation maximisation on the training words (word, c); a round gathers one number per piece."""
    spark = counts.sparkSession
    weights = vocabulary.weights
    prior = np.exp(weights) * PRIOR
    size = len(weights)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, weights))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, now = shared.value
            out, padded = np.zeros(size), np.append(now, -np.inf)
            for batch in batches:
                c = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                for rows, lattice in lattices(vocab, batch.column(0)):
                    lattice.expected(padded, c[rows], out)
            used = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(out[used])], names=["piece", "uses"])

        uses = counts.where("c > 0").select("word", "c").mapInArrow(work, "piece int, uses double")
        total = prior.copy()
        total[vocabulary.end] += n_ends
        for r in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            total[r["piece"]] += r["uses"]
        with np.errstate(divide="ignore"):
            weights = np.log(total) - np.log(total.sum())
        shared.unpersist()
    return weights


def word_scores(counts: DataFrame, vocabulary: Vocabulary, weights: np.ndarray) -> DataFrame:
    """word, n, c, lp: the log10 marginal probability of every word over all its segmentations."""
    shared = counts.sparkSession.sparkContext.broadcast((vocabulary, np.append(weights, -np.inf)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, padded = shared.value
        for batch in batches:
            lp = np.zeros(batch.num_rows)
            for rows, lattice in lattices(vocab, batch.column(0)):
                lp[rows] = lattice.totals(lattice.forward(padded)) / _LN10
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lp)], names=["word", "n", "c", "lp"])

    return counts.select("word", "n", "c").mapInArrow(work, "word string, n long, c long, lp double")


def score_texts(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: the key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Models learn from the rows whose crc32(key as text) mod 7 is not 2. n_tokens counts the words and one end,
    n_known those that occur in training texts, train_tokens the tokens of training texts. base_score is the unigram score
    with add-one smoothing, score the lattice model's log10 probability of the text. A null text is empty: one end. A null key is a training row.
    Repeated rows are counted and given back each; an empty table gives no row; without training rows the weights are the
    vocabulary's own. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.from_model(vocabulary_path)
    counts = saved(word_counts(docs, key, text), "lm-counts")
    ends = docs.select(held_out(F.col(f"`{key}`")).alias("held")).where("not held").count()
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    weights = fit(counts, ends, vocabulary, rounds)
    scored = saved(word_scores(counts, vocabulary, weights), "lm-words")
    drop(counts)
    below = float(n + v + 1)
    base = F.log10((F.col("c") + 1) / F.lit(below))
    # fewer than COMMON words are more frequent than the COMMON-th: found by counts, no task sorts them
    short = scored.where(F.octet_length("word") <= COMMON_BYTES)
    n_short = short.count()
    least = kth_largest(short, "n", COMMON) if 0 < COMMON < n_short else (0 if COMMON else None)
    common = short.where(F.col("n") > least) if least is not None else short.limit(0)
    rows = common.select("word", F.col("c"), base.alias("base"), "lp").toArrow()
    table = rows.combine_chunks()
    shared = spark.sparkContext.broadcast((table, float(weights[vocabulary.end] / _LN10), float(np.log10((ends + 1) / below)), ends > 0))
    schema = pa.schema(
        [("row", pa.int64()), ("id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("lp", pa.float64())]
        + [("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, end_lp, end_base, end_known = shared.value
        place = {w: i for i, w in enumerate(rows.column("word").to_pylist())}
        c, b, lp = (np.append(rows.column(x).to_numpy(), 0) for x in ("c", "base", "lp"))
        for batch in batches:
            data, offsets = text_buffers(batch.column(3))
            for i, j in runs(offsets, 1 << 22):
                distinct, code, row = coded_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                m = j - i
                at = np.array([place.get(w, -1) for w in distinct.to_pylist()], dtype=np.int64)[code] if len(code) else np.zeros(0, np.int64)
                known = np.bincount(row, c[at] > 0, minlength=m).astype(np.int64) + end_known
                pairs, times = np.unique(row[at < 0] * max(1, len(distinct)) + code[at < 0], return_counts=True)
                cuts = pa.array(np.searchsorted(pairs, np.arange(m + 1) * max(1, len(distinct))), pa.int32())
                rare = distinct.take(pa.array(pairs % max(1, len(distinct))))
                sums = [pa.array(np.bincount(row, x[at], minlength=m) + e) for x, e in ((b, end_base), (lp, end_lp))]
                total = pa.array(np.bincount(row, minlength=m) + 1)
                lists = [pa.ListArray.from_arrays(cuts, rare), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(i, m) for x in range(3)), total, pa.array(known), *sums, *lists], schema=schema)

    numbered = _texts(docs, key, text).select(F.monotonically_increasing_id().alias("row"), "id", "held", "t")
    names = "row long, id long, held boolean, n_tokens long, n_known long, base double, lp double, words array<string>, times array<long>"
    read = saved(numbered.mapInArrow(work, names), "lm-texts")
    rare = read.select("row", F.inline(F.arrays_zip("words", "times"))).join(scored.select(F.col("word").alias("words"), "c", base.alias("base"), "lp"), "words")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_2"), F.sum(F.col("times") * F.col("base")).alias("base_2"), F.sum(F.col("times") * F.col("lp")).alias("lp_2")
    )
    with_rare = read.where(F.size("words") > 0).drop("words", "times").join(rare, "row", "left")
    without = read.where(F.size("words") == 0).drop("words", "times")
    for name in ("known_2", "base_2", "lp_2"):
        without = without.withColumn(name, F.lit(0))
    both = without.unionByName(with_rare)
    out = saved(
        both.select(
            F.col("id").alias(key), F.col("held").alias("held_out"), "n_tokens", (F.col("n_known") + F.col("known_2")).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.col("base_2")).alias("base_score"), (F.col("lp") + F.col("lp_2")).alias("score"),
        ),
        "lm-scores",
    )
    drop(read, scored)
    return out
