"""Operator 8: convolutional toxicity classifier (numpy), thresholds calibrated by language.

A word (in lower case, without ASCII punctuation) is hashed into five tables: twice as a whole, so two words share
those rows only if both hashes collide, and by its first 4, 5 and 6 bytes, so that unseen forms of a stem are known by it.
The rows add up to its embedding. Filters of widths 1, 2 and 3 slide over the words of the whole text, each filter keeps its
greatest response (max pooling), and a logistic unit reads those. Training is Adagrad in numpy on all labelled rows, in Spark tasks
whose changes are averaged after each epoch; some columns of the embeddings start as the bucket's log-odds over all of them. Texts of one language share a threshold: a text's
language is guessed from its own function words, and the logit is shifted so that 0.5 is the language's best cut on
all validation rows. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import drop, runs, saved, text_buffers
from .words import BARE, U, mix, word_hashes, words

BUCKETS = 1 << 16
PREFIXES = (4, 5, 6)
TABLES = 2 + len(PREFIXES)
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
EPOCHS, RATE = 6, 0.05
#: Labelled rows of a training task at least, rows of one step, and parts of a logit by which cuts are set.
TASK_ROWS, STEP_ROWS, BINS = 4096, 8, 1000
#: Labels broadcast at once (about 60 MB).
LABELS_AT_ONCE = 1_000_000
#: Bounds of `training_rows`: rows of each label, and words of a row that count towards WORDS.
TRAIN_ROWS = 3000
TRAIN_WORDS = 4_000_000
VALIDATION_SHARE = 5

# fixed values: frequent function words by which a text's language is guessed
FUNCTION_WORDS = {
    "en": "the of and to in that is was for on with as it this be are from at by an which only they you",
    "de": "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es an zu sie er",
    "fr": "le la les et des une est que pour dans qui sur pas au avec il ce plus par se du en sont ou",
    "es": "el los las y del que una por con para su al lo como más pero sus es no se un la esta entre",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def _hash_list(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    return word_hashes(data, starts, ends)


_FUNCTION_HASHES = [np.sort(_hash_list(v)) for v in FUNCTION_WORDS.values()]


def text_words(col: pa.Array) -> Iterator[tuple[int, list[np.ndarray], list[int]]]:
    """(first row number, buckets (words x TABLES, uint16) of each row, language of each row) for runs of rows of a text column."""
    data, offsets = text_buffers(pc.utf8_lower(col))
    for i, j in runs(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, rows = words(part, off, BARE)
        h = word_hashes(part, starts, ends)
        columns = [h, mix(h + U(0x51))]
        columns += [mix(word_hashes(part, starts, np.minimum(ends, starts + k)) + U(0x100 + k)) for k in PREFIXES]
        b = np.stack([(c & U(BUCKETS - 1)).astype(np.uint16) for c in columns], axis=1) if len(h) else np.zeros((0, TABLES), dtype=np.uint16)
        cuts = np.searchsorted(rows, np.arange(j - i + 1))
        yield i, [b[cuts[k] : cuts[k + 1]] for k in range(j - i)], [language(h[cuts[k] : cuts[k + 1]]) for k in range(j - i)]


def language(h: np.ndarray) -> int:
    """Index in LANGUAGES of the language with most function words; the last one without any."""
    counts = [int(np.isin(h, x).sum()) for x in _FUNCTION_HASHES]
    return int(np.argmax(counts)) if any(counts) else len(LANGUAGES) - 1


#: Rows of the model array behind the tables: filters, their biases, output weights and output bias.
DENSE = -(-(sum(WIDTHS) * DIM * FILTERS + 2 * len(WIDTHS) * FILTERS + 1) // DIM)


@dataclass
class Model:
    """The network; all its numbers are views of one array, of which a row is a bucket's embedding or DIM of the other numbers."""

    values: np.ndarray = field(default_factory=lambda: np.zeros((TABLES * BUCKETS + DENSE, DIM), dtype=np.float32))
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def __post_init__(self):
        self.tables = self.values[: TABLES * BUCKETS].reshape(TABLES, BUCKETS, DIM)
        rest, at = self.values[TABLES * BUCKETS :].reshape(-1), 0
        self.filters: dict[int, np.ndarray] = {}
        self.bias: dict[int, np.ndarray] = {}
        for w in WIDTHS:
            self.filters[w] = rest[at : at + w * DIM * FILTERS].reshape(w * DIM, FILTERS)
            at += w * DIM * FILTERS
            self.bias[w] = rest[at : at + FILTERS]
            at += FILTERS
        self.out = rest[at : at + FILTERS * len(WIDTHS)]
        self.out_bias = rest[at + FILTERS * len(WIDTHS) :][:1]

    def _pooled(self, b: np.ndarray) -> np.ndarray:
        e = self.tables[0][b[:, 0]]
        for k in range(1, TABLES):
            e += self.tables[k][b[:, k]]
        pooled = []
        for w in WIDTHS:
            x = np.concatenate([e, np.zeros((w - len(e), DIM), dtype=np.float32)]) if len(e) < w else e
            n = len(x) - w + 1
            y = sum(x[j : j + n] @ self.filters[w][j * DIM : (j + 1) * DIM] for j in range(w))
            pooled.append(np.maximum(y.max(axis=0) + self.bias[w], 0))
        return np.concatenate(pooled)

    def logit(self, b: np.ndarray) -> float:
        """The uncalibrated logit of a text's buckets."""
        if not len(b):
            return float(self.out_bias[0])
        return float(self._pooled(b) @ self.out + self.out_bias[0])

    def score(self, b: np.ndarray, lang: int) -> float:
        z = self.logit(b) - self.shift[lang]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def bucket_counts(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of every bucket of every table (table * BUCKETS + bucket), the texts that hold it and the toxic ones of them."""
    out = np.zeros((2, TABLES * BUCKETS), dtype=np.int64)
    for b, y in zip(rows, labels, strict=True):
        for k in range(TABLES):
            own = np.unique(b[:, k]).astype(np.int64) + k * BUCKETS
            out[0, own] += 1
            out[1, own] += int(y)
    return out


def start(counts: np.ndarray, n: int, toxic: int, seed: int = 7) -> Model:
    """The network before its first step; some columns of the tables are the smoothed log-odds of a toxic text given the bucket."""
    rng, model = np.random.default_rng(seed), Model()
    model.tables[:] = rng.normal(0, 0.01, (TABLES, BUCKETS, DIM))
    for w in WIDTHS:
        model.filters[w][:] = rng.normal(0, 0.3 / w, (w * DIM, FILTERS))
    model.out[:] = rng.normal(0, 0.1, FILTERS * len(WIDTHS))
    prior = (toxic + 1) / (n + 2)
    rate = (counts[1] + 4 * prior) / (counts[0] + 4)
    odds = (np.log(rate / (1 - rate)) - np.log(prior / (1 - prior))).reshape(TABLES, BUCKETS)
    # column 0: log-odds of the whole word, column 1 + k: of its k-th prefix; a filter for each starts by reading it
    read = 1 + len(PREFIXES)
    for k in range(TABLES):
        model.tables[k][:, max(0, k - 1)] += odds[k] / 2 if k < 2 else odds[k]
    for w in WIDTHS:
        for f in range(read):
            model.filters[w][f::DIM, f] = 1.0 / w
        model.bias[w][:read] = -1.0
    model.out[:] = np.where(np.arange(len(model.out)) % FILTERS < read, 0.3, model.out)
    model.out_bias[:] = -2.0
    return model


def constant(label: int) -> Model:
    """The model without rows of both labels: it gives everything the one label."""
    model = Model()
    model.out_bias[:] = 4.0 if label else -4.0
    return model


class Learner:
    """Adagrad on a model, by steps of a few rows; knows which rows of the model's array it has changed."""

    def __init__(self, values: np.ndarray, sums: np.ndarray, weight: tuple[float, float], rate: float = RATE):
        self.model, self.sums, self._weight, self._rate = Model(values), Model(sums), np.array(weight, dtype=np.float32), rate
        self.touched = np.zeros(len(values), dtype=bool)

    def _step(self, param: np.ndarray, sums: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        sums[at] += grad**2
        param[at] -= self._rate * grad / np.sqrt(sums[at] + 1e-8)

    def learn(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        """One step on rows with words."""
        m, s = self.model, self.sums
        sizes = np.array([len(x) for x in rows])
        room = np.maximum(sizes, WIDTHS[-1])  # short texts are followed by zeros
        at = np.cumsum(room) - room
        place = np.arange(sizes.sum()) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
        keys = np.full((room.sum(), TABLES), -1, dtype=np.int32)
        keys[place] = np.concatenate(rows) + np.arange(TABLES, dtype=np.int32) * BUCKETS
        own = keys[place]
        found = m.values[own[:, 0]]
        for k in range(1, TABLES):
            found += m.values[own[:, k]]
        e = np.zeros((len(keys), DIM), dtype=np.float32)
        e[place] = found
        across, pooled, places = np.ascontiguousarray(e.T), [], []
        for w in WIDTHS:
            n = len(e) - w + 1
            y = sum(m.filters[w][j * DIM : (j + 1) * DIM].T @ across[:, j : j + n] for j in range(w))
            best = np.stack([y[:, a : a + c].argmax(axis=1) + a for a, c in zip(at.tolist(), (np.maximum(sizes, w) - w + 1).tolist(), strict=True)])
            places.append(best)
            pooled.append(np.maximum(y[np.arange(FILTERS), best] + m.bias[w], 0))
        pooled = np.concatenate(pooled, axis=1)
        z = pooled @ m.out + m.out_bias[0]
        delta = self._weight[labels] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels).astype(np.float32)
        delta[np.abs(delta) < 1e-3] = 0
        if not delta.any():
            return
        back = delta[:, None] * m.out * (pooled > 0)
        spots, grads = [], []
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            t = places[k][:, :, None] + np.arange(w)
            grad_w = np.einsum("rf,rfjd->jdf", g, e[t]).reshape(w * DIM, FILTERS)
            grad_e = g[:, :, None, None] * m.filters[w].reshape(w, DIM, FILTERS).transpose(2, 0, 1)
            used = (g != 0)[:, :, None] & (keys[t, 0] >= 0)
            spots.append(t[used])
            grads.append(grad_e[used])
            self._step(m.filters[w], s.filters[w], grad_w)
            self._step(m.bias[w], s.bias[w], g.sum(axis=0))
        self._step(m.out, s.out, delta @ pooled)
        self._step(m.out_bias, s.out_bias, delta.sum(keepdims=True))
        rows_at, inverse = np.unique(keys[np.concatenate(spots)].reshape(-1), return_inverse=True)
        total = np.zeros((len(rows_at), DIM), dtype=np.float32)
        np.add.at(total, inverse, np.repeat(np.concatenate(grads), TABLES, axis=0))
        self._step(m.values, s.values, total, rows_at)
        self.touched[rows_at] = True
        self.touched[TABLES * BUCKETS :] = True


def _best_cut(z: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F1, in the middle of its gap; z: distinct logits, clean and toxic: the rows that have each."""
    order = np.argsort(-z)
    z, hits = z[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.cumsum((clean + toxic)[order]) + max(1, hits[-1]))
    k = int(np.argmax(f1))
    below = z[k + 1] if k + 1 < len(z) else z[k] - 1
    return float((z[k] + below) / 2)


def labelled_rows(docs: DataFrame, labels: DataFrame, held_out) -> list[DataFrame]:
    """Tables, saved one after the other, of doc_id, toxic, n, lang, b of every labelled text that may be learned from.

    held_out is a condition on doc_id. Texts aren't shuffled: the labels are broadcast, LABELS_AT_ONCE for a pass over the texts.
    """
    usable = _usable(labels, held_out)
    turns = max(1, -(-usable.count() // LABELS_AT_ONCE))
    out = []
    for k in range(turns):
        now = F.broadcast(usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(turns)) == k))
        out.append(saved(_texts(docs).join(now, "doc_id").select("doc_id", "toxic", "text").mapInArrow(_hashed, HASHED), "labelled"))
    return out


def _usable(labels: DataFrame, held_out) -> DataFrame:
    return labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, found, langs in text_words(b.column("text")):
            n = len(found)
            sizes, raw = pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, n), b.column("toxic").slice(i, n), sizes, pa.array(langs, pa.int32()), raw], ["doc_id", "toxic", "n", "lang", "b"])


HASHED = "doc_id long, toxic int, n long, lang int, b binary"


def _parts(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[tuple[list[np.ndarray], np.ndarray, pa.RecordBatch]]:
    """Buckets and labels of at most `size` rows of a hashed table at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, size):
            b = whole.slice(i, size)
            yield [np.frombuffer(x, dtype=np.uint16).reshape(-1, TABLES) for x in b.column("b").to_pylist()], b.column("toxic").to_numpy().astype(np.int64), b


def train(docs: DataFrame, labels: DataFrame, held_out, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Fit the network on every labelled text, then calibrate it on every one of the fifth kept for validation.

    held_out (a condition on doc_id) marks rows that are never learned from. The buckets are hashed once and written to the shared
    folder. Counts of buckets are summed over all tasks. In an epoch each task goes through its rows from the same model, and the
    driver takes the mean of what the tasks that met a bucket added to it. The driver holds the model and its sums (21 MB),
    counts of buckets and counts of logits, whatever the input. Without texts of both labels the model gives everything the one label.
    """
    spark = docs.sparkSession
    tables = labelled_rows(docs, labels, held_out)
    rows = reduce(DataFrame.union, tables).withColumn("check", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(VALIDATION_SHARE)) == 0)
    sizes = {(r["check"], r["toxic"], r["some"]): r["count"] for r in rows.groupBy("check", "toxic", (F.col("n") > 0).alias("some")).count().collect()}

    def of(label: int, *checks: bool) -> int:
        return sum(sizes.get((c, label, True), 0) for c in checks)

    worded = [y for y in (0, 1) if of(y, False, True)]
    if len(worded) < 2:
        drop(*tables)
        return constant(worded[0] if worded else min((y for _, y, _ in sizes), default=0))
    fit, check, sides = rows.where("not check and n > 0"), rows.where("check"), (False,)
    if not of(0, False) or not of(1, False):
        fit, check, sides = rows.where("n > 0"), rows, (False, True)
    clean, toxic = of(0, *sides), of(1, *sides)
    n = clean + toxic
    weight = (n / (2 * clean), n / (2 * toxic))
    model = start(_all_counts(fit), n, toxic, seed)
    sums = np.full_like(model.values, 1e-6)
    tasks = fit.select("toxic", "b").coalesce(max(1, n // TASK_ROWS))
    for k in range(epochs):
        _epoch(spark, tasks, model.values, sums, weight, rate, (seed, k))
    model.shift = _shifts(check, model)
    drop(*tables)
    return model


def _all_counts(fit: DataFrame) -> np.ndarray:
    """bucket_counts of all rows; a task sends the buckets it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, TABLES * BUCKETS), dtype=np.int64)
        for rows, y, _ in _parts(batches):
            out += bucket_counts(rows, y)
        met = np.flatnonzero(out[0])
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(out[0, met]), pa.array(out[1, met])], ["key", "n", "toxic"])

    got = fit.select("toxic", "b").mapInArrow(run, "key long, n long, toxic long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    out = np.zeros((2, TABLES * BUCKETS), dtype=np.int64)
    out[:, got["key"].to_numpy()] = got["n"].to_numpy(), got["toxic"].to_numpy()
    return out


def _epoch(spark: SparkSession, fit: DataFrame, values: np.ndarray, sums: np.ndarray, weight: tuple[float, float], rate: float, seed: tuple[int, int]) -> None:
    """Every row once; values and sums take the mean change of the tasks that changed them."""
    shared = spark.sparkContext.broadcast((values, sums))
    names = [f"{kind}{d}" for kind in "vs" for d in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rng = shared.value, np.random.default_rng(seed)
        own = Learner(before[0].copy(), before[1].copy(), weight, rate)
        for rows, y, _ in _parts(batches):
            order = rng.permutation(len(rows))
            for i in range(0, len(order), STEP_ROWS):
                step = order[i : i + STEP_ROWS].tolist()
                own.learn([rows[j] for j in step], y[step])
        met = np.flatnonzero(own.touched)
        change = np.concatenate([own.model.values[met] - before[0][met], own.sums.values[met] - before[1][met]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(met), *[pa.array(np.ascontiguousarray(c)) for c in change.T]], ["key", *names])

    parts = fit.mapInArrow(run, ", ".join(["key long", *[f"{c} float" for c in names]]))
    got = parts.groupBy("key").agg(*[F.avg(c).cast("float").alias(c) for c in names]).toArrow()
    shared.destroy()
    key, change = got["key"].to_numpy(), np.stack([got[c].to_numpy() for c in names], axis=1)
    values[key] += change[:, :DIM]
    sums[key] += change[:, DIM:]


def _shifts(check: DataFrame, model: Model) -> np.ndarray:
    """The cut of each language from the logits of all validation rows, counted to a thousandth."""
    shared = check.sparkSession.sparkContext.broadcast(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value)
        for rows, _, b in _parts(batches):
            z = np.clip([own.logit(x) for x in rows], -30, 30) * BINS
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("toxic"), pa.array(np.floor(z).astype(np.int32))], ["lang", "toxic", "z"])

    bins = check.select("lang", "toxic", "b").mapInArrow(run, "lang int, toxic int, z int")
    got = bins.groupBy("lang", "z").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).toArrow()
    shared.destroy()
    lang, z, toxic, clean = (got[c].to_numpy() for c in ("lang", "z", "toxic", "clean"))
    out = np.zeros(len(LANGUAGES))
    if not toxic.sum():
        return out

    def cut(at: np.ndarray) -> float:
        values, inverse = np.unique(z[at], return_inverse=True)
        return _best_cut((values + 0.5) / BINS, np.bincount(inverse, clean[at]), np.bincount(inverse, toxic[at]))

    general = cut(np.ones(len(z), dtype=bool))
    for k in range(len(LANGUAGES)):
        # a language with few toxic rows takes the general cut
        out[k] = cut(lang == k) if toxic[lang == k].sum() >= 15 else general
    return out


@dataclass
class Sample:
    """Labelled texts: buckets, language and label of each, and how many labelled rows a sampled row of each label stands for."""

    rows: list[np.ndarray]
    langs: np.ndarray
    labels: np.ndarray
    weight: tuple[float, float] = (1.0, 1.0)


def training_rows(docs: DataFrame, labels: DataFrame, held_out, rows: int = TRAIN_ROWS) -> Sample:
    """A bounded sample of labelled texts, for a look at them on the driver (`train` learns from all): at most `rows` rows of each label, by least hash of the doc_id.

    held_out (a condition on doc_id) marks rows that are never learned from. So that the driver's share stays bounded, each label has
    half of TRAIN_WORDS words and what the other leaves of its half. If they don't hold all its texts, the longest ones are left
    out; a label none of whose texts fits keeps the first words of its shortest one.
    """
    usable = _usable(labels, held_out)
    totals = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    parts = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most 2 * rows rows of two numbers
    text = _texts(docs).join(chosen, "doc_id")
    # written once: which rows stay is decided on their word counts alone, and only those rows' words are read again
    small = saved(text.mapInArrow(_hashed, HASHED).withColumns({"h": F.xxhash64("b"), "row": F.monotonically_increasing_id()}), "sample")
    label = Window.partitionBy("toxic")  # all windows are over five numbers a row of the bounded sample
    by_length = label.orderBy(F.col("n") == 0, "n", F.xxhash64("doc_id"), "doc_id", "h", "row")
    share = F.greatest(F.lit(TRAIN_WORDS // 2), F.lit(TRAIN_WORDS) - F.sum("n").over(Window.partitionBy(F.lit(0))) + F.sum("n").over(label))
    shares = small.select("row", "doc_id", "toxic", "n", "h").withColumns({"share": share, "so_far": F.sum("n").over(by_length.rowsBetween(Window.unboundedPreceding, 0)), "place": F.row_number().over(by_length)})
    kept = shares.where((F.col("so_far") <= F.col("share")) | (F.col("place") == 1)).select("row", "share")
    words = F.expr(f"substring(b, 1, CAST(share * {2 * TABLES} AS INT))")  # of a text that fits, all
    got = small.join(F.broadcast(kept), "row").select("doc_id", "toxic", "lang", "h", words.alias("b")).toPandas().sort_values(["doc_id", "h"], kind="stable")
    drop(small)
    found = [np.frombuffer(x, dtype=np.uint16).reshape(-1, TABLES) for x in got["b"]]
    y = got["toxic"].to_numpy().astype(np.int64)
    weight = tuple(totals.get(k, 0) / max(1, int((y == k).sum())) for k in (0, 1))
    return Sample(found, got["lang"].to_numpy(), y, weight)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of the whole text of every row of docs.

    Null and wordless texts get the score of a text without any toxic word; repeated rows, null doc_ids and extra columns are
    harmless; an empty table gives no rows. The model (10 MB) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.values, model.shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for b in batches:
            scores = [own.score(x, k) for _, found, langs in text_words(b.column("text")) for x, k in zip(found, langs, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; learns from all labels (doc_id, toxic) outside the held-out fold.

    held_out: crc32 of the doc_id as text has remainder 0 by 5 (null doc_id: false). predicted is 1 from a score of 0.5.
    Labels that are null, neither 0 nor 1 or without a document aren't learned from; without any, scores are near 0.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = train(docs, labels, held_out)
    scored = score_documents(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
