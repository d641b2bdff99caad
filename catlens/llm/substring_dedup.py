"""Operator 7: removal of repeated word windows with a compressed FM-index per shard.

1. Anchors. Of the 12-word grams inside a window of `window` words the one with the least hash is
   the window's anchor, so equal windows have equal anchors. A document becomes passages: maximal
   runs of window starts with one anchor. Only (anchor, passage hash, position) rows are shuffled.
2. Anchors that lie in one document only are dropped: their windows can't repeat.
3. Passages of the other anchors are reduced to distinct ones with their least document, and the
   text of one occurrence of each is fetched.
4. Shards. All passages of an anchor are in one shard. A task cuts its sorted passages into shards of
   about SHARD_WORDS words, builds the FM-index of each (suffix array, BWT in a wavelet matrix with
   packed bits) and streams the passages through it from right to left: backward search, all passages
   in step, gives at each position the suffixes that match `window` words, and those give the least document.
5. Results return to all occurrences by a join on the passage hash, and to documents by a join.

An anchor with more than CROWDED distinct passages, which would be one large shard, is cut finer: its passages
are anchored anew by longer grams (12, 31, 41, 46, 48, 49 and 50 of 50 words, one length at a time while an anchor
is crowded), still by the least gram of a window, so equal windows stay together, and reduced to distinct ones. At the
last length an anchor is one window, so every window is answered by the FM-index of a shard of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex, window_classes
from .shared import LONG_MIN, partitions, runs, saved, text_buffers
from .words import U, mix, mix_int, shingles, word_hashes, words

GRAM = 12
SHARD_WORDS = 300_000
CROWDED = 20_000
_STEP = mix_int(77) | 5
_BACK = pow(_STEP, -1, 1 << 64)


def _prefix_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums by which a run of words [a, b) is hashed, and the factors that shift them."""
    n = len(h)
    up, down = np.full(n + 1, U(_STEP)), np.full(n + 1, U(_BACK))
    up[0] = down[0] = U(1)
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(h * up[:n], out=total[1:])
    return total, down


def _run_hash(total: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((total[b] - total[a]) * down[a] + (b - a).astype(U))


def _anchors(part: np.ndarray, offsets: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """row, anchor hash, passage hash, first and last window start (in words) of every passage."""
    starts, ends, rows = words(part, offsets)
    h = word_hashes(part, starts, ends, lower=False)
    span = window - gram + 1
    z = np.zeros(0, dtype=np.int64)
    if len(h) < window:
        return z, z, z, z, z
    n_rows = len(offsets) - 1
    first_word = np.searchsorted(rows, np.arange(n_rows))
    grams = np.full(len(h), U(0))
    g = np.zeros(len(h) - gram + 1, dtype=U)
    for j in range(gram):
        g += h[j : j + len(g)] * U(mix_int(1000 + j) | 1)
    grams[: len(g)] = mix(g)
    least = np.lib.stride_tricks.sliding_window_view(grams[: len(g)], span).argmin(axis=1)
    begin = np.flatnonzero(rows[: len(least)] == rows[window - 1 :][: len(least)])
    anchor = begin + least[begin]
    if not len(begin):
        return z, z, z, z, z
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1) | (rows[begin[1:]] != rows[begin[:-1]])])
    s1 = begin[new]
    s2 = begin[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begin) - 1]])]
    total, down = _prefix_hashes(h)
    row = rows[s1]
    return row, grams[anchor[new]].view(np.int64), _run_hash(total, down, s1, s2 + window).view(np.int64), s1 - first_word[row], s2 - first_word[row]


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_buffers(b.column("text"))
        k, t = b.column("k").to_numpy(), b.column("t").to_numpy()
        for i, j in runs(offsets):
            row, anchor, passage, s1, s2 = _anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window)
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, passage, k[i + row], t[i + row], s1.astype(np.int32), (s2 - s1).astype(np.int32))], ["anchor", "passage", "k", "t", "s1", "more"])


def _texts_of_passages(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The text of each listed passage of each document."""
    for b in batches:
        texts, lists = b.column("text"), b.column("passages")
        anchors, passages, out, least = [], [], [], []
        for text, items, k in zip(texts, lists, b.column("k").to_pylist(), strict=True):
            raw = text.as_buffer()
            data = np.frombuffer(raw, dtype=np.uint8)
            starts, ends, _ = words(data, np.array([0, len(data)]))
            whole = memoryview(raw)
            for item in items.as_py():
                anchors.append(item["anchor"])
                passages.append(item["passage"])
                least.append(k)
                out.append(bytes(whole[starts[item["s1"]] : ends[item["s1"] + item["more"] + window - 1]]).decode("utf-8"))
            if len(out) >= 4000:
                yield _passage_batch(anchors, passages, least, out)
                anchors, passages, out, least = [], [], [], []
        if out:
            yield _passage_batch(anchors, passages, least, out)


def _passage_batch(anchors, passages, least, out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(passages, pa.int64()), pa.array(least, pa.int64()), pa.array(out, pa.string())], ["anchor", "passage", "k", "text"])


_ANSWER = "anchor long, passage long, begin int, finish int, least long"


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Collect passages, sorted by anchor, into shards that don't cut an anchor."""
    held: list[pa.RecordBatch] = []
    held_bytes, last = 0, None
    for b in batches:
        anchors = b.column("anchor").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1, [len(anchors)]])
        data_ends = np.concatenate([[0], np.cumsum([len(x) for x in b.column("text").to_pylist()])])
        done = 0
        for c in cuts[:-1]:
            c = int(c)
            if held_bytes + data_ends[c] - data_ends[done] >= SHARD_WORDS * 6 and (c > 0 or anchors[0] != last):
                held.append(b.slice(done, c - done))
                yield from _shard(pa.Table.from_batches(held), window)
                held, held_bytes, done = [], 0, c
        held.append(b.slice(done))
        held_bytes += int(data_ends[-1] - data_ends[done])
        last = anchors[-1] if len(anchors) else last
    if held:
        yield from _shard(pa.Table.from_batches(held), window)


def _shard(passages: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    """Build the FM-index of one shard and stream its passages through it."""
    if not len(passages):
        return
    data, offsets = text_buffers(passages.column("text"))
    starts, ends, rows = words(data, offsets)
    codes, symbols = np.unique(word_hashes(data, starts, ends, lower=False), return_inverse=True)
    symbols = symbols.astype(np.int64) + 2  # 0 closes the text, 1 follows each passage
    lengths = np.bincount(rows, minlength=len(passages))
    ends_plain = np.cumsum(lengths)
    text = np.insert(symbols, ends_plain, 1)
    owner = np.repeat(np.arange(len(passages)), lengths + 1)
    index = FMIndex(text, window)
    k = passages.column("k").to_numpy()
    owners = np.concatenate([owner, [0]])[index.sa]
    least = np.minimum.reduceat(k[owners], index.class_first)
    doc, at, cls = window_classes(index, text, ends_plain + np.arange(len(passages)), lengths, window)
    order = np.lexsort((at, doc))
    doc, at, value = doc[order], at[order], least[cls[order]]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(doc) - 1]])
    anchor, passage = passages.column("anchor").to_numpy(), passages.column("passage").to_numpy()
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor[doc[first]], passage[doc[first]], at[first].astype(np.int32), at[last].astype(np.int32), value[first])], ["anchor", "passage", "begin", "finish", "least"])


def _finer(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The passages of longer grams inside each passage: the anchor that both give, and the place in the passage."""
    for b in batches:
        data, offsets = text_buffers(b.column("text"))
        anchor, passage, k = (b.column(c).to_numpy() for c in ("anchor", "passage", "k"))
        for i, j in runs(offsets, 1 << 16):  # a word can be in as many finer passages as a window has words
            part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            row, a, p, s1, s2 = _anchors(part, off, window, gram)
            if not len(row):
                continue
            starts, ends, rows = words(part, off)
            first, raw, at = np.searchsorted(rows, row), part.tobytes(), i + row
            texts = [raw[x:y].decode("utf-8") for x, y in zip(starts[first + s1].tolist(), ends[first + s2 + window - 1].tolist(), strict=True)]
            both = mix(mix(anchor[at].view(U)) ^ a.view(U)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor[at], passage[at], s1.astype(np.int32), both, p, k[at], texts)], ["anchor", "passage", "at", "finer", "part", "k", "text"])


def _answers(passages: DataFrame, window: int, crowded: int, gram: int = GRAM) -> DataFrame:
    """The least document of every window of distinct passages, as ranges of window starts in a passage."""
    n = partitions(passages.sparkSession)
    shards = lambda df: df.repartition(n, "anchor").sortWithinPartitions("anchor", "passage").mapInArrow(lambda it: _shards(it, window), _ANSWER)
    if gram >= window:
        return shards(passages)
    crowds = saved(passages.groupBy("anchor").count().where(F.col("count") > crowded).select("anchor"), "crowds")
    if crowds.isEmpty():
        return shards(passages)
    longer = (gram + window + 1) // 2
    parts = passages.join(crowds, "anchor").mapInArrow(lambda it: _finer(it, window, longer), "anchor long, passage long, at int, finer long, part long, k long, text string")
    parts = saved(parts, "finer")
    distinct = parts.groupBy(F.col("finer").alias("anchor"), F.col("part").alias("passage")).agg(F.min("k").alias("k"), F.min("text").alias("text"))
    below = _answers(saved(distinct, "texts"), window, crowded, longer)
    below = below.select(F.col("anchor").alias("finer"), F.col("passage").alias("part"), "begin", "finish", "least")
    back = parts.select("anchor", "passage", "at", "finer", "part").join(below, ["finer", "part"])
    back = back.select("anchor", "passage", (F.col("at") + F.col("begin")).alias("begin"), (F.col("at") + F.col("finish")).alias("finish"), "least")
    return shards(passages.join(crowds, "anchor", "left_anti")).union(back)


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, spans = b.column("text"), b.column("spans")
        n_words, n_removed, kept, cut = [], [], [], []
        for text, runs_ in zip(texts, spans, strict=True):
            pieces = text.as_buffer().to_pybytes().split()
            n_words.append(len(pieces))
            merged: list[list[int]] = []
            if runs_.is_valid:
                for x in sorted((r["from"], r["to"]) for r in runs_.as_py()):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append([*x])
            removed = sum(y - x for x, y in merged)
            if removed:
                stay, at = [], 0
                for x, y in merged:
                    stay += pieces[at:x]
                    at = y
                pieces = stay + pieces[at:]
            n_removed.append(removed)
            cut.append([{"from": x, "to": y} for x, y in merged])
            kept.append(b" ".join(pieces).decode("utf-8"))
        spans_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(cut, spans_type), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = 50, crowded: int = CROWDED) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word ranges [from, to) removed), kept_text of every row of docs.

    Words are runs of other bytes than 0x20 and 0x09-0x0D, unchanged. A word goes if a run of `window` words
    that covers it also stands in a document with a smaller doc_id, judged on the input; a null doc_id counts as
    smaller than all others. Rows that share a doc_id don't remove each other's words and keep a row each.
    Kept words are joined by one space. Null or blank text has no words and an empty kept text. An empty
    table gives no rows; other columns are ignored. window must be greater than 12.
    """
    if window <= GRAM:
        raise ValueError("window must be greater than 12")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("k", F.coalesce("doc_id", F.lit(LONG_MIN))).withColumn("t", F.xxhash64("text"))
    rows = saved(base.select("text", "k", "t").mapInArrow(lambda it: _anchor_rows(it, window), "anchor long, passage long, k long, t long, s1 int, more int"), "anchors")
    # written, so that both sides of the join below are shuffled and a hot anchor can be split
    repeated = saved(rows.groupBy("anchor").agg(F.min("k").alias("k0"), F.max("k").alias("k1")).where("k0 < k1").select("anchor"), "repeated")
    found = saved(rows.join(repeated, "anchor", "left_semi").distinct(), "passages")

    distinct = found.groupBy("anchor", "passage").agg(F.min(F.struct("k", "t", "s1", "more")).alias("r"))
    wanted = distinct.select("anchor", "passage", "r.*").groupBy("k", "t").agg(F.collect_list(F.struct("anchor", "passage", "s1", "more")).alias("passages"))
    texts = base.select("text", "k", "t").join(wanted, ["k", "t"])
    # exact repeated rows would give their passages more than once: the shards drop them by (anchor, passage)
    passages = saved(texts.select("text", "passages", "k").mapInArrow(lambda it: _texts_of_passages(it, window), "anchor long, passage long, k long, text string"), "texts")

    answers = _answers(passages, window, crowded)
    hits = found.join(answers, ["anchor", "passage"]).where("least < k")
    span = F.struct((F.col("s1") + F.col("begin")).cast("long").alias("from"), (F.col("s1") + F.col("finish") + window).cast("long").alias("to"))
    spans = hits.select("k", "t", span.alias("span")).groupBy("k", "t").agg(F.collect_set("span").alias("spans"))
    return base.join(spans, ["k", "t"], "left").select("doc_id", "text", "spans").mapInArrow(lambda it: _kept(it, window), "doc_id long, n_words long, n_removed long, spans array<struct<from:long,to:long>>, kept_text string")
