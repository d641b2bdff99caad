"""Operator 1: document fingerprints by one-permutation MinHash.

Every distinct shingle is hashed once: its high bits choose one of K bins, its low 32 bits are the
value, and a bin keeps its least value. Empty bins are filled by optimal densification: bin i walks
its own pseudo-random sequence of bins until one that was filled, and copies its value. (After
`WALK` steps, which only sparse documents need, the sequence goes on as the filled bin with the
least hash of the pair of bins: the same walk continued as a random permutation.) The lowest b bits
of a hash of every bin's value and number are packed. Two documents agree in a bin by chance with C = 2^-b, so the share m of
equal bins estimates the Jaccard similarity as (m - C) / (1 - C), limited to 0..1.

`fingerprints` also gives every document its successor by doc_id: ids are cut into ranges of equal
row counts, a range is one sorted partition, and the first row of the next range comes along, so
no window runs over the whole table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import LONG_MIN, bucket_of, order_bounds, partitions, runs, text_buffers
from .words import U, mix, shingles, word_hashes, words

BINS = 1024
BITS = 4
SHINGLE = 5
WALK = 24
_EMPTY = np.uint32(0xFFFFFFFF)


def _densify(bins: np.ndarray) -> np.ndarray:
    """bins (documents x K, _EMPTY where empty) with the empty bins of non-empty documents filled."""
    n, k = bins.shape
    out = bins.copy()
    filled = (bins != _EMPTY).any(axis=1)
    rows, cols = np.nonzero((bins == _EMPTY) & filled[:, None])
    for step in range(WALK):
        if not len(rows):
            return out
        donors = (mix((cols.astype(U) << U(20)) + U(step + 1)) % U(k)).astype(np.int64)
        values = bins[rows, donors]
        hit = values != _EMPTY
        out[rows[hit], cols[hit]] = values[hit]
        rows, cols = rows[~hit], cols[~hit]
    cuts = np.searchsorted(rows, np.arange(n + 1))
    for r in np.unique(rows):
        mine = cols[cuts[r] : cuts[r + 1]]
        donors = np.flatnonzero(bins[r] != _EMPTY)
        best = mix((mine.astype(U) << U(40))[:, None] + donors.astype(U)[None, :] + U(1 << 62)).argmin(axis=1)
        out[r, mine] = bins[r, donors[best]]
    return out


def fingerprint_rows(data: np.ndarray, offsets: np.ndarray, bins: int = BINS, bits: int = BITS, size: int = SHINGLE) -> list[bytes]:
    """Packed fingerprints of the texts data[offsets[i]:offsets[i+1]]; b'' for a text without words."""
    starts, ends, rows = words(data, offsets)
    n = len(offsets) - 1
    h, r = shingles(word_hashes(data, starts, ends), rows, n, size)
    out: list[bytes] = []
    cuts = np.searchsorted(r, np.arange(n + 1))
    shift = U(64 - bins.bit_length() + 1)
    for i in range(0, n, 256):  # a block of documents: 256 x K values
        j = min(n, i + 256)
        m = np.full((j - i, bins), _EMPTY, dtype=np.uint32)
        hh, rr = h[cuts[i] : cuts[j]], r[cuts[i] : cuts[j]] - i
        place = rr * bins + (hh >> shift).astype(np.int64)
        np.minimum.at(m.reshape(-1), place, np.minimum((hh & U(0xFFFFFFFF)).astype(np.uint32), _EMPTY - np.uint32(1)))
        # a value that fills several bins gives unlike bits in each, so a chance hit counts once
        low = (mix(_densify(m).astype(U) + (np.arange(bins, dtype=U) << U(32))) & U((1 << bits) - 1)).astype(np.uint32)
        packed = _pack(low, bits)
        out += [packed[k].tobytes() if cuts[i + k + 1] > cuts[i + k] else b"" for k in range(j - i)]
    return out


def _pack(low: np.ndarray, bits: int) -> np.ndarray:
    planes = ((low[:, :, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return np.packbits(planes.reshape(len(low), -1), axis=1)


def likeness(a: list[bytes], b: list[bytes], bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of pairs of fingerprints; 1 of two empty ones, 0 of an empty and another one."""
    out = np.zeros(len(a))
    both = [k for k in range(len(a)) if a[k] and b[k]]
    for k in range(len(a)):
        if not a[k] and not b[k]:
            out[k] = 1.0
    for i in range(0, len(both), 1024):
        ks = both[i : i + 1024]
        x = np.frombuffer(b"".join(a[k] for k in ks), dtype=np.uint8) ^ np.frombuffer(b"".join(b[k] for k in ks), dtype=np.uint8)
        x = x.reshape(len(ks), -1)
        if bits == 4:
            same = ((x & 0x0F) == 0).sum(axis=1) + ((x & 0xF0) == 0).sum(axis=1)
            bins = 2 * x.shape[1]
        else:
            groups = np.unpackbits(x, axis=1).reshape(len(ks), -1, bits)
            same, bins = (groups == 0).all(axis=2).sum(axis=1), groups.shape[1]
        chance = 2.0**-bits
        out[ks] = np.clip((same / bins - chance) / (1 - chance), 0.0, 1.0)
    return out


def decode(fingerprint: str) -> bytes:
    return base64.b64decode(fingerprint)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _buffers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(pa.array(texts, type=pa.large_string()))


def _prints(texts: list[str], bins: int, bits: int, size: int) -> list[bytes]:
    data, offsets = _buffers(texts)
    out: list[bytes] = []
    for i, j in runs(offsets):
        out += fingerprint_rows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bins, bits, size)
    return out


def _chained(ids: list, texts: list[str], bins: int, bits: int, size: int) -> pd.DataFrame:
    """Rows of all texts but the last, which only serves as the successor of the one before."""
    prints = _prints(texts, bins, bits, size)
    edited = [(t[: len(t) - len(t) // 4] + s[: len(t) // 4]) for t, s in zip(texts, texts[1:], strict=False)]
    edited_prints = _prints(edited, bins, bits, size)
    own, after = prints[:-1], prints[1:]
    return pd.DataFrame(
        {
            "doc_id": pd.array(ids[:-1], dtype="Int64"),
            "n_chars": np.fromiter(map(len, texts[:-1]), dtype=np.int64, count=len(own)),
            "edited_sha256": [hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited],
            "fingerprint": [base64.b64encode(p).decode() for p in own],
            "edited_fingerprint": [base64.b64encode(p).decode() for p in edited_prints],
            "near_edited": likeness(own, edited_prints, bits),
            "near_next": likeness(own, after, bits),
        }
    )


def fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS, size: int = SHINGLE) -> DataFrame:
    """Fingerprint of every row of docs (doc_id, text), of its edited text, and likeness to the next document.

    The edited text replaces the last floor(n_chars / 4) code points by the first as many (or all) of the
    next row's text. Rows follow each other by doc_id, rows with equal ids by their texts, null ids first,
    and the first row follows the last; a single row follows itself. Null text is empty; a text without
    words has an empty fingerprint (likeness 1 to another such, 0 to others). Shingles are `size`
    lower-cased (A-Z) words, fewer words are one shingle. bins is a power of two. An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds = order_bounds(base, F.col("doc_id"), n)
    base = base.withColumn("bucket", bucket_of(F.col("doc_id"), bounds)).withColumn("k", F.coalesce("doc_id", F.lit(LONG_MIN)))
    # one id a range reaches the driver, then one row a range joins the range before it
    least = sorted((r["bucket"], r["k"]) for r in base.groupBy("bucket").agg(F.min("k").alias("k")).collect())
    if not least:
        return spark.createDataFrame([], _SCHEMA)
    before = {b: least[i - 1][0] for i, (b, _) in enumerate(least)}
    heads = base.where(F.col("k").isin([k for _, k in least])).groupBy("bucket").agg(F.min(F.struct("k", "text", "doc_id")).alias("h"))
    to = F.create_map(*[F.lit(x).cast("int") for pair in before.items() for x in pair])
    heads = heads.select(F.col("h.doc_id").alias("doc_id"), F.col("h.text").alias("text"), to[F.col("bucket")].alias("bucket"), F.col("h.k").alias("k"), F.lit(True).alias("extra"))
    rows = base.withColumn("extra", F.lit(False)).unionByName(heads)
    placed = rows.repartitionById(max(b for b, _ in least) + 1, "bucket").sortWithinPartitions("extra", "k", "text").select("doc_id", "text")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held = 0
        for b in batches:
            for i in range(0, b.num_rows, 512):
                more = b.slice(i, 512)
                ids += more.column("doc_id").to_pylist()
                texts += more.column("text").to_pylist()
                held = sum(map(len, texts))
                if held > 1 << 20:
                    yield pa.RecordBatch.from_pandas(_chained(ids, texts, bins, bits, size), preserve_index=False)
                    ids, texts = ids[-1:], texts[-1:]
        if len(texts) > 1:
            yield pa.RecordBatch.from_pandas(_chained(ids, texts, bins, bits, size), preserve_index=False)

    return placed.mapInArrow(chain, _SCHEMA)
