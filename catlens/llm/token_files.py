"""Operator 9: token-id files of bit or byte planes.

A shard file holds the ids of a range of documents in ascending doc_id order:

    magic "BPT1" | blocks | document table | JSON footer | footer length (u64) | magic

A block is `block_ids` ids (the last one fewer). Its ids are transposed into planes: byte planes
(byte k of every little-endian 32-bit id) or bit planes (bit k of every id, packed); every plane is
compressed by zstandard on its own, and planes of zeros are not stored. The footer is the chunk index: of every
block its offset, number of ids, plane lengths and the CRC-32 of its ids, so `read_ids` decodes only
the blocks that a range of ids touches. The document table holds doc_id and length of each document.

Words are encoded once per worker process and cached: the tokenizer drops white space and no rule of it looks
across ASCII white space, so a text's ids are those of its white-space-separated pieces in order. Where the
tokenizer's rules are known to allow it, a word of ASCII letters and marks is two such pieces, its letters in lower case and its marks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import RangeReader, atomic_writer
from .shared import KEPT, bucket_of, order_bounds, partitions, runs, saved, scratch, text_buffers
from .words import MARKS, coded_pieces, coded_words

MAGIC = b"BPT1"
BLOCK_IDS = 1 << 16
END_ID = 1
CACHED_WORDS = 1_000_000
#: New words of a line given to the tokenizer, and of a call of it: what it returns takes some hundred bytes a token.
LINE, CALL_WORDS = 64, 1 << 13
# fixed values: rules by which a tokenizer makes texts pieces
_WHITE = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    """The planes of uint32 ids, lowest first, as raw bytes."""
    if mode == "byte":
        return [p.tobytes() for p in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return [np.packbits((ids >> np.uint32(k)) & np.uint32(1)).tobytes() for k in range(32)]


def from_planes(planes: list[bytes | None], n: int, mode: str) -> np.ndarray:
    """The n ids of their planes; None is a plane of zeros."""
    if mode == "byte":
        out = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            if p is not None:
                out[:, k] = np.frombuffer(p, dtype=np.uint8)
        return out.reshape(-1).view("<u4").astype(np.uint32)
    ids = np.zeros(n, dtype=np.uint32)
    for k, p in enumerate(planes):
        if p is not None:
            ids |= np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return ids


class ShardWriter:
    """Writes one shard to a binary stream, holding one block of ids at a time."""

    def __init__(self, out, mode: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        if mode not in ("byte", "bit"):
            raise ValueError("mode is byte or bit")
        self._out, self._mode, self._block_ids = out, mode, block_ids
        self._zip = zstandard.ZstdCompressor(level=level)
        self._blocks: list[list] = []
        self._docs: list[np.ndarray] = []
        self._lengths: list[np.ndarray] = []
        self._waiting: list[np.ndarray] = []
        self._n_waiting = self.n_ids = self.n_docs = 0
        out.write(MAGIC)
        self._at = len(MAGIC)

    def add(self, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self._docs.append(np.asarray(doc_ids, dtype="<i8"))
        self._lengths.append(np.asarray(lengths, dtype="<i8"))
        self._waiting.append(ids.astype(np.uint32))
        self._n_waiting += len(ids)
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        if self._n_waiting >= self._block_ids:
            every = np.concatenate(self._waiting)
            whole = len(every) // self._block_ids * self._block_ids
            for k in range(0, whole, self._block_ids):
                self._write_block(every[k : k + self._block_ids])
            self._waiting, self._n_waiting = [every[whole:]], len(every) - whole

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def _write_block(self, ids: np.ndarray) -> None:
        entry = [self._at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), []]
        for plane in to_planes(ids, self._mode):
            packed = self._zip.compress(plane) if any(plane) else b""
            entry[3].append(len(packed))
            self._put(packed)
        self._blocks.append(entry)

    def close(self) -> None:
        if self._n_waiting:
            self._write_block(np.concatenate(self._waiting))
        tables = []
        for parts in (self._docs, self._lengths):
            raw = (np.concatenate(parts) if parts else np.zeros(0, "<i8")).astype("<i8")
            packed = self._zip.compress(raw.view(np.uint8).reshape(-1, 8).T.tobytes())
            tables.append([self._at, len(packed)])
            self._put(packed)
        footer = json.dumps({"mode": self._mode, "n_docs": self.n_docs, "n_ids": self.n_ids, "block_ids": self._block_ids, "blocks": self._blocks, "tables": tables}).encode()
        self._put(footer)
        self._put(struct.pack("<Q", len(footer)) + MAGIC)


class ShardReader:
    """Reads a shard by range: the footer first, then the blocks that are asked for."""

    def __init__(self, uri: str):
        self._file = RangeReader(uri)
        tail = self._file.read(self._file.size - 12, 12)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        (length,) = struct.unpack("<Q", tail[:8])
        self.footer = json.loads(self._file.read(self._file.size - 12 - length, length))
        self._zip = zstandard.ZstdDecompressor()

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and length of each document in file order."""
        out = []
        for at, length in self.footer["tables"]:
            raw = self._zip.decompress(self._file.read(at, length), max_output_size=max(1, 8 * self.footer["n_docs"]))
            out.append(np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view("<i8"))
        return out[0], out[1]

    def block(self, k: int) -> np.ndarray:
        at, n, crc, sizes = self.footer["blocks"][k]
        raw, planes = self._file.read(at, sum(sizes)), []
        width = n if self.footer["mode"] == "byte" else (n + 7) // 8
        for size in sizes:
            planes.append(self._zip.decompress(raw[:size], max_output_size=width) if size else None)
            raw = raw[size:]
        ids = from_planes(planes, n, self.footer["mode"])
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def read_ids(self, start: int, n: int) -> np.ndarray:
        """ids start .. start + n of the shard; decodes only the blocks they lie in."""
        size = self.footer["block_ids"]
        if n <= 0:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // size, (start + n - 1) // size
        return np.concatenate([self.block(k) for k in range(first, last + 1)])[start - first * size :][:n]

    def close(self) -> None:
        self._file.close()


def _splits_pieces(tokenizer) -> bool:
    """Whether the ids of a word of ASCII letters and then marks are those of its letters in lower case and those of its marks.

    True only for rules known to keep to that: texts are put in lower case, a run of letters is a piece of its own, and no
    added token can lie in such a word or come of its lower case.
    """
    rules = json.loads(tokenizer.to_str())
    steps = (rules["normalizer"] or {}).get("normalizers", [])
    known = [s["type"] == "NFC" or s["type"] == "Lowercase" or s == _WHITE for s in steps]
    splits = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    first = splits[0] if splits else {}
    return bool(
        all(known) and any(s["type"] == "Lowercase" for s in steps)
        and first.get("type") == "Split" and first["pattern"] == {"Regex": _PIECES} and first["invert"] and first["behavior"] == "Removed"
        and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in splits[1:])
        and rules["model"]["type"] == "BPE" and rules["model"]["end_of_word_suffix"]
        and not any(re.fullmatch(f"[A-Za-z{MARKS}]*", t["content"]) for t in rules["added_tokens"])
    )


class WordEncoder:
    """Texts to ids through a cache of encoded words of bounded size."""

    def __init__(self, tokenizer_path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._pieces = _splits_pieces(self._tokenizer)
        self._coded = coded_pieces if self._pieces else partial(coded_words, lower=False)
        if self._pieces:
            vocabulary, suffix = self._tokenizer.get_vocab(), self._tokenizer.model.end_of_word_suffix
            self._last = np.zeros(1 + max(vocabulary.values()), dtype=bool)
            self._last[[k for w, k in vocabulary.items() if w.endswith(suffix)]] = True
        self._cached = cached
        self._clear()

    def _clear(self) -> None:
        self._number: dict[bytes, int] = {}
        self._flat, self._n_flat = np.zeros(1 << 16, dtype=np.uint32), 0
        self._at, self._len = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _learn(self, new: list[bytes], letters: bool) -> None:
        ids, sizes = self._ids_of_letters(new) if letters else self._ids_of_words(new)
        base, n = len(self._number), len(ids)
        while self._n_flat + n > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        while base + len(new) > len(self._at):
            self._at, self._len = np.concatenate([self._at, np.zeros_like(self._at)]), np.concatenate([self._len, np.zeros_like(self._len)])
        self._flat[self._n_flat : self._n_flat + n] = ids
        self._at[base : base + len(new)] = self._n_flat + np.cumsum(sizes) - sizes
        self._len[base : base + len(new)] = sizes
        self._n_flat += n
        self._number.update(zip(new, range(base, base + len(new)), strict=True))

    def _ids_of_letters(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # each is one piece, whose last token alone has the suffix
        lines = [b" ".join(new[k : k + LINE]).decode("ascii") for k in range(0, len(new), LINE)]
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in self._tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        sizes = np.diff(np.flatnonzero(self._last[ids]), prepend=-1)
        return (ids, sizes) if len(sizes) == len(new) else self._ids_of_words(new)

    def _ids_of_words(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # one call for all: a token belongs to the word in which it starts
        words = [w.decode("utf-8") for w in new]
        found = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.uint32)
        starts = np.fromiter((o[0] for o in found.offsets), dtype=np.int64, count=len(ids))
        word_ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        return ids, np.bincount(np.searchsorted(word_ends, starts, side="right"), minlength=len(new))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the UTF-8 texts, END_ID after each, and the number of ids of each text."""
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        return self.encode_buffer(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))

    def encode_buffer(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts data[offsets[i]:offsets[i + 1]]: each distinct word is looked up once."""
        if len(self._number) > self._cached:
            self._clear()
        distinct, code, rows = self._coded(data, offsets)
        every = distinct.cast(pa.binary()).to_pylist()
        numbers = np.fromiter(map(self._number.get, every, repeat(-1)), dtype=np.int64, count=len(every))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new = [every[k] for k in unknown.tolist()]
            letters = np.fromiter(map(bytes.isalpha, new), dtype=bool, count=len(new)) & self._pieces
            for kind in (True, False):
                at = np.flatnonzero(letters == kind)
                numbers[unknown[at]] = len(self._number) + np.arange(len(at))
                for i in range(0, len(at), CALL_WORDS):
                    self._learn([new[k] for k in at[i : i + CALL_WORDS].tolist()], kind)
        numbers = numbers[code] if len(every) else numbers
        sizes = self._len[numbers]
        ends = np.cumsum(sizes)
        word_ends = np.searchsorted(rows, np.arange(len(offsets) - 1), side="right")
        text_ends = np.concatenate([[0], ends])[word_ends] if len(offsets) > 1 else np.zeros(0, np.int64)
        ids = self._flat[np.repeat(self._at[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return np.insert(ids, text_ends, END_ID), np.diff(np.concatenate([[0], text_ends])) + 1


def encoder(tokenizer_path: str) -> WordEncoder:
    """The worker process's encoder: its words stay known from task to task, until other work needs the memory."""
    if tokenizer_path not in KEPT:
        KEPT[tokenizer_path] = WordEncoder(tokenizer_path)
    return KEPT[tokenizer_path]


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str | None = None, mode: str = "byte", shards: int | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write docs (doc_id, text) as shard files below `out` and return the manifest.

    Manifest, one row a shard with documents: shard int, path string, n_docs, n_ids long. Ids ascend
    by doc_id within and across shards; null doc_ids come first, are stored as the least long and come back as null;
    rows that share a doc_id keep a row each, in the order of their texts; a null text is empty (one end
    id); no documents give no files. Other columns are ignored. tokenizer_path must be readable by the
    executors; `out` is a new folder below spark.checkpoint.dir unless given.
    """
    spark = docs.sparkSession
    n = shards or partitions(spark)
    target = out or scratch(spark, "tokens")
    key = F.col("doc_id").cast("long")
    bounds = order_bounds(docs, key, n)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard, words = first.column("shard")[0].as_py(), encoder(tokenizer_path)
        path = f"{target}/shard-{shard:05d}.bpt"
        with atomic_writer(path) as stream:
            writer = ShardWriter(stream, mode, block_ids)

            def add(b: pa.RecordBatch) -> None:
                data, offsets = text_buffers(b.column("text"))
                ids = b.column("doc_id").fill_null(-(2**63)).to_numpy()
                for i, j in runs(offsets):
                    tokens, lengths = words.encode_buffer(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    writer.add(ids[i:j], lengths, tokens)

            add(first)
            for b in batches:
                add(b)
            writer.close()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": pa.array([writer.n_docs], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})

    ranged = docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("shard", bucket_of(F.col("doc_id"), bounds))
    placed = ranged.repartitionById(n, "shard").sortWithinPartitions("doc_id", "text")
    return saved(placed.mapInArrow(write, "shard int, path string, n_docs long, n_ids long"), "manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; start counts the ids of all documents before it."""
    shards = sorted((r["shard"], r["path"], r["n_ids"]) for r in manifest.collect())  # one small row a shard
    starts, rows = 0, []
    for _, path, n_ids in shards:
        rows.append((path, starts))
        starts += n_ids
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, base in zip(frame["path"], frame["start"], strict=True):
                yield from _read_shard(path, int(base))

    files = spark.createDataFrame(pd.DataFrame({"n": range(len(rows)), "path": [r[0] for r in rows], "start": [r[1] for r in rows]}), "n int, path string, start long")
    return files.repartitionById(len(rows), "n").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_shard(path: str, base: int) -> Iterator[pd.DataFrame]:
    reader = ShardReader(path)
    doc_ids, lengths = reader.documents()
    ends = np.cumsum(lengths)
    crcs, crc, doc, at = np.zeros(len(doc_ids), dtype=np.int64), 0, 0, 0
    for k in range(len(reader.footer["blocks"])):
        raw = memoryview(reader.block(k).astype("<u4").tobytes())
        n, done = len(raw) // 4, 0
        while done < n:
            take = min(n - done, int(ends[doc]) - at)
            crc = zlib.crc32(raw[4 * done : 4 * (done + take)], crc)
            done, at = done + take, at + take
            if at == ends[doc]:
                crcs[doc], crc, doc = crc, 0, doc + 1
    reader.close()
    for k in range(0, len(doc_ids), 10_000):
        ids = pd.Series(doc_ids[k : k + 10_000]).astype("Int64")
        yield pd.DataFrame({"doc_id": ids.mask(ids == -(2**63)), "start": base + ends[k : k + 10_000] - lengths[k : k + 10_000], "n_tokens": lengths[k : k + 10_000], "ids_crc32": crcs[k : k + 10_000]})
