"""Operator 10: WARC archives with a two-level capture index.

Writing. Records of equal payloads of at least 1000 bytes are found by the payload's SHA-1: the
greatest page_id of a digest is a response record, the others are revisit records that refer to it.
Greatest ids come from a pre-aggregated groupBy and meet the pages by a join, so a payload with a
third of all pages is split by adaptive execution. Each task writes one archive of gzip members
(one a record) under a name of its own and renames it.

Index. Captures are sorted by (reversed-host URL key, page_id) over range-partitioned shard files.
A shard holds compressed blocks of lines and, at its end, a sparse directory with the first key of
every block. A lookup takes the shards whose key range holds the key, loads such a shard's
directory, binary-searches it, reads one block by range, binary-searches the block, and then reads
the records by range from the archives, neighbours in one read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import RangeReader, atomic_writer
from .shared import partitions, saved, scratch

LEAST_BYTES = 1000
BLOCK_LINES = 2000
MAGIC = b"CIX1"
_CAPTURE = "urlkey string, page_id long, url string, digest string, record_type string, refers_to long, file_no int, offset long, length long"


def url_key(url: str | None) -> str:
    """Reversed host, ')', path and query: http://www.b.com:80/x?q -> com,b)/x?q. Null gives ''."""
    if not url:
        return ""
    try:
        p = urlsplit(url.strip())
        host, port = (p.hostname or "").lower(), p.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    host = host.removeprefix("www.")
    end = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + end + ")" + (p.path or "/") + (f"?{p.query}" if p.query else "")


def _line(text: str) -> str:
    """A header value: control characters and white space percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in text)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed WARC/1.1 record: a response, or a revisit if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(warc["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = body.partition(b"\r\n\r\n")
    return warc, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, out: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write pages (page_id, url, html) as archives below `out`; returns the captures, one row a record.

    A null html is an empty payload, a null url gives a record without target and the key ''. Rows of
    one payload that share the greatest page_id are all responses; rows with a null page_id are
    responses unless a non-null one has their payload. Empty pages give no archives. Other columns are ignored.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    long_enough = F.octet_length("html") >= LEAST_BYTES
    greatest = base.where(long_enough).groupBy("digest").agg(F.max("page_id").alias("top"))
    known = base.withColumn("k", F.when(long_enough, F.col("digest"))).join(greatest.withColumnRenamed("digest", "k"), "k", "left")
    refers = F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    rows = known.select("page_id", "url", "html", "digest", refers.alias("refers_to")).sortWithinPartitions("page_id", "digest", "url")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next((f for f in frames if len(f)), None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        with atomic_writer(archive_path(out, number)) as stream:
            at = 0

            def captures(frame: pd.DataFrame) -> pd.DataFrame:
                nonlocal at
                made = []
                for page_id, url, html, digest, refers_to in zip(*(frame[c] for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                    page_id = None if pd.isna(page_id) else int(page_id)
                    refers_to = None if pd.isna(refers_to) else int(refers_to)
                    member = _gzip(record(page_id, url, html.encode("utf-8"), digest, refers_to, date))
                    stream.write(member)
                    made.append((url_key(url), page_id, url, digest, "response" if refers_to is None else "revisit", refers_to, number, at, len(member)))
                    at += len(member)
                return _frame(made)

            yield captures(first)
            for frame in frames:
                yield captures(frame)

    # bigint columns with nulls would become doubles in pandas: ids travel as strings
    text = rows.withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    return saved(text.mapInPandas(write, _CAPTURE), "captures")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in _CAPTURE.split(", ")])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_path(out: str, number: int) -> str:
    return f"{out}/archive-{number:05d}.warc.gz"


# --- two-level capture index ------------------------------------------------------------------


def write_index(captures: DataFrame, out: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted capture index below `out`; returns one row a shard: path, first and last key, lines.

    Captures without rows give no shards. Repeated captures are kept.
    """
    n = partitions(captures.sparkSession)
    ordered = captures.repartitionByRange(n, "urlkey", "page_id", "file_no", "offset").sortWithinPartitions("urlkey", "page_id", "file_no", "offset")
    fields = [c.split()[0] for c in _CAPTURE.split(", ")]

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next((f for f in frames if len(f)), None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        path = f"{out}/index-{number:05d}.cix"
        directory, at, lines, total, keys = [], len(MAGIC), [], 0, [None, None]

        def flush(stream) -> None:
            nonlocal at
            block = zlib.compress("\n".join(json.dumps(x, separators=(",", ":")) for x in lines).encode(), 6)
            directory.append([lines[0][0], at, len(block), len(lines)])
            stream.write(block)
            at += len(block)
            lines.clear()

        with atomic_writer(path) as stream:
            stream.write(MAGIC)

            def add(frame: pd.DataFrame) -> None:
                nonlocal total
                for row in frame[fields].itertuples(index=False, name=None):
                    line = [None if pd.isna(x) else x for x in row]
                    keys[0] = line[0] if keys[0] is None else keys[0]
                    keys[1] = line[0]
                    lines.append([line[0], *(None if x is None else int(x) if k in (0, 4, 5, 6, 7) else x for k, x in enumerate(line[1:]))])
                    total += 1
                    if len(lines) == block_lines:
                        flush(stream)

            add(first)
            for frame in frames:
                add(frame)
            if lines:
                flush(stream)
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            stream.write(packed + struct.pack("<QQ", at, len(packed)) + MAGIC)
        yield pd.DataFrame([(number, path, keys[0], keys[1], total)], columns=["shard", "path", "first", "last", "n"])

    text = ordered.select(*(F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in fields))
    return saved(text.mapInPandas(write, "shard int, path string, first string, last string, n long"), "index")


class IndexShard:
    """Binary search in one shard file: directory first, then one block at a time."""

    def __init__(self, path: str):
        self._file = RangeReader(path)
        at, length = struct.unpack("<QQ", self._file.read(self._file.size - 20, 16))
        if self._file.read(self._file.size - 4, 4) != MAGIC:
            raise ValueError(f"{path} isn't an index shard")
        self._directory = json.loads(zlib.decompress(self._file.read(at, length)))
        self._firsts = [d[0] for d in self._directory]
        self._block: tuple[int, list, list] = (-1, [], [])

    def _load(self, k: int) -> tuple[list, list]:
        if self._block[0] != k:
            _, at, length, _ = self._directory[k]
            lines = [json.loads(x) for x in zlib.decompress(self._file.read(at, length)).decode().split("\n")]
            self._block = (k, lines, [x[0] for x in lines])
        return self._block[1], self._block[2]

    def find(self, key: str) -> Iterator[list]:
        """All lines of a key; they may run over several blocks."""
        k = max(0, bisect.bisect_left(self._firsts, key) - 1)
        while k < len(self._directory) and self._firsts[k] <= key:
            lines, keys = self._load(k)
            yield from lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
            k += 1

    def close(self) -> None:
        self._file.close()


def lookup(index: DataFrame, urls: DataFrame) -> DataFrame:
    """The captures of the distinct keys of urls (url string), found in the index (rows of write_index).

    A null url looks up the key ''. Keys without captures give no rows, and so does an empty index.
    """
    spark = index.sparkSession
    shards = sorted((r["shard"], r["first"], r["last"], r["path"]) for r in index.collect())  # one small row a shard
    if not shards:
        return spark.createDataFrame([], _CAPTURE)
    firsts, lasts, paths = [s[1] for s in shards], [s[2] for s in shards], [s[3] for s in shards]

    @F.pandas_udf("struct<urlkey:string,shards:array<int>>")
    def place(urls: pd.Series) -> pd.DataFrame:
        keys = [url_key(u) for u in urls]
        return pd.DataFrame({"urlkey": keys, "shards": [list(range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k))) for k in keys]})

    keys = urls.select(place(F.col("url").cast("string")).alias("p")).select("p.urlkey", F.explode("p.shards").alias("n")).distinct()

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, number, found = None, -1, []
        for frame in frames:
            for n, key in zip(frame["n"], frame["urlkey"], strict=True):
                if n != number:
                    if shard is not None:
                        shard.close()
                    shard, number = IndexShard(paths[n]), n
                for line in shard.find(key):
                    found.append(tuple(line))
                    if len(found) == 5000:
                        yield _frame(found)
                        found = []
        if found:
            yield _frame(found)

    return keys.repartitionById(len(paths), "n").sortWithinPartitions("n", "urlkey").mapInPandas(find, _CAPTURE)


READ_BYTES = 4 << 20


def fetch(captures: DataFrame, out: str) -> DataFrame:
    """Read the records of captures from the archives below `out` and return what they say.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to; of a response, length and
    digest are those of the payload that was read, and a digest that differs from the header raises.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    n = partitions(captures.sparkSession)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, number = None, -1
        for frame in frames:
            places = list(zip(frame["file_no"], frame["offset"], frame["length"], strict=True))
            made, i = [], 0
            while i < len(places):
                j, (file_no, begin, length) = i + 1, places[i]
                end = begin + length
                while j < len(places) and places[j][0] == file_no and places[j][1] == end and end - begin < READ_BYTES:
                    end += places[j][2]
                    j += 1
                if file_no != number:
                    if reader is not None:
                        reader.close()
                    reader, number = RangeReader(archive_path(out, file_no)), file_no
                raw = reader.read(int(begin), int(end - begin))
                made += [_answer(zlib.decompress(raw[at - begin : at - begin + size], 31)) for _, at, size in places[i:j]]
                i = j
            yield pd.DataFrame(made, columns=[c.split()[0] for c in schema.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    return captures.select("file_no", "offset", "length").repartition(n, "file_no").sortWithinPartitions("file_no", "offset").mapInPandas(read, schema)


def _answer(raw: bytes) -> tuple:
    warc, http, payload = parse_record(raw)
    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    page, refers = warc.get("WARC-Page-ID"), warc.get("WARC-Refers-To-Page-ID")
    return (int(page) if page else None, warc.get("WARC-Target-URI"), size, digest, kind, int(refers) if refers else None)


def archive_and_read(pages: DataFrame, out: str | None = None) -> DataFrame:
    """Write pages and their index, then look up every page's URL and read its records back."""
    target = out or scratch(pages.sparkSession, "warc")
    index = write_index(write_archives(pages, target), f"{target}/index")
    return fetch(lookup(index, pages.select("url")), target)
