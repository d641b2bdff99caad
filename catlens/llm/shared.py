"""Helpers of the llm operators: scratch tables, ordered buckets, exact top-k, Arrow text buffers."""

from __future__ import annotations

import bisect
import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.session import delete_path

LONG_MIN = -(2**63)
#: Shuffle files go when the query that wrote them has ended, not when the driver's garbage collector finds them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Set here only where it is unset and the master is one process (tests).
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to the shared folder and read again: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that `saved` gave, once all that reads them is written."""
    for t in tables:
        delete_path(t.sparkSession, t._scratch_path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context, however the driver found it.

    Also has shuffle files removed at the end of each query, unless the application says otherwise.
    """
    sc = spark.sparkContext
    if not sc.getConf().contains(CLEANUP):
        spark.conf.set(CLEANUP, "true")
    if getattr(sc, "_catlens_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="catlens-zip-")) / "catlens.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(path))
    sc._catlens_shipped = True


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_bounds(df: DataFrame, key: Column, n: int) -> list[float]:
    """At most n - 1 ascending bounds that cut the ids into ranges of about equal row counts."""
    if n < 2:
        return []
    probs = [i / n for i in range(1, n)]
    ids = df.select(key.cast("double").alias("k")).where("k is not null")
    return sorted(set(ids.approxQuantile("k", probs, min(0.001, 0.1 / n)) or []))


def bucket_of(key: Column, bounds: list[float]) -> Column:
    """The number of bounds at or below the id; rows with equal ids share a bucket, null ids take 0."""
    edges = np.asarray(bounds, dtype="float64")

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(dtype="float64"), side="right").astype("int32"))

    return bucket(F.coalesce(key, F.lit(LONG_MIN)))


def kth_largest(df: DataFrame, col: str, k: int) -> int:
    """The exact k-th largest value of a long column without nulls, by radix selection.

    Each round sends at most 2^16 counts of 16 bits of the value to the driver; no row is
    sorted or collected. k must lie between 1 and the row count.
    """
    u = F.col(col).bitwiseXOR(F.lit(LONG_MIN))  # unsigned order
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(u, shift).bitwiseAND(F.lit(0xFFFF)).alias("d")
        part = df if shift == 48 else df.where(F.shiftrightunsigned(u, shift + 16) == F.lit(prefix))
        counts = {r["d"]: r["n"] for r in part.groupBy(digit).agg(F.count(F.lit(1)).alias("n")).collect()}
        for d in sorted(counts, reverse=True):
            if left <= counts[d]:
                prefix = (prefix << 16) | d
                break
            left -= counts[d]
    value = prefix ^ (1 << 63)
    return value - (1 << 64) if value >= 1 << 63 else value


# --- memory of Python workers -----------------------------------------------------------------


#: What an operator keeps in a worker process from task to task; work of another kind that goes through `lean` lets go of it.
KEPT: dict[str, object] = {}


def give_back() -> None:
    """Return freed memory to the system: an idle worker lives on beside the tasks that follow and would hold the most it ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; what earlier work kept in this process, and what the work on each batch has freed, is given back."""
    KEPT.clear()
    for b in batches:
        yield b
        del b
        give_back()
    give_back()


# --- Arrow text buffers -----------------------------------------------------------------------


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, nulls as empty, and the len + 1 offsets into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most `limit` bytes; a longer text is a range of its own."""
    i, n, ends = 0, len(offsets) - 1, offsets.tolist()
    while i < n:
        j = max(i + 1, min(n, bisect.bisect_right(ends, ends[i] + limit) - 1))
        yield i, j
        i = j
