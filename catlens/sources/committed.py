"""Idempotent sink (A4): every attempt writes to a folder of its own, one manifest names the whole result.

``path/attempt-<id>/`` holds the Parquet files of one attempt, ``path/manifest.json`` names the
attempt that counts with its files, their sizes and the row count, which the files' own footers give. A reader
takes what the manifest names and nothing else, so a job that died half-way, a second writer and a
retry never mix their files. The manifest is written under a name of its own and renamed to its place; where one is
there already, the rename fails (or the manifest is looked up first) and the first commit stays.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from catlens.session import _hadoop, delete_path, path_exists

MANIFEST = "manifest.json"
ATTEMPT = "attempt-"


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and size of the data files of one attempt."""
    fs, p = _hadoop(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))}


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", "true").text(path).collect())


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the committed result (one small JSON file), or None."""
    at = f"{path}/{MANIFEST}"
    return json.loads(_read_text(spark, at)) if path_exists(spark, at) else None


def _commit(spark: SparkSession, path: str, manifest: dict) -> bool:
    """Put the manifest in its place; False if another one is there."""
    own = f"{path}/.{MANIFEST}.{uuid.uuid4().hex}"
    fs, src = _hadoop(spark, own)
    out = fs.create(src, False)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    _, dst = _hadoop(spark, f"{path}/{MANIFEST}")
    try:
        won = not fs.exists(dst) and fs.rename(src, dst)
    except Py4JJavaError:  # file systems that refuse to rename onto a file
        won = False
    if not won:
        fs.delete(src, False)
    return won


def write_committed(df: DataFrame, path: str, key: str) -> dict:
    """Write df once under ``path`` and give its manifest; ``key`` names the result (a job run, a date).

    A retry with the same key after a commit writes nothing and gives the first manifest; after a failed
    attempt it writes the whole result again and removes what the failed attempts left. Another key raises:
    the folder holds another result.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    done = read_manifest(spark, path)
    if done is None:
        attempt = ATTEMPT + uuid.uuid4().hex
        df.write.mode("error").parquet(f"{path}/{attempt}")
        files = _files(spark, f"{path}/{attempt}")
        schema = json.loads(df.schema.json())
        # from the footers, not observed by the write: accumulators count the tasks of a lost executor twice
        rows = spark.read.schema(df.schema).parquet(f"{path}/{attempt}").count() if files else 0
        if not _commit(spark, path, {"key": key, "attempt": attempt, "rows": rows, "files": files, "schema": schema}):
            delete_path(spark, f"{path}/{attempt}")
        done = read_manifest(spark, path)
    if done["key"] != key:
        raise ValueError(f"{path} holds the result of {done['key']!r}, not of {key!r}")
    _clean(spark, path, done["attempt"])
    return done


def _clean(spark: SparkSession, path: str, kept: str) -> None:
    """Remove what attempts without a commit left."""
    fs, p = _hadoop(spark, path)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith(ATTEMPT) and name != kept:
            delete_path(spark, f"{path}/{name}")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The committed result: the files of the manifest, after a check that they are there in full size."""
    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    done = read_manifest(spark, path)
    if done is None:
        raise FileNotFoundError(f"no committed result in {path}")
    folder = f"{path}/{done['attempt']}"
    have = _files(spark, folder)
    torn = [f for f, n in done["files"].items() if have.get(f) != n]
    if torn:
        raise OSError(f"{len(torn)} files of {folder} are missing or torn")
    schema = StructType.fromJson(done["schema"])
    if not done["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{f}" for f in sorted(done["files"])])
