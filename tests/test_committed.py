"""The idempotent sink (A4)."""

import json
import os
import threading

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JError
from pyspark.sql import functions as F

from catlens.sources import committed
from catlens.sources.committed import read_committed, read_manifest, write_committed


def attempts(path):
    return sorted(f for f in os.listdir(path) if f.startswith("attempt-"))


def test_first_write_and_retry_after_commit(spark, tmp_dir):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    first = write_committed(df, tmp_dir + "/r", "day 1")
    again = write_committed(df.limit(3), tmp_dir + "/r", "day 1")
    assert first == again and first["rows"] == 1000 and len(attempts(tmp_dir + "/r")) == 1
    assert sorted(read_committed(spark, tmp_dir + "/r").collect()) == sorted(df.collect())


def test_failed_attempts_leave_nothing_to_read(spark, tmp_dir, monkeypatch):
    path = tmp_dir + "/r"
    torn = spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit("a")))
    with pytest.raises((PySparkException, Py4JError)):
        write_committed(torn, path, "k")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, path)
    # a driver that dies between the write and the commit
    monkeypatch.setattr(committed, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        write_committed(spark.range(5), path, "k")
    monkeypatch.undo()
    assert read_manifest(spark, path) is None and attempts(path)
    done = write_committed(spark.range(20), path, "k")
    assert attempts(path) == [done["attempt"]] and read_committed(spark, path).count() == 20


def test_one_of_two_writers_wins(spark, tmp_dir):
    path, results = tmp_dir + "/r", []
    work = [threading.Thread(target=lambda n=n: results.append(write_committed(spark.range(n), path, "k"))) for n in (10, 20)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert len(results) == 2 and results[0]["attempt"] == results[1]["attempt"]
    assert read_committed(spark, path).count() == results[0]["rows"]


def test_other_key_torn_file_and_empty_result(spark, tmp_dir):
    path = tmp_dir + "/r"
    done = write_committed(spark.range(10), path, "k")
    with pytest.raises(ValueError):
        write_committed(spark.range(10), path, "other")
    name = next(iter(done["files"]))
    with open(f"{path}/{done['attempt']}/{name}", "ab") as f:
        f.write(b"x")
    with pytest.raises(OSError):
        read_committed(spark, path)
    empty = spark.range(0).withColumn("s", F.lit("a"))
    assert write_committed(empty, tmp_dir + "/e", "k")["rows"] == 0
    back = read_committed(spark, tmp_dir + "/e")
    assert back.columns == empty.columns and back.count() == 0
    with open(tmp_dir + "/e/manifest.json") as f:
        assert json.load(f)["key"] == "k"
