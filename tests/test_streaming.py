"""The streaming adapter scores files exactly as the batch job does."""

import os

from pyspark.sql import functions as F

from catlens.config import FIXTURE_CONFIG as CFG
from catlens.plans import job
from catlens.session import scratch_path
from catlens.sources.csv_dir import write_csv_dir
from catlens.sources.tickets import TICKET_FIXTURE_COLUMNS, tickets_raw
from catlens.streaming import read_csv_dir_stream, score_stream

from conftest import SF001


def test_stream_scoring_equals_batch(spark, tmp_dir):
    raw = tickets_raw(spark, SF001)
    res = job.run(spark, raw, CFG, "nb")
    folder = write_csv_dir(raw.repartition(3), os.path.join(tmp_dir, "in"))
    stream = read_csv_dir_stream(spark, folder, list(TICKET_FIXTURE_COLUMNS), max_files_per_trigger=1)
    scored = score_stream(stream, res.model, res.prepared.labeller.top_codes, CFG)
    q = (
        scored.writeStream.format("memory").queryName("scored_tickets").outputMode("append")
        .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start()
    )
    q.processAllAvailable()
    q.stop()
    got = spark.table("scored_tickets")
    batch = job.evaluate(res.model, res.prepared.labelled, CFG).predictions
    a = sorted((int(r[0]), r[1], r[2]) for r in got.select("row_id", CFG.label_col, "predicted_label").collect())
    b = sorted((r[0], r[1], r[2]) for r in batch.select("row_id", CFG.label_col, "predicted_label").collect())
    assert a == b and len(a) > 1000
    res.release()


def test_stream_parquet_sink_resumes_without_duplicates(spark, tmp_dir):
    """Parquet sink with a checkpoint in the shared folder: a second run on
    the same checkpoint after more files arrive adds only the new rows."""
    from catlens.streaming import write_scored_stream

    raw = tickets_raw(spark, SF001)
    res = job.run(spark, raw, CFG, "nb")
    inbox = os.path.join(tmp_dir, "inbox")
    out = os.path.join(tmp_dir, "scored")
    ckpt = scratch_path(spark, "sink-ckpt")
    first, second = raw.filter(F.col("row_id") % 2 == 0), raw.filter(F.col("row_id") % 2 == 1)
    write_csv_dir(first.repartition(2), os.path.join(inbox, "a"))

    def run_once():
        stream = read_csv_dir_stream(spark, os.path.join(inbox, "*"), list(TICKET_FIXTURE_COLUMNS))
        q = write_scored_stream(score_stream(stream, res.model, res.prepared.labeller.top_codes, CFG), out, ckpt, True)
        q.awaitTermination()

    run_once()
    n1 = spark.read.parquet(out).count()
    run_once()  # nothing new: no rows added
    assert spark.read.parquet(out).count() == n1
    write_csv_dir(second.repartition(2), os.path.join(inbox, "b"))
    run_once()
    got = spark.read.parquet(out)
    usable = res.prepared.labelled.count()
    assert got.count() == usable and got.select("row_id").distinct().count() == usable
    assert 0 < n1 < usable
    res.release()


def test_stream_refuses_swapped_columns(spark, tmp_dir):
    import pytest

    for name, text in (("a.csv", "id,Code\n1,2\n"), ("b.csv", "Code,id\n6,2\n")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    stream = read_csv_dir_stream(spark, tmp_dir, ["id", "Code"])
    q = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "swapped")).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        q.awaitTermination()
