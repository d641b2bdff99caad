"""CSV folder source (A1, A2), preview (A3), sinks (A4) and the fixture view."""

import os

import pytest
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.operators.cleaning import preview
from catlens.plans import job
from catlens.sources.csv_dir import read_csv_dir, write_csv_dir, write_parquet
from catlens.sources.tickets import tickets_raw

from conftest import SF001, SF01


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_csv_nulls_and_short_rows(spark, tmp_dir):
    d = os.path.join(tmp_dir, "a")
    _write(d, "part1.csv", 'id,Code,Time,State\n1,,0930A,NY\n2,"",1200P,  \n3,  ,x\n4,7\n')
    df = read_csv_dir(spark, d)
    assert df.columns == ["id", "Code", "Time", "State"]
    assert all(t == "string" for _, t in df.dtypes)
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"]["Code"] is None  # empty field
    assert rows["2"]["Code"] is None  # quoted empty field
    assert rows["3"]["Code"] == "  "  # blanks are kept
    assert rows["4"]["Time"] is None and rows["4"]["State"] is None  # short row


def test_csv_swapped_headers_raise(spark, tmp_dir):
    d = os.path.join(tmp_dir, "b")
    _write(d, "f1.csv", "id,Code\n1,5\n")
    _write(d, "f2.csv", "Code,id\n6,2\n")
    with pytest.raises(Exception):
        read_csv_dir(spark, d).collect()


def test_preview_is_ordered(spark):
    p = preview(tickets_raw(spark, SF001), 5, order_by="row_id").collect()
    assert [r["row_id"] for r in p] == sorted(r["row_id"] for r in p)
    first = tickets_raw(spark, SF001).agg(F.min("row_id")).first()[0]
    assert p[0]["row_id"] == first


def test_fixture_counts(spark):
    assert tickets_raw(spark, SF01).count() == 15000


TICKET_NAMES = {
    "row_id": "Summons Number",
    "code_raw": "Violation Code",
    "time_raw": "Violation Time",
    "year_raw": "Vehicle Year",
    "segment": "Vehicle Body Type",
    "zone": "Vehicle Make",
    "color": "Vehicle Color",
    "status": "Plate Type",
    "priority": "Violation County",
    "nation": "Registration State",
}


def test_csv_job_equals_parquet_job(spark, tmp_dir):
    """The ticket-shaped CSV folder (names with spaces) gives the same model
    quality as the parquet fixture: the columns, split and labels agree."""
    from catlens.config import FIXTURE_CONFIG

    raw = tickets_raw(spark, SF01)
    ren = raw.select(*[F.col(a).alias(b) for a, b in TICKET_NAMES.items()])
    path = write_csv_dir(ren.repartition(3), os.path.join(tmp_dir, "tickets"))
    cfg_csv = JobConfig(
        categorical_cols=tuple(TICKET_NAMES[c] for c in FIXTURE_CONFIG.categorical_cols),
        key_col="Summons Number",
        sample_cols=("Vehicle Body Type", "Vehicle Make", "Plate Type", "Violation County"),
    )
    a = job.run_csv(spark, path, cfg_csv, "nb")
    b = job.run(spark, raw, FIXTURE_CONFIG, "nb")
    for k in ("rows_used", "majority_baseline", "accuracy", "f1", "weighted_precision", "weighted_recall"):
        assert a.summary[k] == pytest.approx(b.summary[k], abs=1e-12), k
    assert a.tables["samples"].count() == 20
    a.release()
    b.release()


def test_parquet_sink_roundtrip(spark, tmp_dir):
    df = tickets_raw(spark, SF001).groupBy("status").count()
    out = write_parquet(df, os.path.join(tmp_dir, "out"))
    back = spark.read.parquet(out)
    assert sorted(back.collect()) == sorted(df.collect())
