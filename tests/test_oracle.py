"""Every registered query against its DuckDB oracle (the driver's gate), plus
the rows-only queries and the entry smoke check."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from catlens.plans.oracle import ORACLE_SQL  # noqa: E402
from catlens.plans.queries import QUERIES  # noqa: E402
from check_oracle import compare  # noqa: E402

from conftest import SF001, SF01  # noqa: E402


NO_SQL = {"rf_metrics", "rf_per_class", "rf_confusion", "rf_importances_top10", "rf_predictions", "rf_samples", "run_summary_rf"}


def test_every_query_has_oracle_or_is_forest():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(q) and set(ORACLE_SQL) <= set(o) <= set(q)
    assert set(QUERIES) - set(ORACLE_SQL) == NO_SQL


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_queries_match_oracle(spark, sf):
    # the forest's fits once, on the smaller scale
    rep = compare(spark, sf, [n for n in QUERIES if sf == SF001 or not (n.startswith("rf_") or n.endswith("_rf"))])
    bad = {k: v for k, v in rep.items() if v.get("ok") is False}
    assert not bad, bad
    assert all(v["rows"] > 0 for v in rep.values())


def test_queries_give_back_what_they_cache(spark):
    from catlens.plans import queries

    def persisted():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before = persisted()  # of other tests
    QUERIES["nb_metrics"](spark, SF001).collect()
    path = QUERIES["csv_roundtrip"](spark, SF001).inputFiles()[0].rpartition("/")[0]
    QUERIES["usable_rows"](spark, SF001).collect()
    assert not queries._HELD
    assert not persisted() - before
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/", 1))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["target_label", "class_accuracy", "n_test_examples"]
    assert len(rows) > 0
