"""Command line: ``python -m catlens ...`` or ``spark-submit scripts/run_job.py ...``.

    python -m catlens INPUT [--format csv|parquet] [--model nb|rf|both]
                      [--out DIR] [--split hash|stratified|random] [--key COL]
                      [--materialize cache|checkpoint|none] [--classes N]
                      [--current-year Y] [--trees N] [--depth N] [--test-fraction F]

Reads a folder of ticket rows (CSV with a header by default), runs the job
and prints a preview, the kept codes, the summary, sample predictions, the confusion table, the per-class report and (for
the forest) the top feature importances; with ``--out`` every report table
is also written as Parquet under that folder.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from catlens.config import CURRENT_YEAR, MAX_DEPTH, NUM_TREES, TEST_FRACTION, TOP_N_CLASSES, JobConfig
from catlens.plans import job
from catlens.sources.csv_dir import read_csv_dir, write_parquet


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="catlens")
    p.add_argument("input", help="folder, glob or URI of the input rows")
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--model", choices=["nb", "rf", "both"], default="nb")
    p.add_argument("--out", default=None, help="folder for the report tables (Parquet)")
    p.add_argument("--split", choices=["hash", "stratified", "random"], default="hash")
    p.add_argument("--key", default=None, help="unique row key column for the split")
    p.add_argument("--materialize", choices=["cache", "checkpoint", "none"], default="cache")
    p.add_argument("--model-out", default=None, help="folder to save the fitted model(s) in")
    p.add_argument("--classes", type=int, default=TOP_N_CLASSES, help="classes kept besides OTHER")
    p.add_argument("--current-year", type=int, default=CURRENT_YEAR)
    p.add_argument("--trees", type=int, default=NUM_TREES, help="trees of the forest")
    p.add_argument("--depth", type=int, default=MAX_DEPTH, help="greatest depth of a tree")
    p.add_argument("--test-fraction", type=float, default=TEST_FRACTION)
    p.add_argument("--layout-partitions", type=int, default=JobConfig.layout_partitions,
                   help="fixed partition count of the forest's canonical layout (keep it between runs)")
    p.add_argument("--no-canonical-layout", action="store_true",
                   help="skip the forest's layout shuffle (trees then depend on the input layout)")
    a = p.parse_args(argv)

    started = time.time()
    spark = SparkSession.builder.appName("catlens").getOrCreate()
    df = read_csv_dir(spark, a.input) if a.format == "csv" else spark.read.parquet(a.input)
    cfg = JobConfig(
        split=a.split,
        key_col=a.key,
        materialize=a.materialize,
        top_n_classes=a.classes,
        current_year=a.current_year,
        num_trees=a.trees,
        max_depth=a.depth,
        test_fraction=a.test_fraction,
        layout_partitions=a.layout_partitions,
        canonical_layout=not a.no_canonical_layout,
    )
    prepared = job.prepare(df, cfg, materialize=cfg.materialize)
    for kind in ["nb", "rf"] if a.model == "both" else [a.model]:
        res = job.run(spark, df, cfg, kind, prepared=prepared, started=started)
        for name in ("preview", "top_codes"):
            res.tables[name].show(truncate=False)
        res.tables["summary"].show(truncate=False, vertical=True)
        for name in ("samples", "confusion", "per_class", "importances"):
            if name in res.tables:
                res.tables[name].show(100, truncate=False)
        if a.out:
            for name, t in res.tables.items():
                write_parquet(t, f"{a.out.rstrip('/')}/{kind}/{name}")
        if a.model_out:
            job.save_model(res.model, f"{a.model_out.rstrip('/')}/{kind}", res.prepared.labeller.top_codes, spark)
        res.release()
    prepared.release()
    return 0


if __name__ == "__main__":
    sys.exit(main())
