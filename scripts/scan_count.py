"""Source scans per job run, read from Spark's event log (no UI needed).

Usage: python scripts/scan_count.py [SF_DIR] [EVENT_LOG_DIR]

Runs the NB and the forest job and every registered query of the catalogue under its own job group, then
counts the completed stages that read as many records as a source table holds, i.e. its scans.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catlens.config import FIXTURE_CONFIG as CFG  # noqa: E402
from catlens.plans import job  # noqa: E402
from catlens.plans.queries import QUERIES  # noqa: E402
from catlens.session import local_session  # noqa: E402
from catlens.sources.tickets import read_table, tickets_raw  # noqa: E402

SOURCES = ("orders", "customer", "nation")


def _lines(path: str):
    fh = open(path, "rb")
    if path.endswith(".zstd"):
        import zstandard

        fh = zstandard.ZstdDecompressor().stream_reader(fh)
    return io.TextIOWrapper(fh, encoding="utf-8")


def input_stages(log_dir: str) -> list[tuple[str, int, str, int]]:
    """(job group, stage id, stage name, input records) of stages that read input."""
    files = sorted(glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*"))) or sorted(
        f for f in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(f)
    )
    group: dict[int, str] = {}
    out = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    group.setdefault(s, g)
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                rec = sum(
                    int(a.get("Value", 0))
                    for a in si.get("Accumulables", [])
                    if a.get("Name") == "internal.metrics.input.recordsRead"
                )
                if rec:
                    out.append((group.get(si["Stage ID"]), si["Stage ID"], si["Stage Name"][:50], rec))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="catlens-events-")
    spark = local_session(8, shuffle_partitions=16, app="catlens-scans", event_log_dir=log_dir)
    sc = spark.sparkContext
    sizes = {t: read_table(spark, sf_dir, t).count() for t in SOURCES}
    for kind in ("nb", "rf"):
        sc.setJobGroup(kind, kind)
        res = job.run(spark, tickets_raw(spark, sf_dir), CFG, kind)
        res.tables["per_class"].collect()
        res.tables["samples"].collect()
        res.release()
    for name, query in QUERIES.items():
        sc.setJobGroup(name, name)
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    stages = input_stages(log_dir)
    for kind in ("nb", "rf", *QUERIES):
        counts = {t: sum(1 for g, _, _, r in stages if g == kind and r == n) for t, n in sizes.items()}
        print(json.dumps({"run": kind, "source_scans": counts}))


if __name__ == "__main__":
    main()
