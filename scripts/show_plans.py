"""Print the formatted physical plans of the job's main stages.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catlens.config import FIXTURE_CONFIG as CFG  # noqa: E402
from catlens.operators import features, labels, metrics, models  # noqa: E402
from catlens.plans import job  # noqa: E402
from catlens.session import local_session  # noqa: E402
from catlens.sources.tickets import tickets_raw  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    df.explain("formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    raw = tickets_raw(spark, sf)
    cleaned = job.cleaning.clean(raw, CFG)
    show("1. scan + clean + code counts (top-k input)", labels.top_k_values(labels.code_frequency(cleaned, CFG.code_out), CFG.code_out, 8))
    prep = job.prepare(raw, CFG, materialize="cache")
    train, test = prep.split()
    show("2. training rows (narrow filter over the cache)", train)
    show("3. vocabulary counts (indexers + NB statistics)", features.vocabulary_counts(train, CFG))
    model = models.fit(train, CFG, "nb")
    ev = job.evaluate(model, test, CFG)
    show("4. confusion table (the one pass over test rows)", ev.confusion)
    show("5. metrics from the confusion table", ev.metrics)
    show("6. sample predictions (per-partition top-20)", ev.samples)
    strat = job.prepare(raw, CFG.with_(split="stratified"))
    from catlens.operators import splits

    show("7. stratified split: per-label boundary plan", splits.stratified_plan(strat.labelled, CFG.label_col, 0.2, 10))
    show("8. forest input: canonical layout", models.canonical_layout(train, CFG))


if __name__ == "__main__":
    main()
