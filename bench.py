"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced end to end with the ``noop`` sink (every row computed,
nothing collected), timed separately, and the total is reported. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelops.plans.catalog import QUERIES  # noqa: E402
from panelops.plans.q_models import fitted  # noqa: E402
from panelops.session import get_spark  # noqa: E402

WARM_UP = "d2_literal_forest"
HEADLINE = [
    "s4_panel_scan",  # lineitem -> panel aggregate
    "b5_classify",  # B1-B5 on the injected raw batch
    "j7_completeness_gaps",
    "a8_a9_validation_report",
    "w1_zscores",
    "b8_forecast_dataset",
    "s12_s13_validate_merge",  # retract + upsert merge
    "x3_live_forecast_mae",
    "fit_iforest",  # the two fits, timed apart from what uses the models
    "fit_gbt",
    "d1_iforest_nodes",  # read back from where the fit wrote it
    "d13_score_all",
    "d10_shap_values",
    "p7_month_board",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # Start-up of the JVM, the code generator and the Python workers is not timed.
    QUERIES[WARM_UP](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    models = fitted(spark, sf_dir)
    fits = {"fit_iforest": lambda: models.forest_path, "fit_gbt": lambda: models.nodes}
    _ = models.train_a, models.split  # their input tables, as the jobs find them written
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        if name in fits:
            fits[name]()
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
