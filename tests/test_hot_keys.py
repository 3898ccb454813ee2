"""One entity (and one key) holding a third of the batch."""

import numpy as np
import pandas as pd

from conftest import sites
from panelops.operators import checks
from panelops.schemas import RAW_REPORT


def _skewed_batch(spark, n=6000):
    rng = np.random.default_rng(7)
    hot = n // 3
    ent = np.array(["HOT"] * hot + [f"E{k % 50:02d}" for k in range(n - hot)])
    months = pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 60, n) * 31, "D")
    months = months.to_period("M").to_timestamp().date
    # the hot entity also carries 500 copies of one key
    months[:500] = pd.Timestamp("2021-06-01").date()
    pdf = pd.DataFrame({
        "facility_id": ent,
        "report_month": months,
        "patients_tested": rng.integers(50, 150, n).astype("int32"),
        "suppression_pct": np.round(rng.uniform(60, 95, n), 4),
        "drug_stock_level": np.round(rng.uniform(20, 80, n), 4),
        "reporting_delay_days": rng.integers(0, 20, n).astype("int32"),
    })
    pdf.loc[n - 1, "patients_tested"] = 100000  # one spike outside the hot entity
    return spark.createDataFrame(pdf, RAW_REPORT).repartition(8)


def test_hot_entity_same_result_with_distributed_medians(spark):
    b = _skewed_batch(spark)
    r = sites(spark, ["HOT"] + [f"E{k:02d}" for k in range(50)])
    fast = sorted(checks.classify(b, r).collect())
    split = sorted(checks.classify(b, r, max_group_values=0).collect())
    assert fast == split
    reasons = pd.Series([x.quarantine_reason for x in fast]).value_counts(dropna=False)
    assert reasons["duplicate_facility_month"] >= 500
    assert reasons.get("statistical_outlier", 0) >= 1
