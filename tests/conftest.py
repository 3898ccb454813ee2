from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelops.schemas import RAW_REPORT  # noqa: E402
from panelops.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# An unremarkable report; a test names only the measures it is about.
PLAIN = {
    "patients_tested": 240,
    "suppression_pct": 71.5,
    "drug_stock_level": 33.0,
    "reporting_delay_days": 2,
}


@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s


def entry(site="H-01", month="2019-03-01", **measures):
    """One report in the column order of the raw schema."""
    assert set(measures) <= set(PLAIN), measures
    return (site, dt.date.fromisoformat(month), *{**PLAIN, **measures}.values())


def history(site, measure, values, start=(2018, 11)):
    """Consecutive reports of one site, one per value; None skips the month."""
    months = [divmod(start[0] * 12 + start[1] - 1 + k, 12) for k in range(len(values))]
    return [
        entry(site, dt.date(y, m + 1, 1).isoformat(), **{measure: v})
        for (y, m), v in zip(months, values, strict=True)
        if v is not None
    ]


def frame(spark, reports):
    return spark.createDataFrame(reports, RAW_REPORT)


def sites(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "facility_id string")
