import statistics

import pytest
from pyspark.sql import functions as F

from conftest import frame, history
from panelops.operators import features as feat

SHARE = "suppression_pct"


def _fac(spark, ids=("H-01",)):
    return spark.createDataFrame([(i, 100, "North") for i in ids],
                                 "facility_id string, baseline_patient_volume int, region string")


def _share(spark, values, site="H-01"):
    return frame(spark, history(site, SHARE, values))


def test_z_of_every_row_is_its_sample_score(spark):
    series = {"H-01": [61.0, 64.5, 70.25, 58.0, 66.0], "H-02": [90.0, 40.0]}
    df = frame(spark, [e for site, v in series.items() for e in history(site, SHARE, v)])
    got = {(r.facility_id, r.suppression_pct): r.z_suppression_pct
           for r in feat.anomaly_features(df).collect()}
    for site, values in series.items():
        mean, sd = statistics.mean(values), statistics.stdev(values)
        for v in values:
            assert got[site, v] == pytest.approx((v - mean) / sd, abs=1e-9)


def test_constant_and_short_series(spark):
    df = frame(spark, history("H-01", SHARE, [55.5] * 7) + history("H-02", SHARE, [12.0]))
    out = feat.anomaly_features(df)
    assert {r.z_suppression_pct for r in out.where("facility_id = 'H-01'").collect()} == {0.0}
    enough = feat.with_enough_history(out)
    assert {r.facility_id for r in enough.collect()} == {"H-01"}
    assert out.where("insufficient_history").select("facility_id").distinct().count() == 1


def test_rows_without_a_target_are_optional(spark):
    df = _share(spark, [30.0, 31.0, 35.0, 36.0, 40.0, 44.0, 47.0])
    known = feat.forecast_dataset(df, _fac(spark), require_target=True)
    every = feat.forecast_dataset(df, _fac(spark), require_target=False)
    open_rows = every.where(F.col(feat.TARGET_COL).isNull())
    assert open_rows.count() == 3 and every.count() == known.count() + 3
    assert {str(r.report_month) for r in open_rows.collect()} == {
        "2019-03-01", "2019-04-01", "2019-05-01"}


def test_lags_and_trailing_mean(spark):
    values = [11.0, 7.0, 13.0, 2.0, 29.0, 17.0]
    rows = feat.forecast_dataset(_share(spark, values), _fac(spark), require_target=False).orderBy(
        "report_month").collect()
    for r in rows:
        k = values.index(r.suppression_pct)
        assert [r.suppression_pct_lag_1, r.suppression_pct_lag_2, r.suppression_pct_lag_3] == [
            values[k - 1], values[k - 2], values[k - 3]]
        assert r.suppression_pct_roll3_mean == pytest.approx(statistics.mean(values[k - 3 : k]))


def test_row_based_and_calendar_lags_differ_on_a_gap(spark):
    df = frame(spark, history("H-01", SHARE, [10.0, 20.0, None, 40.0, 50.0, 60.0, 70.0],
                              start=(2024, 1)))
    rb = feat.forecast_features(df, _fac(spark)).where("report_month = date'2024-04-01'").first()
    cal = feat.forecast_features(df, _fac(spark), calendar=True).where(
        "report_month = date'2024-04-01'").first()
    assert rb.suppression_pct_lag_1 == 20.0  # skips the missing March
    assert cal.suppression_pct_lag_1 is None and cal.suppression_pct_lag_2 == 20.0


def test_time_split_cutoff_and_error(spark):
    df = _share(spark, [50.0 + k for k in range(12)])
    ds = feat.forecast_dataset(df, _fac(spark))
    train, test = feat.time_split(ds)
    months = sorted({r.report_month for r in ds.collect()})
    assert {r.report_month for r in test.collect()} == set(months[-4:])
    assert {r.report_month for r in train.collect()} == set(months[:-4])
    few = feat.forecast_dataset(_share(spark, [50.0 + k for k in range(8)]), _fac(spark))
    with pytest.raises(Exception, match="at least 4"):
        feat.time_split(few)[0].count()


def test_naive_mae(spark):
    df = _share(spark, [float(v) for v in range(10, 110, 10)])
    ds = feat.forecast_dataset(df, _fac(spark))
    _, test = feat.time_split(ds)
    assert feat.naive_mae(test).first()[0] == pytest.approx(30.0)
