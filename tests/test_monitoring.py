import datetime as dt

import pytest

from panelops.operators.monitoring import (
    anomaly_rate_drift,
    live_forecast_mae,
    quarantine_change_points,
    quarantine_rate_trend,
    sequential_drift,
)


def test_quarantine_trend_spike_and_shift(spark):
    rates = [0.02, 0.02, 0.02, 0.10, 0.02, 0.05, 0.05, 0.05]
    df = spark.createDataFrame(
        [(f"r{k}", dt.date(2024, k + 1, 1), r) for k, r in enumerate(rates)],
        "run_id string, dag_logical_date date, quarantine_rate double")
    t = {r.run_id: r.trend for r in quarantine_rate_trend(df).collect()}
    assert t["r0"] == "stable" and t["r3"] == "spike"
    assert t["r7"] == "shift"  # three runs in a row above the earlier mean


def test_anomaly_rate_drift(spark):
    rows = [(dt.date(2024, 1, 1), k < 5) for k in range(100)] + \
           [(dt.date(2024, 2, 1), k < 20) for k in range(100)]
    df = spark.createDataFrame(rows, "report_month date, is_anomaly boolean")
    d = {r.report_month.month: r for r in anomaly_rate_drift(df).collect()}
    assert d[1].flagged_rate == 0.05 and d[1].drift is False
    assert d[2].flagged_rate == 0.2 and d[2].drift is True


def test_live_mae_calendar_join_and_exact_rounding(spark):
    d = dt.date
    fc = spark.createDataFrame(
        [("A", d(2024, 1, 1), 10.0), ("B", d(2024, 1, 1), 20.0), ("A", d(2024, 2, 1), 1.0)],
        "facility_id string, report_month date, f double")
    act = spark.createDataFrame(
        [("A", d(2024, 4, 1), 10.0001), ("B", d(2024, 4, 1), 20.0), ("A", d(2024, 3, 1), 5.0)],
        "facility_id string, report_month date, a double")
    rows = {r.origin_month: r for r in live_forecast_mae(fc, act, "f", "a").collect()}
    assert set(rows) == {d(2024, 1, 1)}  # Feb's actual (May) has not arrived
    assert rows[d(2024, 1, 1)].n_matched == 2
    exact = live_forecast_mae(fc, act.withColumn("a", act.a), "f", "a", input_decimals=4).first()
    # errors 0.0001 and 0 (4 dp inputs) -> mean exactly 0.00005, kept at 6 dp
    assert exact.live_mae == pytest.approx(0.00005)


def change_points(spark, rates, **options):
    df = spark.createDataFrame(
        [(f"r{k:02d}", dt.date(2020 + k // 12, k % 12 + 1, 1), r) for k, r in enumerate(rates)],
        "run_id string, dag_logical_date date, quarantine_rate double")
    rows = quarantine_change_points(df.repartition(3), **options).collect()
    return [r.trend for r in sorted(rows, key=lambda r: r.run_id)]


def test_spike_and_shift_are_told_apart(spark):
    base = [0.04, 0.05, 0.06, 0.05, 0.04, 0.06]
    spike = change_points(spark, base + [0.05, 0.40, 0.05, 0.05, 0.04, 0.05])
    assert spike[:6] == ["baseline"] * 6 and spike[6:] == [
        "stable", "spike", "stable", "stable", "stable", "stable"]
    shift = change_points(spark, base + [0.05, 0.075, 0.08, 0.09, 0.08, 0.09, 0.08])
    assert "spike" not in shift[:8] and shift[-2:] == ["shift", "shift"] and "shift" not in shift[:9]
    assert change_points(spark, base + [0.06] * 20)[6:] == ["stable"] * 20  # inside the slack
    assert change_points(spark, [0.05, None, 0.05])[-1] == "baseline"
    assert change_points(spark, []) == []


def test_sequential_drift_knows_the_size_of_runs(spark):
    months = [(dt.date(2020 + k // 12, k % 12 + 1, 1)) for k in range(24)]

    def drift(counts):
        rows = [(m, f < n) for m, (n_all, n) in zip(months, counts) for f in range(n_all)]
        df = spark.createDataFrame(rows, "report_month date, is_anomaly boolean")
        out = sequential_drift(df).collect()
        return [r.drift for r in sorted(out, key=lambda r: r.report_month)]

    assert set(drift([(4, 1)] * 5)) == {"none"}  # 25 %, but of four rows
    assert set(drift([(400, 20)] * 12)) == {"none"}
    steady = drift([(400, 20)] * 3 + [(400, 32)] * 12)  # 8 % instead of 5 %
    assert steady[:4] == ["none"] * 4 and steady[-1] == "up"
    assert drift([(400, 2)] * 12)[-1] == "down"
