import datetime as dt

import pytest

from panelops.operators.evaluate import evaluate_against_ground_truth, forecast_metrics


def test_confusion_matrix(spark):
    d = dt.date
    ledger = spark.createDataFrame(
        [("A", d(2024, 1, 1), True), ("A", d(2024, 2, 1), False), ("B", d(2024, 1, 1), False),
         ("B", d(2024, 2, 1), True), ("C", d(2024, 1, 1), True)],
        "facility_id string, report_month date, is_anomaly_candidate boolean")
    scored = spark.createDataFrame(
        [("A", d(2024, 1, 1), True), ("A", d(2024, 2, 1), False), ("B", d(2024, 1, 1), True),
         ("B", d(2024, 2, 1), False)],
        "facility_id string, report_month date, is_anomaly boolean")
    m = evaluate_against_ground_truth(scored, ledger).first()
    assert m.total_candidates_injected == 3
    assert m.candidates_removed_upstream_by_validation == 1
    assert m.candidates_present_in_monthly_reports == 2
    assert (m.true_positives, m.false_positives, m.false_negatives, m.true_negatives) == (1, 1, 1, 1)
    assert m.precision == pytest.approx(0.5) and m.recall == pytest.approx(0.5)
    assert m.false_positive_rate == pytest.approx(0.5)


def test_zero_denominators_give_zero(spark):
    d = dt.date
    ledger = spark.createDataFrame([("A", d(2024, 1, 1), False)],
                                   "facility_id string, report_month date, is_anomaly_candidate boolean")
    scored = spark.createDataFrame([("A", d(2024, 1, 1), False)],
                                   "facility_id string, report_month date, is_anomaly boolean")
    m = evaluate_against_ground_truth(scored, ledger).first()
    assert (m.precision, m.recall, m.false_positive_rate) == (0.0, 0.0, 0.0)


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0, 14.0), (20.0, 19.0, 20.0)], "y double, p double, n double")
    m = forecast_metrics(df, "y", "p", "n").first()
    assert m.mae_model == 1.5 and m.mae_naive_baseline == 2.0
    assert m.improvement_over_baseline_pct == 25.0
