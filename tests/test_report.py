from conftest import entry, frame, sites
from panelops.operators import checks, report


def _report(spark, n_rows, n_bad):
    rows = [entry(month=f"2024-{k + 1:02d}-01") for k in range(n_rows - n_bad)]
    rows += [entry(month=f"2023-{k + 1:02d}-01", suppression_pct=-1.0) for k in range(n_bad)]
    b = frame(spark, rows)
    r = sites(spark, ["H-01"])
    c = checks.classify(b, r)
    return report.validation_report(c, checks.completeness_gaps(b, r), "run", "2024-12-31")


def test_rate_exactly_at_limit_does_not_alert(spark):
    df = _report(spark, 10, 1)
    rep = df.first()
    assert rep.quarantine_rate == 0.1 and rep.alert_quarantine_rate_exceeded is False
    assert report.quality_alerts(df).count() == 0


def test_rate_above_limit_alerts(spark):
    df = _report(spark, 10, 2)
    assert report.quality_alerts(df).count() == 1
    rep = df.first()
    assert rep.alert_quarantine_rate_exceeded is True
    assert rep.quarantine_reasons == {"range_suppression_pct": 2}
    assert rep.batch_size == 10 and rep.clean_count == 8 and rep.quarantined_count == 2


def test_gap_sample_is_first_20_by_key(spark):
    rows = [entry("H-01", f"2024-{k + 1:02d}-01") for k in range(12)]
    rows += [entry("H-02", "2024-01-01")]
    b = frame(spark, rows)
    r = sites(spark, ["H-01", "H-02", "H-03"])
    c = checks.classify(b, r)
    rep = report.validation_report(c, checks.completeness_gaps(b, r), "run", "2024-12-31").first()
    assert rep.completeness_gap_count == 11 + 12
    sample = [(g.facility_id, g.report_month) for g in rep.completeness_gaps_sample]
    assert len(sample) == 20 and sample == sorted(sample) and sample[0] == ("H-02", "2024-02-01")
