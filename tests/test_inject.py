
from conftest import SF_SMALL
from panelops.operators import checks, inject
from panelops.sources import panel as src


def _panel(spark):
    return src.load_panel(spark, SF_SMALL)


def test_same_input_same_output_any_partitioning(spark):
    p = _panel(spark)
    raw1, led1 = inject.inject_issues(p)
    raw2, led2 = inject.inject_issues(p.repartition(7))
    assert sorted(raw1.collect()) == sorted(raw2.collect())
    assert sorted(led1.collect()) == sorted(led2.collect())


def test_ledger_keys_come_from_the_panel(spark):
    p = _panel(spark)
    _, led = inject.inject_issues(p)
    assert led.join(p, ["facility_id", "report_month"], "left_anti").count() == 0
    counts = {r.issue_type: r.n for r in inject.issue_counts(led).collect()}
    assert counts["duplicate_facility_id"] % 2 == 0


def test_fixture_counts_sf0001(spark):
    raw, _ = inject.inject_issues(_panel(spark))
    fac = src.load_facilities(spark, SF_SMALL)
    got = {r[0]: r[1] for r in checks.classify(raw, fac).groupBy("quarantine_reason").count().collect()}
    assert got == {None: 768, "duplicate_facility_month": 36, "range_patients_tested": 5,
                   "range_suppression_pct": 3, "statistical_outlier": 7}
    assert checks.completeness_gaps(raw, fac).count() == 29
    assert raw.count() == 819


def test_classification_is_partition_independent(spark):
    p = _panel(spark)
    raw, _ = inject.inject_issues(p)
    fac = src.load_facilities(spark, SF_SMALL)
    one = checks.classify(raw.coalesce(1), fac.coalesce(1)).collect()
    many = checks.classify(raw.repartition(8), fac.repartition(3)).collect()
    assert sorted(one) == sorted(many)
