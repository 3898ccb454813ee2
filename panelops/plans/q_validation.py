"""Validation-slice queries: sources, checks, classification, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelops.operators import checks, inject, report
from panelops.plans.inputs import RAW_COLUMNS, Inputs
from panelops.plans.oracle import with_base
from panelops.plans.registry import query, r6
from panelops.schemas import ENTITY, OUTLIER_FIELDS, PERIOD


# --- sources -------------------------------------------------------------------
@query("s1_facilities", with_base("SELECT * FROM facilities"))
def s1_facilities(spark, sf_dir):
    return Inputs(spark, sf_dir).facilities


@query(
    "s4_panel_scan",
    with_base(
        "SELECT facility_id, report_month, patients_tested, suppression_pct, "
        "drug_stock_level, reporting_delay_days FROM panel"
    ),
)
def s4_panel_scan(spark, sf_dir):
    return Inputs(spark, sf_dir).panel.select(*RAW_COLUMNS)


@query("m1_raw_batch", with_base("SELECT * FROM raw"))
def m1_raw_batch(spark, sf_dir):
    return Inputs(spark, sf_dir).raw


@query("m2_ground_truth_ledger", with_base("SELECT * FROM ledger"))
def m2_ground_truth_ledger(spark, sf_dir):
    return Inputs(spark, sf_dir).ledger


@query(
    "a19_issue_counts",
    with_base("SELECT issue_type, COUNT(*) AS n FROM ledger GROUP BY issue_type"),
)
def a19_issue_counts(spark, sf_dir):
    return inject.issue_counts(Inputs(spark, sf_dir).ledger)


# --- checks --------------------------------------------------------------------
@query("b1_referential", with_base("SELECT " + ", ".join(RAW_COLUMNS) + ", is_known FROM flags"))
def b1_referential(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return checks.check_referential(i.raw, i.facilities)


@query(
    "b2_duplicates",
    with_base("SELECT " + ", ".join(RAW_COLUMNS) + ", is_duplicate FROM flags"),
)
def b2_duplicates(spark, sf_dir):
    return checks.check_duplicates(Inputs(spark, sf_dir).raw)


_RANGE_COLS = [
    "range_patients_tested",
    "range_suppression_pct",
    "range_drug_stock_level",
    "range_reporting_delay_days",
]


@query(
    "b3_ranges",
    with_base("SELECT " + ", ".join(RAW_COLUMNS + _RANGE_COLS) + " FROM flags"),
)
def b3_ranges(spark, sf_dir):
    return checks.check_ranges(Inputs(spark, sf_dir).raw)


@query(
    "b4_robust_outliers",
    with_base("SELECT " + ", ".join(RAW_COLUMNS) + ", is_outlier FROM flags"),
)
def b4_robust_outliers(spark, sf_dir):
    return checks.check_statistical_outliers(Inputs(spark, sf_dir).raw)


@query(
    "a3_a4_robust_stats",
    with_base(
        "SELECT facility_id, round(m_p, 6) AS med_patients_tested, "
        "round(d_p, 6) AS mad_patients_tested, round(m_s, 6) AS med_suppression_pct, "
        "round(d_s, 6) AS mad_suppression_pct, round(m_d, 6) AS med_drug_stock_level, "
        "round(d_d, 6) AS mad_drug_stock_level FROM mad"
    ),
)
def a3_a4_robust_stats(spark, sf_dir):
    w = checks.robust_stats_wide(Inputs(spark, sf_dir).raw)
    cols = [ENTITY]
    for f in OUTLIER_FIELDS:
        cols += [r6(f"med_{f}").alias(f"med_{f}"), r6(f"mad_{f}").alias(f"mad_{f}")]
    return w.select(*cols)


@query("b5_classify", with_base("SELECT * FROM classified"))
def b5_classify(spark, sf_dir):
    return Inputs(spark, sf_dir).classified


@query("b6_clean", with_base("SELECT * FROM clean"))
def b6_clean(spark, sf_dir):
    return Inputs(spark, sf_dir).clean


@query("b6_quarantine", with_base("SELECT * FROM quarantined"))
def b6_quarantine(spark, sf_dir):
    return Inputs(spark, sf_dir).quarantined


@query("j7_completeness_gaps", with_base("SELECT * FROM gaps"))
def j7_completeness_gaps(spark, sf_dir):
    return Inputs(spark, sf_dir).gaps


@query(
    "a5_key_counts",
    with_base(
        "SELECT facility_id, report_month, COUNT(*) AS n_rows FROM raw GROUP BY 1, 2"
    ),
)
def a5_key_counts(spark, sf_dir):
    return checks.key_counts(Inputs(spark, sf_dir).raw)


# --- report ----------------------------------------------------------------------
@query(
    "a7_reason_counts",
    with_base(
        "SELECT quarantine_reason, COUNT(*) AS n_rows FROM quarantined GROUP BY 1"
    ),
)
def a7_reason_counts(spark, sf_dir):
    return report.reason_counts(Inputs(spark, sf_dir).classified)


@query(
    "a8_a9_validation_report",
    with_base(
        """
SELECT b.batch_size, b.clean_count, b.quarantined_count,
       round(coalesce(b.quarantined_count / nullif(b.batch_size, 0), 0.0), 4) AS quarantine_rate,
       (SELECT COUNT(*) FROM gaps) AS completeness_gap_count,
       coalesce(b.quarantined_count / nullif(b.batch_size, 0), 0.0) > 0.10
         AS alert_quarantine_rate_exceeded,
       (SELECT string_agg(quarantine_reason || '=' || CAST(n AS VARCHAR), ';'
                          ORDER BY quarantine_reason)
        FROM (SELECT quarantine_reason, COUNT(*) AS n FROM quarantined GROUP BY 1))
         AS quarantine_reasons,
       (SELECT string_agg(facility_id || '@' || CAST(report_month AS VARCHAR), ';'
                          ORDER BY facility_id, report_month)
        FROM (SELECT * FROM gaps ORDER BY facility_id, report_month LIMIT 20))
         AS completeness_gaps_sample
FROM (SELECT COUNT(*) AS batch_size,
             COUNT(*) FILTER (WHERE quarantine_reason IS NULL) AS clean_count,
             COUNT(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS quarantined_count
      FROM classified) b"""
    ),
)
def a8_a9_validation_report(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    rep = report.validation_report(i.classified, i.gaps, "run-sql", "2024-01-01")
    reasons = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("quarantine_reasons")),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        ),
        ";",
    )
    sample = F.array_join(
        F.transform(
            "completeness_gaps_sample",
            lambda s: F.concat(s[ENTITY], F.lit("@"), s[PERIOD]),
        ),
        ";",
    )
    return rep.select(
        "batch_size",
        "clean_count",
        "quarantined_count",
        "quarantine_rate",
        "completeness_gap_count",
        "alert_quarantine_rate_exceeded",
        F.when(F.size("quarantine_reasons") > 0, reasons).alias("quarantine_reasons"),
        F.when(F.size("completeness_gaps_sample") > 0, sample).alias("completeness_gaps_sample"),
    )


@query(
    "k5_gap_sample",
    with_base("SELECT * FROM gaps ORDER BY facility_id, report_month LIMIT 20"),
)
def k5_gap_sample(spark, sf_dir):
    return report.gap_sample(Inputs(spark, sf_dir).gaps)


_B9_SQL = """
SELECT rule, violations FROM (
  SELECT
    COUNT(*) FILTER (WHERE r.facility_id IS NULL) AS not_null_facility_id,
    COUNT(*) FILTER (WHERE r.report_month IS NULL) AS not_null_report_month,
    COUNT(*) FILTER (WHERE r.patients_tested IS NULL) AS not_null_patients_tested,
    COUNT(*) FILTER (WHERE r.suppression_pct IS NULL) AS not_null_suppression_pct,
    COUNT(*) FILTER (WHERE r.drug_stock_level IS NULL) AS not_null_drug_stock_level,
    COUNT(*) FILTER (WHERE r.reporting_delay_days IS NULL) AS not_null_reporting_delay_days,
    COUNT(*) FILTER (WHERE d.facility_id IS NOT NULL) AS unique_key,
    COUNT(*) FILTER (WHERE f.facility_id IS NULL) AS foreign_key_facility,
    COUNT(*) FILTER (WHERE r.patients_tested < 0) AS check_patients_tested,
    COUNT(*) FILTER (WHERE r.suppression_pct < 0 OR r.suppression_pct > 100)
      AS check_suppression_pct,
    COUNT(*) FILTER (WHERE r.drug_stock_level < 0) AS check_drug_stock_level,
    COUNT(*) FILTER (WHERE r.reporting_delay_days < 0) AS check_reporting_delay_days
  FROM raw r
  LEFT JOIN dupkeys d ON r.facility_id = d.facility_id AND r.report_month = d.report_month
  LEFT JOIN (SELECT DISTINCT facility_id FROM facilities) f ON r.facility_id = f.facility_id
) UNPIVOT (violations FOR rule IN (
    not_null_facility_id, not_null_report_month, not_null_patients_tested,
    not_null_suppression_pct, not_null_drug_stock_level, not_null_reporting_delay_days,
    unique_key, foreign_key_facility, check_patients_tested, check_suppression_pct,
    check_drug_stock_level, check_reporting_delay_days))
"""


@query("b9_constraint_violations", with_base(_B9_SQL))
def b9_constraint_violations(spark, sf_dir):
    """B9 on the raw batch as if it were loaded into the fact table: what
    the table constraints would reject."""
    i = Inputs(spark, sf_dir)
    return checks.constraint_violations(i.raw, i.facilities)


@query("b9_clean_table_constraints", with_base(_B9_SQL.replace("FROM raw r", "FROM clean r")))
def b9_clean_table_constraints(spark, sf_dir):
    """B9 on the classified clean rows: every rule holds (all zeros)."""
    i = Inputs(spark, sf_dir)
    return checks.constraint_violations(i.clean, i.facilities)
