"""Independent SQL (DuckDB dialect) for the parity check.

Written directly against the driver's tables, not generated from the Spark
plans: medians are plain ``median`` over raw rows, duplicates a HAVING
clause, gaps a cross product of roster and months, and so on. Every float
output is rounded to 6 dp in both engines.
"""

from __future__ import annotations

BASE_CTES = {
    "sm": """
  SELECT l_suppkey AS suppkey,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month,
         SUM(l_quantity) AS qty,
         COUNT(*) AS n_lines,
         COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS n_kept,
         SUM(CAST(round(l_discount * 100) AS INTEGER)) AS disc_pct_sum,
         MAX(CAST(l_shipdate AS DATE)) AS last_ship,
         MIN(CAST(l_shipdate AS DATE)) AS first_ship
  FROM lineitem GROUP BY 1, 2""",
    "panel": """
  SELECT suppkey, 'S-' || CAST(suppkey AS VARCHAR) AS facility_id, report_month,
         CAST(qty AS BIGINT) AS patients_tested,
         round(CAST(100 AS DOUBLE) * n_kept / n_lines, 4) AS suppression_pct,
         round(CAST(100 AS DOUBLE) - CAST(10 AS DOUBLE) * disc_pct_sum / n_lines, 4)
           AS drug_stock_level,
         CAST(date_diff('day', last_ship, last_day(report_month)) AS INTEGER)
           AS reporting_delay_days
  FROM sm""",
    "facilities": """
  SELECT 'S-' || CAST(s.s_suppkey AS VARCHAR) AS facility_id,
         s.s_name AS facility_name, r.r_name AS region, n.n_name AS ownership_type,
         CAST(floor(abs(s.s_acctbal)) AS INTEGER) AS baseline_patient_volume,
         o.opened_date
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT suppkey, MIN(first_ship) AS opened_date FROM sm GROUP BY suppkey) o
    ON o.suppkey = s.s_suppkey
  WHERE s.s_acctbal >= 0""",
    "tagged": """
  SELECT *, CAST((suppkey * 7919
                 + CAST(year(report_month) * 12 + month(report_month) AS BIGINT) * 104729)
                 % 1000 AS INTEGER) AS b
  FROM panel""",
    "raw": """
  SELECT facility_id, report_month,
         CAST(CASE WHEN b BETWEEN 50 AND 59 THEN patients_tested * 8
                   WHEN b BETWEEN 90 AND 94 THEN -patients_tested
                   ELSE patients_tested END AS BIGINT) AS patients_tested,
         CAST(CASE WHEN b BETWEEN 60 AND 64 THEN 1.5
                   WHEN b BETWEEN 95 AND 97 THEN 150
                   ELSE suppression_pct END AS DOUBLE) AS suppression_pct,
         CAST(CASE WHEN b BETWEEN 65 AND 69 THEN 0 ELSE drug_stock_level END AS DOUBLE)
           AS drug_stock_level,
         CAST(CASE WHEN b BETWEEN 70 AND 89 THEN 45 + b - 70 ELSE reporting_delay_days END
              AS INTEGER) AS reporting_delay_days
  FROM tagged WHERE b NOT BETWEEN 0 AND 29
  UNION ALL
  SELECT facility_id, report_month, CAST(patients_tested + 10 AS BIGINT),
         suppression_pct, drug_stock_level, reporting_delay_days
  FROM tagged WHERE b BETWEEN 30 AND 49""",
    "ledger": """
  SELECT facility_id, report_month,
         CASE WHEN b <= 29 THEN 'missing_month' WHEN b <= 49 THEN 'duplicate_facility_id'
              WHEN b <= 69 THEN 'outlier_spike' WHEN b <= 89 THEN 'severe_delay'
              ELSE 'range_violation' END AS issue_type,
         (b BETWEEN 50 AND 89) AS is_anomaly_candidate,
         CASE WHEN b <= 29 THEN 'row absent from raw extract'
              WHEN b <= 49 THEN 'original of a conflicting duplicate pair'
              WHEN b <= 59 THEN 'field=patients_tested'
              WHEN b <= 64 THEN 'field=suppression_pct'
              WHEN b <= 69 THEN 'field=drug_stock_level'
              WHEN b <= 89 THEN 'reporting_delay_days overwritten'
              WHEN b <= 94 THEN 'field=patients_tested'
              ELSE 'field=suppression_pct' END AS detail
  FROM tagged WHERE b <= 97
  UNION ALL
  SELECT facility_id, report_month, 'duplicate_facility_id', false,
         'conflicting duplicate submission'
  FROM tagged WHERE b BETWEEN 30 AND 49""",
    "med": """
  SELECT facility_id,
         median(CAST(patients_tested AS DOUBLE)) AS m_p, median(suppression_pct) AS m_s,
         median(drug_stock_level) AS m_d
  FROM raw GROUP BY facility_id""",
    "mad": """
  SELECT r.facility_id, m.m_p, m.m_s, m.m_d,
         median(abs(r.patients_tested - m.m_p)) AS d_p,
         median(abs(r.suppression_pct - m.m_s)) AS d_s,
         median(abs(r.drug_stock_level - m.m_d)) AS d_d
  FROM raw r JOIN med m ON r.facility_id = m.facility_id
  GROUP BY r.facility_id, m.m_p, m.m_s, m.m_d""",
    "dupkeys": """
  SELECT facility_id, report_month FROM raw GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "flags": """
  SELECT r.*,
         (f.facility_id IS NOT NULL) AS is_known,
         (d.facility_id IS NOT NULL) AS is_duplicate,
         COALESCE(r.patients_tested < 0, false) AS range_patients_tested,
         COALESCE(r.suppression_pct < 0 OR r.suppression_pct > 100, false)
           AS range_suppression_pct,
         COALESCE(r.drug_stock_level < 0 OR r.drug_stock_level > 100, false)
           AS range_drug_stock_level,
         COALESCE(r.reporting_delay_days < 0, false) AS range_reporting_delay_days,
         COALESCE(abs(r.patients_tested - x.m_p) / (nullif(x.d_p, 0) * 1.4826) > 5, false)
         OR COALESCE(abs(r.suppression_pct - x.m_s) / (nullif(x.d_s, 0) * 1.4826) > 5, false)
         OR COALESCE(abs(r.drug_stock_level - x.m_d) / (nullif(x.d_d, 0) * 1.4826) > 5, false)
           AS is_outlier
  FROM raw r
  LEFT JOIN (SELECT DISTINCT facility_id FROM facilities) f ON r.facility_id = f.facility_id
  LEFT JOIN dupkeys d ON r.facility_id = d.facility_id AND r.report_month = d.report_month
  LEFT JOIN mad x ON r.facility_id = x.facility_id""",
    "classified": """
  SELECT *,
         CASE WHEN NOT is_known THEN 'unknown_facility_id'
              WHEN is_duplicate THEN 'duplicate_facility_month'
              WHEN range_patients_tested THEN 'range_patients_tested'
              WHEN range_suppression_pct THEN 'range_suppression_pct'
              WHEN range_drug_stock_level THEN 'range_drug_stock_level'
              WHEN range_reporting_delay_days THEN 'range_reporting_delay_days'
              WHEN is_outlier THEN 'statistical_outlier' END AS quarantine_reason
  FROM flags""",
    "clean": """
  SELECT facility_id, report_month, patients_tested, suppression_pct, drug_stock_level,
         reporting_delay_days
  FROM classified WHERE quarantine_reason IS NULL""",
    "quarantined": """
  SELECT facility_id, report_month, patients_tested, suppression_pct, drug_stock_level,
         reporting_delay_days, quarantine_reason
  FROM classified WHERE quarantine_reason IS NOT NULL""",
    "gaps": """
  SELECT f.facility_id, m.report_month
  FROM (SELECT DISTINCT facility_id FROM facilities) f
  CROSS JOIN (SELECT DISTINCT report_month FROM raw) m
  WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.facility_id = f.facility_id
                                          AND r.report_month = m.report_month)""",
    "zs": """
  SELECT c.*,
         coalesce((CAST(patients_tested AS DOUBLE) - avg(CAST(patients_tested AS DOUBLE)) OVER w)
                  / nullif(stddev_samp(CAST(patients_tested AS DOUBLE)) OVER w, 0), 0)
           AS z_patients_tested,
         coalesce((suppression_pct - avg(suppression_pct) OVER w)
                  / nullif(stddev_samp(suppression_pct) OVER w, 0), 0) AS z_suppression_pct,
         coalesce((drug_stock_level - avg(drug_stock_level) OVER w)
                  / nullif(stddev_samp(drug_stock_level) OVER w, 0), 0) AS z_drug_stock_level,
         coalesce((CAST(reporting_delay_days AS DOUBLE)
                   - avg(CAST(reporting_delay_days AS DOUBLE)) OVER w)
                  / nullif(stddev_samp(CAST(reporting_delay_days AS DOUBLE)) OVER w, 0), 0)
           AS z_reporting_delay_days,
         COUNT(*) OVER w AS history_count
  FROM clean c WINDOW w AS (PARTITION BY facility_id)""",
    "ff": """
  SELECT c.*, f.baseline_patient_volume, f.region,
         CAST(month(c.report_month) AS INTEGER) AS month_of_year,
         lag(c.suppression_pct, 1) OVER w AS suppression_pct_lag_1,
         lag(c.suppression_pct, 2) OVER w AS suppression_pct_lag_2,
         lag(c.suppression_pct, 3) OVER w AS suppression_pct_lag_3,
         lag(c.patients_tested, 1) OVER w AS patients_tested_lag_1,
         lag(c.patients_tested, 2) OVER w AS patients_tested_lag_2,
         lag(c.patients_tested, 3) OVER w AS patients_tested_lag_3,
         CASE WHEN count(c.suppression_pct) OVER (PARTITION BY c.facility_id
                ORDER BY c.report_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
              THEN avg(c.suppression_pct) OVER (PARTITION BY c.facility_id
                ORDER BY c.report_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END
           AS suppression_pct_roll3_mean,
         lead(c.suppression_pct, 3) OVER w AS target_suppression_pct
  FROM clean c JOIN facilities f ON c.facility_id = f.facility_id
  WINDOW w AS (PARTITION BY c.facility_id ORDER BY c.report_month)""",
    "ds": """
  SELECT * FROM ff
  WHERE suppression_pct_lag_1 IS NOT NULL AND suppression_pct_lag_2 IS NOT NULL
    AND suppression_pct_lag_3 IS NOT NULL AND patients_tested_lag_1 IS NOT NULL
    AND patients_tested_lag_2 IS NOT NULL AND patients_tested_lag_3 IS NOT NULL
    AND suppression_pct_roll3_mean IS NOT NULL AND baseline_patient_volume IS NOT NULL
    AND suppression_pct IS NOT NULL AND patients_tested IS NOT NULL
    AND target_suppression_pct IS NOT NULL""",
    "cut": """
  SELECT min(report_month) AS cutoff
  FROM (SELECT DISTINCT report_month FROM ds ORDER BY report_month DESC LIMIT 4)""",
    "candidates": """
  SELECT DISTINCT facility_id, report_month FROM ledger WHERE is_anomaly_candidate""",
    "flags3": """
  SELECT r.*,
         (f.facility_id IS NOT NULL) AS is_known,
         (d.facility_id IS NOT NULL) AS is_duplicate,
         COALESCE(r.patients_tested < 0, false) AS range_patients_tested,
         COALESCE(r.suppression_pct < 0 OR r.suppression_pct > 100, false)
           AS range_suppression_pct,
         COALESCE(r.drug_stock_level < 0 OR r.drug_stock_level > 100, false)
           AS range_drug_stock_level,
         COALESCE(r.reporting_delay_days < 0, false) AS range_reporting_delay_days,
         COALESCE(abs(r.patients_tested - x.m_p) / (nullif(x.d_p, 0) * 1.4826) > 3, false)
         OR COALESCE(abs(r.suppression_pct - x.m_s) / (nullif(x.d_s, 0) * 1.4826) > 3, false)
         OR COALESCE(abs(r.drug_stock_level - x.m_d) / (nullif(x.d_d, 0) * 1.4826) > 3, false)
           AS is_outlier
  FROM raw r
  LEFT JOIN (SELECT DISTINCT facility_id FROM facilities) f ON r.facility_id = f.facility_id
  LEFT JOIN dupkeys d ON r.facility_id = d.facility_id AND r.report_month = d.report_month
  LEFT JOIN mad x ON r.facility_id = x.facility_id""",
    "classified3": """
  SELECT *,
         CASE WHEN NOT is_known THEN 'unknown_facility_id'
              WHEN is_duplicate THEN 'duplicate_facility_month'
              WHEN range_patients_tested THEN 'range_patients_tested'
              WHEN range_suppression_pct THEN 'range_suppression_pct'
              WHEN range_drug_stock_level THEN 'range_drug_stock_level'
              WHEN range_reporting_delay_days THEN 'range_reporting_delay_days'
              WHEN is_outlier THEN 'statistical_outlier' END AS quarantine_reason
  FROM flags3""",
    "quarantined3": """
  SELECT facility_id, report_month, patients_tested, suppression_pct, drug_stock_level,
         reporting_delay_days, quarantine_reason
  FROM classified3 WHERE quarantine_reason IS NOT NULL""",
}

_ORDER = list(BASE_CTES)


def with_base(select: str, extra: dict | None = None) -> str:
    """Prefix ``select`` with every base CTE (DuckDB skips unreferenced ones)
    followed by ``extra`` CTEs in the given order."""
    parts = [f"{name} AS ({BASE_CTES[name]}\n)" for name in _ORDER]
    for name, body in (extra or {}).items():
        parts.append(f"{name} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + select
