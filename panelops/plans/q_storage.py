"""Storage-operator queries (S9, S11-S14, P10) as pure DataFrame functions.

Scenario over the clean table: run-A stored the months before 1999; run-B
delivers the months from 1998 on with changed values. Retraction and
quarantine replacement use a stricter re-validation (robust z > 3) of the
same batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelops.operators import upsert as up
from panelops.plans.inputs import RAW_COLUMNS, Inputs
from panelops.plans.oracle import with_base
from panelops.plans.registry import query
from panelops.schemas import ENTITY, PERIOD

RUN_A, RUN_B = "run-A", "run-B"
DATE_A, DATE_B = "1998-12-31", "2001-12-31"
TS_A, TS_B = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
SPLIT_A = "1999-01-01"  # run-A: months before
SPLIT_B = "1998-01-01"  # run-B: months from

_RAW = ", ".join(RAW_COLUMNS)
_RAW_NO_P = ", ".join(c for c in RAW_COLUMNS if c != "patients_tested")


def _stored(i: Inputs):
    return up.stamp_lineage(
        i.clean.where(F.col(PERIOD) < F.lit(SPLIT_A).cast("date")), RUN_A, DATE_A,
        ingested_at=TS_A,
    )


def _incoming(i: Inputs):
    inc = i.clean.where(F.col(PERIOD) >= F.lit(SPLIT_B).cast("date")).withColumn(
        "patients_tested", (F.col("patients_tested") + 1).cast("int")
    )
    return up.stamp_lineage(inc, RUN_B, DATE_B, ingested_at=TS_B)


_SCENARIO = {
    "tgt": f"""
  SELECT {_RAW}, 'run-A' AS run_id, DATE '{DATE_A}' AS dag_logical_date,
         TIMESTAMP '{TS_A}' AS ingested_at
  FROM clean WHERE report_month < DATE '{SPLIT_A}'""",
    "inc": f"""
  SELECT facility_id, report_month, CAST(patients_tested + 1 AS INTEGER) AS patients_tested,
         suppression_pct, drug_stock_level, reporting_delay_days,
         'run-B' AS run_id, DATE '{DATE_B}' AS dag_logical_date,
         TIMESTAMP '{TS_B}' AS ingested_at
  FROM clean WHERE report_month >= DATE '{SPLIT_B}'""",
    "upserted": f"""
  SELECT * FROM tgt t WHERE NOT EXISTS (
    SELECT 1 FROM inc i WHERE i.facility_id = t.facility_id AND i.report_month = t.report_month)
  UNION ALL
  SELECT i.facility_id, i.report_month, i.patients_tested, i.suppression_pct,
         i.drug_stock_level, i.reporting_delay_days, i.run_id, i.dag_logical_date,
         COALESCE(t.ingested_at, i.ingested_at) AS ingested_at
  FROM inc i LEFT JOIN tgt t
    ON i.facility_id = t.facility_id AND i.report_month = t.report_month""",
}


@query(
    "s9_stamp_raw",
    with_base(
        f"SELECT {_RAW}, 'lineitem.parquet' AS source_file, 'run-B' AS run_id, "
        f"DATE '{DATE_B}' AS dag_logical_date, TIMESTAMP '{TS_B}' AS ingested_at FROM raw"
    ),
)
def s9_stamp_raw(spark, sf_dir):
    return up.stamp_lineage(
        Inputs(spark, sf_dir).raw, RUN_B, DATE_B, source_file="lineitem.parquet", ingested_at=TS_B
    )


@query("s12_upsert_clean", with_base("SELECT * FROM upserted", _SCENARIO))
def s12_upsert_clean(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return up.upsert(_stored(i), _incoming(i), preserve=("ingested_at",))


@query("p10_upsert_idempotent", with_base("SELECT * FROM upserted", _SCENARIO))
def p10_upsert_idempotent(spark, sf_dir):
    """Applying the same upsert twice equals applying it once."""
    i = Inputs(spark, sf_dir)
    once = up.upsert(_stored(i), _incoming(i), preserve=("ingested_at",))
    return up.upsert(once, _incoming(i), preserve=("ingested_at",))


_RETRACT = {
    "stored_all": f"""
  SELECT {_RAW},
         CASE WHEN report_month < DATE '{SPLIT_A}' THEN 'run-A' ELSE 'run-B' END AS run_id,
         DATE '{DATE_A}' AS dag_logical_date, TIMESTAMP '{TS_A}' AS ingested_at
  FROM clean""",
}


def _stored_all(i: Inputs):
    run = F.when(F.col(PERIOD) < F.lit(SPLIT_A).cast("date"), F.lit(RUN_A)).otherwise(
        F.lit(RUN_B)
    )
    return up.stamp_lineage(i.clean, RUN_A, DATE_A, ingested_at=TS_A).withColumn("run_id", run)


@query(
    "s13_retract_same_run",
    with_base(
        "SELECT * FROM stored_all s WHERE NOT (s.run_id = 'run-A' AND EXISTS ("
        "SELECT 1 FROM quarantined3 q WHERE q.facility_id = s.facility_id "
        "AND q.report_month = s.report_month))",
        _RETRACT,
    ),
)
def s13_retract_same_run(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return up.retract(_stored_all(i), i.quarantined_strict, RUN_A)


@query(
    "s13_retract_any_run",
    with_base(
        "SELECT * FROM stored_all s WHERE NOT EXISTS ("
        "SELECT 1 FROM quarantined3 q WHERE q.facility_id = s.facility_id "
        "AND q.report_month = s.report_month)",
        _RETRACT,
    ),
)
def s13_retract_any_run(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return up.retract(_stored_all(i), i.quarantined_strict, RUN_A, retract_scope="any_run")


@query(
    "s12_s13_validate_merge",
    with_base(
        """
SELECT * FROM stored_all s
WHERE NOT EXISTS (SELECT 1 FROM inc3 i WHERE i.facility_id = s.facility_id
                                         AND i.report_month = s.report_month)
  AND NOT (s.run_id = 'run-B' AND EXISTS (
       SELECT 1 FROM quarantined3 q WHERE q.facility_id = s.facility_id
                                      AND q.report_month = s.report_month))
UNION ALL
SELECT i.facility_id, i.report_month, i.patients_tested, i.suppression_pct,
       i.drug_stock_level, i.reporting_delay_days, i.run_id, i.dag_logical_date,
       COALESCE(s.ingested_at, i.ingested_at) AS ingested_at
FROM inc3 i LEFT JOIN stored_all s
  ON i.facility_id = s.facility_id AND i.report_month = s.report_month""",
        {
            **_RETRACT,
            "inc3": f"""
  SELECT {_RAW}, 'run-B' AS run_id, DATE '{DATE_B}' AS dag_logical_date,
         TIMESTAMP '{TS_B}' AS ingested_at
  FROM classified3 WHERE quarantine_reason IS NULL AND report_month >= DATE '{SPLIT_B}'""",
        },
    ),
)
def s12_s13_validate_merge(spark, sf_dir):
    """Re-validation of run-B with stricter rules: retract run-B's keys that
    are now quarantined and upsert its clean rows in one merge."""
    i = Inputs(spark, sf_dir)
    strict_clean = i.classified_strict.where(
        F.col("quarantine_reason").isNull() & (F.col(PERIOD) >= F.lit(SPLIT_B).cast("date"))
    ).select(*RAW_COLUMNS)
    inc = up.stamp_lineage(strict_clean, RUN_B, DATE_B, ingested_at=TS_B)
    return up.upsert_clean(_stored_all(i), inc, i.quarantined_strict, RUN_B)


@query(
    "s14_replace_quarantine",
    with_base(
        f"""
SELECT * FROM (
  SELECT {_RAW}, quarantine_reason,
         CASE WHEN report_month < DATE '{SPLIT_A}' THEN 'run-A' ELSE 'run-B' END AS run_id
  FROM quarantined) s WHERE run_id <> 'run-B'
UNION ALL
SELECT {_RAW}, quarantine_reason, 'run-B' AS run_id FROM quarantined3
WHERE report_month >= DATE '{SPLIT_A}'"""
    ),
)
def s14_replace_quarantine(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    run = F.when(F.col(PERIOD) < F.lit(SPLIT_A).cast("date"), F.lit(RUN_A)).otherwise(
        F.lit(RUN_B)
    )
    stored = i.quarantined.withColumn("run_id", run)
    new = i.quarantined_strict.where(F.col(PERIOD) >= F.lit(SPLIT_A).cast("date")).withColumn(
        "run_id", F.lit(RUN_B)
    )
    return up.replace_run(stored, new, RUN_B)


@query(
    "s11_upsert_facilities",
    with_base(
        """
SELECT * FROM facilities f WHERE NOT EXISTS (
  SELECT 1 FROM supplier s WHERE 'S-' || CAST(s.s_suppkey AS VARCHAR) = f.facility_id)
UNION ALL
SELECT 'S-' || CAST(s.s_suppkey AS VARCHAR) AS facility_id, s.s_name AS facility_name,
       r.r_name AS region, n.n_name AS ownership_type,
       CAST(floor(abs(s.s_acctbal)) AS INTEGER) + 1 AS baseline_patient_volume,
       o.opened_date
FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT suppkey, MIN(first_ship) AS opened_date FROM sm GROUP BY suppkey) o
  ON o.suppkey = s.s_suppkey"""
    ),
)
def s11_upsert_facilities(spark, sf_dir):
    """Full roster delivery (negative balances included) with every
    non-key column overwritten."""
    from panelops.sources import panel as src

    i = Inputs(spark, sf_dir)
    everyone = src.facilities_from_months(
        i.table("supplier").withColumn("s_acctbal", F.abs("s_acctbal")),
        i.table("nation"), i.table("region"), i.supplier_months,
    ).withColumn("baseline_patient_volume", (F.col("baseline_patient_volume") + 1).cast("int"))
    return up.upsert(i.facilities, everyone, keys=[ENTITY])
