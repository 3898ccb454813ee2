"""Feature-slice queries: z-scores, history, lags/leads/rolling, split,
naive baseline, reasons and sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelops.functions.reasons import build_reasons, reasons_to_sentence
from panelops.operators import features as feat
from panelops.plans.inputs import RAW_COLUMNS, Inputs
from panelops.plans.oracle import with_base
from panelops.plans.registry import query, r6
from panelops.schemas import ANOMALY_FIELDS, ENTITY, FORECAST_FEATURES, PERIOD

_Z = [f"z_{f}" for f in ANOMALY_FIELDS]


@query(
    "w1_zscores",
    with_base(
        "SELECT " + ", ".join(RAW_COLUMNS)
        + ", " + ", ".join(f"round({z}, 6) AS {z}" for z in _Z)
        + ", history_count, history_count < 2 AS insufficient_history FROM zs"
    ),
)
def w1_zscores(spark, sf_dir):
    f = Inputs(spark, sf_dir).anomaly_features
    return f.select(*RAW_COLUMNS, *[r6(z).alias(z) for z in _Z], "history_count",
                    "insufficient_history")


@query(
    "b7_enough_history",
    with_base("SELECT facility_id, report_month FROM zs WHERE history_count >= 2"),
)
def b7_enough_history(spark, sf_dir):
    return feat.with_enough_history(Inputs(spark, sf_dir).anomaly_features).select(ENTITY, PERIOD)


_FF_OUT = [
    ENTITY, PERIOD, "suppression_pct", "patients_tested",
    "suppression_pct_lag_1", "suppression_pct_lag_2", "suppression_pct_lag_3",
    "patients_tested_lag_1", "patients_tested_lag_2", "patients_tested_lag_3",
    "suppression_pct_roll3_mean", "month_of_year", "baseline_patient_volume", "region",
    "target_suppression_pct",
]


def _ff_select_sql(src: str, extra: str = "") -> str:
    cols = [c if c != "suppression_pct_roll3_mean" else f"round({c}, 6) AS {c}" for c in _FF_OUT]
    return f"SELECT {', '.join(cols)}{extra} FROM {src}"


def _ff_select(df):
    return df.select(
        *[r6(c).alias(c) if c == "suppression_pct_roll3_mean" else F.col(c) for c in _FF_OUT]
    )


@query("w2_w4_forecast_features", with_base(_ff_select_sql("ff")))
def w2_w4_forecast_features(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return _ff_select(feat.forecast_features(i.clean, i.facilities))


@query("b8_forecast_dataset", with_base(_ff_select_sql("ds")))
def b8_forecast_dataset(spark, sf_dir):
    return _ff_select(Inputs(spark, sf_dir).dataset)


_REQ_NO_TARGET = " AND ".join(f"{c} IS NOT NULL" for c in FORECAST_FEATURES)


@query(
    "b8_scoring_rows",
    with_base(_ff_select_sql("ff") + f" WHERE {_REQ_NO_TARGET}"),
)
def b8_scoring_rows(spark, sf_dir):
    return _ff_select(Inputs(spark, sf_dir).forecast_rows)


@query(
    "d9_time_split",
    with_base(
        "SELECT facility_id, report_month, "
        "CASE WHEN report_month < (SELECT cutoff FROM cut) THEN 'train' ELSE 'test' END "
        "AS split FROM ds"
    ),
)
def d9_time_split(spark, sf_dir):
    train, test = feat.time_split(Inputs(spark, sf_dir).dataset)
    return train.select(ENTITY, PERIOD, F.lit("train").alias("split")).unionByName(
        test.select(ENTITY, PERIOD, F.lit("test").alias("split"))
    )


@query(
    "a20_split_counts",
    with_base(
        "SELECT (SELECT cutoff FROM cut) AS test_month_cutoff, "
        "COUNT(*) FILTER (WHERE report_month < (SELECT cutoff FROM cut)) AS train_rows, "
        "COUNT(*) FILTER (WHERE report_month >= (SELECT cutoff FROM cut)) AS test_rows FROM ds"
    ),
)
def a20_split_counts(spark, sf_dir):
    ds = Inputs(spark, sf_dir).dataset
    cut = feat.cutoff_month(ds)
    return ds.agg(
        F.count_if(F.col(PERIOD) < cut).alias("train_rows"),
        F.count_if(F.col(PERIOD) >= cut).alias("test_rows"),
    ).select(cut.alias("test_month_cutoff"), "train_rows", "test_rows")


@query(
    "a13_naive_mae",
    with_base(
        "SELECT round(avg(abs(target_suppression_pct - suppression_pct)), 6) "
        "AS mae_naive_baseline FROM ds WHERE report_month >= (SELECT cutoff FROM cut)"
    ),
)
def a13_naive_mae(spark, sf_dir):
    _, test = feat.time_split(Inputs(spark, sf_dir).dataset)
    return feat.naive_mae(test).select(r6("mae_naive_baseline").alias("mae_naive_baseline"))


def _candidate_reasons(i: Inputs):
    """Reasons for rows flagged by the ground-truth ledger (a deterministic
    stand-in for the model flag, so the expression is SQL-checkable)."""
    cand = i.candidates.withColumn("_cand", F.lit(True))
    f = feat.with_enough_history(i.anomaly_features).join(cand, [ENTITY, PERIOD], "left")
    return f.select(
        ENTITY, PERIOD, build_reasons(F.col("_cand")).alias("anomaly_reasons"),
        F.coalesce(F.col("_cand"), F.lit(False)).alias("is_flagged"),
    )


_REASON_ROWS_SQL = """
SELECT z.facility_id, z.report_month, r.pos, r.field, round(r.z, 2) AS z_score,
       CASE WHEN r.z > 0 THEN 'high' ELSE 'low' END AS direction
FROM zs z
JOIN candidates c ON z.facility_id = c.facility_id AND z.report_month = c.report_month
CROSS JOIN LATERAL (VALUES
    (1, 'patients_tested', z.z_patients_tested),
    (2, 'suppression_pct', z.z_suppression_pct),
    (3, 'drug_stock_level', z.z_drug_stock_level),
    (4, 'reporting_delay_days', z.z_reporting_delay_days)) AS r(fpos, field, z)
CROSS JOIN (SELECT 1) AS one(dummy)
WHERE z.history_count >= 2 AND abs(r.z) > 2.0
"""


@query(
    "f13_reasons",
    with_base(
        "SELECT facility_id, report_month, CAST(rn AS INTEGER) AS pos, field, z_score, direction "
        "FROM (SELECT *, row_number() OVER (PARTITION BY facility_id, report_month "
        "ORDER BY fpos) - 1 AS rn FROM ("
        + _REASON_ROWS_SQL.replace("r.pos, ", "r.fpos, ").replace(
            "CROSS JOIN (SELECT 1) AS one(dummy)\n", "")
        + "))"
    ),
)
def f13_reasons(spark, sf_dir):
    r = _candidate_reasons(Inputs(spark, sf_dir))
    return r.select(ENTITY, PERIOD, F.posexplode("anomaly_reasons").alias("pos", "r")).select(
        ENTITY, PERIOD, "pos", "r.field", "r.z_score", "r.direction"
    )


_SENTENCE_SQL = """
SELECT z.facility_id, z.report_month,
       CASE WHEN s.txt IS NULL THEN
         'Flagged by the model, but no single indicator crossed the plain-language threshold.'
       ELSE s.txt || '.' END AS why_flagged
FROM zs z
JOIN candidates c ON z.facility_id = c.facility_id AND z.report_month = c.report_month
LEFT JOIN (
  SELECT facility_id, report_month,
         string_agg('**' || label || '** was '
                    || CASE WHEN z > 0 THEN 'much higher' ELSE 'much lower' END
                    || ' than usual for this clinic', '; ' ORDER BY fpos) AS txt
  FROM (
    SELECT z.facility_id, z.report_month, r.fpos, r.label, r.z
    FROM zs z CROSS JOIN LATERAL (VALUES
      (1, 'patients tested', z.z_patients_tested),
      (2, 'viral load suppression rate', z.z_suppression_pct),
      (3, 'drug stock level', z.z_drug_stock_level),
      (4, 'reporting delay', z.z_reporting_delay_days)) AS r(fpos, label, z)
    WHERE abs(r.z) > 2.0)
  GROUP BY 1, 2) s
  ON s.facility_id = z.facility_id AND s.report_month = z.report_month
WHERE z.history_count >= 2
"""


@query("f11_reason_sentences", with_base(_SENTENCE_SQL))
def f11_reason_sentences(spark, sf_dir):
    r = _candidate_reasons(Inputs(spark, sf_dir)).where(F.col("is_flagged"))
    return r.select(ENTITY, PERIOD, reasons_to_sentence(F.col("anomaly_reasons")).alias("why_flagged"))


@query(
    "k6_latest_per_entity",
    with_base(
        "SELECT facility_id, arg_max(report_month, report_month) AS report_month, "
        "arg_max(suppression_pct, report_month) AS suppression_pct FROM clean GROUP BY 1"
    ),
)
def k6_latest_per_entity(spark, sf_dir):
    c = Inputs(spark, sf_dir).clean
    latest = c.groupBy(ENTITY).agg(
        F.max_by(F.struct(PERIOD, "suppression_pct"), F.col(PERIOD)).alias("r")
    )
    return latest.select(ENTITY, "r.report_month", "r.suppression_pct")
