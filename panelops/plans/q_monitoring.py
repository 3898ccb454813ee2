"""Monitoring queries (X1, X3) checkable by SQL.

X1 treats each reporting year of the classified batch as one run; X3 scores
the carry-forward forecast (current value for three months ahead) against
the actual that arrives three calendar months later.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from panelops.operators.checks import REASON
from panelops.operators import evaluate, features, history
from panelops.operators.monitoring import (
    live_forecast_mae,
    quarantine_change_points,
    quarantine_rate_trend,
    sequential_drift,
)
from panelops.plans.inputs import RAW_COLUMNS, Inputs
from panelops.plans.oracle import with_base
from panelops.plans.registry import query, r6
from panelops.schemas import ANOMALY_FIELDS, KEY, PERIOD
from panelops.session import cut_lineage

_X1_RUNS = """
  SELECT CAST(year(report_month) AS VARCHAR) AS run_id,
         make_date(CAST(year(report_month) AS INTEGER), 12, 31) AS dag_logical_date,
         round(COUNT(*) FILTER (WHERE quarantine_reason IS NOT NULL) / COUNT(*), 4)
           AS quarantine_rate
  FROM classified GROUP BY 1, 2"""

_X1_SQL = """
SELECT run_id, dag_logical_date, quarantine_rate,
       round(rate_change, 6) AS rate_change, round(prior_mean, 6) AS prior_mean,
       CASE WHEN prior_mean IS NOT NULL AND quarantine_rate > prior_mean * 2 THEN 'spike'
            WHEN base_mean IS NOT NULL AND recent_min > base_mean THEN 'shift'
            ELSE 'stable' END AS trend
FROM (
  SELECT *, quarantine_rate - lag(quarantine_rate, 1) OVER (ORDER BY dag_logical_date)
              AS rate_change,
         avg(quarantine_rate) OVER (ORDER BY dag_logical_date
                                    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prior_mean,
         avg(quarantine_rate) OVER (ORDER BY dag_logical_date
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 3 PRECEDING)
           AS base_mean,
         min(quarantine_rate) OVER (ORDER BY dag_logical_date
                                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent_min
  FROM runs)"""


@query("x1_quarantine_rate_trend", with_base(_X1_SQL, {"runs": _X1_RUNS}))
def x1_quarantine_rate_trend(spark, sf_dir):
    c = Inputs(spark, sf_dir).classified
    y = F.year(PERIOD)
    runs = c.groupBy(y.cast("string").alias("run_id"), F.make_date(y, F.lit(12), F.lit(31)).alias(
        "dag_logical_date"
    )).agg(
        F.round(
            F.count_if(F.col(REASON).isNotNull()) / F.count(F.lit(1)), 4
        ).alias("quarantine_rate")
    )
    t = quarantine_rate_trend(runs)
    return t.select(
        "run_id", "dag_logical_date", "quarantine_rate",
        r6("rate_change").alias("rate_change"), r6("prior_mean").alias("prior_mean"), "trend",
    )


@query(
    "x3_live_forecast_mae",
    with_base(
        """
SELECT origin_month, n_matched,
       ((units * 200 + n_matched) // (n_matched * 2)) / 1e6 AS live_mae
FROM (
  SELECT f.report_month AS origin_month, COUNT(*) AS n_matched,
         SUM(CAST(round(abs(a.suppression_pct - f.suppression_pct) * 10000) AS BIGINT)) AS units
  FROM clean f JOIN clean a
    ON a.facility_id = f.facility_id AND a.report_month = f.report_month + INTERVAL 3 MONTH
  GROUP BY 1)"""
    ),
)
def x3_live_forecast_mae(spark, sf_dir):
    c = Inputs(spark, sf_dir).clean
    return live_forecast_mae(c, c, "suppression_pct", "suppression_pct", input_decimals=4)


# Each month of the batch as a run; the sums are folded row by row.
_CUSUM = """
WITH RECURSIVE {base},
runs AS (
  SELECT report_month, strftime(report_month, '%Y-%m') AS run_id,
         round(COUNT(*) FILTER (WHERE quarantine_reason IS NOT NULL) / COUNT(*), 4) AS rate
  FROM classified GROUP BY 1, 2
),
n AS (SELECT *, row_number() OVER (ORDER BY report_month) AS k FROM runs),
mean AS (SELECT avg(rate) AS m FROM n WHERE k <= 6),
f AS (
  SELECT k, 0.0::DOUBLE AS s FROM n WHERE k = 1
  UNION ALL
  SELECT n.k, CASE WHEN n.k <= 6 THEN 0.0::DOUBLE ELSE
    greatest(0.0::DOUBLE, f.s + least(n.rate - (SELECT m FROM mean) - 0.01::DOUBLE, 0.02::DOUBLE)) END
  FROM f JOIN n ON n.k = f.k + 1
)
SELECT run_id, report_month AS dag_logical_date, rate AS quarantine_rate,
       round(m, 9) AS baseline_rate, round(s, 9) AS cusum,
       CASE WHEN k <= 6 THEN 'baseline' WHEN round(s, 9) > 0.05 THEN 'shift'
            WHEN rate > m + 0.03::DOUBLE THEN 'spike' ELSE 'stable' END AS trend
FROM n JOIN f USING (k), mean"""


def _recursive(sql: str) -> str:
    base = with_base("").strip()
    return sql.format(base=base.removeprefix("WITH").strip())


@query("x1_change_points", _recursive(_CUSUM))
def x1_change_points(spark, sf_dir):
    c = Inputs(spark, sf_dir).classified
    runs = c.groupBy(
        F.date_format(PERIOD, "yyyy-MM").alias("run_id"), F.col(PERIOD).alias("dag_logical_date")
    ).agg(
        F.round(F.count_if(F.col(REASON).isNotNull()) / F.count(F.lit(1)), 4).alias("quarantine_rate")
    )
    return quarantine_change_points(runs)


_Z = [f"z_{f}" for f in ANOMALY_FIELDS]
_UP, _DOWN = 0.05 * 1.5, 0.05 / 1.5
_STEP = "n.n_flagged * {a!r}::DOUBLE + (n.n_scored - n.n_flagged) * {b!r}::DOUBLE"
_SPRT = """
WITH RECURSIVE {base},
runs AS (
  SELECT report_month, COUNT(*) AS n_scored, COUNT(*) FILTER (WHERE """ + " OR ".join(
    f"abs({z}) > 2.5" for z in _Z
) + """) AS n_flagged FROM zs WHERE history_count >= 2 GROUP BY 1
),
n AS (SELECT *, row_number() OVER (ORDER BY report_month) AS k FROM runs),
f AS (
  SELECT 0::BIGINT AS k, 0.0::DOUBLE AS u, 0.0::DOUBLE AS d
  UNION ALL
  SELECT n.k, greatest(0.0, f.u + """ + _STEP.format(
    a=math.log(_UP / 0.05), b=math.log((1 - _UP) / 0.95)
) + """), greatest(0.0, f.d + """ + _STEP.format(
    a=math.log(_DOWN / 0.05), b=math.log((1 - _DOWN) / 0.95)
) + """)
  FROM f JOIN n ON n.k = f.k + 1
)
SELECT report_month, n_scored, n_flagged, round(u, 6) AS evidence_up, round(d, 6) AS evidence_down,
       CASE WHEN round(u, 6) > ln(1000) THEN 'up' WHEN round(d, 6) > ln(1000) THEN 'down'
            ELSE 'none' END AS drift
FROM n JOIN f USING (k)"""


@query("x2_sequential_drift", _recursive(_SPRT))
def x2_sequential_drift(spark, sf_dir):
    """Each month as a run of a rule detector (any |z| > 2.5)."""
    f = features.with_enough_history(Inputs(spark, sf_dir).anomaly_features)
    flag = F.lit(False)
    for z in _Z:
        flag = flag | (F.abs(F.col(z)) > F.lit(2.5))
    return sequential_drift(f.select(PERIOD, flag.alias("is_anomaly")))


_POISSON = " + ".join(f"(u >= {p!r}::DOUBLE)::INT" for p in evaluate.POISSON_ONE)


@query(
    "x4_paired_bootstrap",
    with_base(
        f"""
SELECT (SELECT count(*) FROM d) AS n_rows, (SELECT round(avg(d), 6) FROM d) AS mae_difference,
       round(quantile_cont(m, 0.025), 6) AS mae_difference_lower,
       round(quantile_cont(m, 0.975), 6) AS mae_difference_upper,
       quantile_cont(m, 0.975) < 0 AS better
FROM (
  SELECT b, sum(d * ({_POISSON})) / sum({_POISSON}) AS m
  FROM (SELECT d, b, ('0x' || substr(md5(key || '|' || b), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
        FROM d, (SELECT unnest(range(0, 200)) AS b))
  GROUP BY b)""",
        {
            "d": """
  SELECT facility_id || '|' || report_month AS key,
         abs(target_suppression_pct - suppression_pct_roll3_mean)
         - abs(target_suppression_pct - suppression_pct) AS d
  FROM ds WHERE report_month >= (SELECT cutoff FROM cut)"""
        },
    ),
)
def x4_paired_bootstrap(spark, sf_dir):
    """The trailing mean against carry-forward, on the held-out months."""
    _, test = features.time_split(Inputs(spark, sf_dir).dataset)
    return evaluate.paired_mae_difference(
        test, KEY, features.TARGET_COL, "suppression_pct_roll3_mean", "suppression_pct"
    )


@query(
    "w1_incremental_zscores",
    with_base(
        "SELECT " + ", ".join(RAW_COLUMNS) + ", "
        + ", ".join(f"round({z}, 6) AS {z}" for z in _Z)
        + ", history_count, history_count < 2 AS insufficient_history FROM zs"
    ),
)
def w1_incremental_zscores(spark, sf_dir):
    """W1 from kept moments. An earlier run stored the clean table without the
    year 1997, with other values in 1996 and with outliers of 1995 that this
    run retracts; only those three years are handed over."""
    i = Inputs(spark, sf_dir)
    clean = cut_lineage(i.clean, "clean")
    year = F.year(PERIOD)
    outliers = i.quarantined.where((F.col(REASON) == "statistical_outlier") & (year == 1995))
    stored = cut_lineage(
        clean.where(year != 1997).withColumn(
            "patients_tested", F.col("patients_tested") + F.when(year == 1996, 7).otherwise(0)
        ).unionByName(outliers.select(*RAW_COLUMNS)),
        "stored",
    )
    state = cut_lineage(history.moments(stored), "state")
    touched = year.between(1995, 1997)
    state = history.changed(state, stored.where(touched), clean.where(touched))
    f = history.anomaly_features(clean, state)
    return f.select(*RAW_COLUMNS, *[r6(z).alias(z) for z in _Z], "history_count", "insufficient_history")
