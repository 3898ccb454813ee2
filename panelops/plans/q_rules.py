"""Model-backed operators on fixed models that SQL can follow.

The fitted models of :mod:`panelops.plans.q_models` cannot be re-fitted by
SQL, so the same operators also run here on

* a rule detector (any |z| > 3; score = the largest |z| less 3) with a
  carry-forward forecast, for everything that consumes a scored table, and
* small ensembles written out as literals, for the arithmetic of scoring a
  forest and of exact attributions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from panelops.functions.reasons import build_reasons
from panelops.models import boosting, iforest, treeshap
from panelops.models import forecast as fc
from panelops.operators import evaluate, features, scoring
from panelops.operators import upsert as up
from panelops.operators.monitoring import anomaly_rate_drift
from panelops.plans import views
from panelops.plans.inputs import Inputs
from panelops.plans.oracle import with_base
from panelops.plans.q_features import _SENTENCE_SQL
from panelops.plans.q_models import fitted
from panelops.plans.registry import query, r6
from panelops.schemas import (
    ANOMALY_FIELDS,
    ENTITY,
    FORECAST_FEATURES,
    IFOREST_MAX_SAMPLES,
    IFOREST_TREES,
    KEY,
    PERIOD,
)
from panelops.session import cut_lineage

_Z = [f"z_{f}" for f in ANOMALY_FIELDS]
LIMIT = 3.0


def rule_scored(i: Inputs):
    """A scored table by the rule detector, shaped like the models' output."""
    f = features.with_enough_history(i.anomaly_features)
    largest = F.greatest(*[F.abs(F.col(z)) for z in _Z])
    scored = f.select(
        *KEY, *_Z, (largest > LIMIT).alias("is_anomaly"),
        F.round(largest - LIMIT, 6).alias("anomaly_score"),
    )
    carried = i.forecast_rows.select(
        *KEY, F.col("suppression_pct").alias(scoring.FORECAST_COL)
    )
    return scored.select(
        *KEY, "is_anomaly", "anomaly_score",
        build_reasons(F.col("is_anomaly")).alias("anomaly_reasons"),
    ).join(carried, KEY, "left").select(
        "*", F.lit("3").alias("model_version_anomaly"), F.lit("1").alias("model_version_forecast")
    )


_LAGS = " AND ".join(f"f.{c} IS NOT NULL" for c in FORECAST_FEATURES)
_GREATEST = "greatest(" + ", ".join(f"abs({z})" for z in _Z) + ")"
_CTES = {
    "sc": f"""
  SELECT z.facility_id, z.report_month, {_GREATEST} > 3 AS is_anomaly,
         round({_GREATEST} - 3, 6) AS anomaly_score,
         f.suppression_pct AS forecast_next_quarter_suppression_pct
  FROM zs z LEFT JOIN (SELECT * FROM ff f WHERE {_LAGS}) f
    ON z.facility_id = f.facility_id AND z.report_month = f.report_month
  WHERE z.history_count >= 2""",
    "sentences": _SENTENCE_SQL.replace(
        "JOIN candidates c ON z.facility_id = c.facility_id "
        "AND z.report_month = c.report_month\n", ""
    ),
    "board": """
  SELECT sc.*, strftime(sc.report_month, '%B %Y') AS month_label,
         '3' AS model_version_anomaly, '1' AS model_version_forecast,
         f.facility_name, f.region, c.patients_tested, c.suppression_pct, c.drug_stock_level,
         c.reporting_delay_days, CASE WHEN sc.is_anomaly THEN w.why_flagged END AS why_flagged
  FROM sc
  JOIN facilities f ON f.facility_id = sc.facility_id
  JOIN clean c ON c.facility_id = sc.facility_id AND c.report_month = sc.report_month
  LEFT JOIN sentences w ON w.facility_id = sc.facility_id AND w.report_month = sc.report_month
  WHERE sc.report_month = (SELECT max(report_month) FROM clean)""",
}


def _sql(select: str) -> str:
    return with_base(select, _CTES)


def _board(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    month = str(i.clean.agg(F.max(PERIOD)).first()[0])
    return views.month_board(rule_scored(i), i.facilities, i.clean, month)


@query("p7_month_board_rule", _sql("SELECT * FROM board"))
def p7_month_board_rule(spark, sf_dir):
    return _board(spark, sf_dir).drop("anomaly_reasons")


@query(
    "k3_flagged_rule",
    _sql("SELECT facility_id, facility_name, anomaly_score, why_flagged FROM board WHERE is_anomaly"),
)
def k3_flagged_rule(spark, sf_dir):
    return views.flagged(_board(spark, sf_dir)).select(
        ENTITY, "facility_name", "anomaly_score", "why_flagged"
    )


@query(
    "p8_kpis_rule",
    _sql("""
SELECT reporting, flagged, round(flagged * 100.0::DOUBLE / nullif(reporting, 0), 1) AS flagged_pct,
       CASE WHEN reporting > 0 THEN printf('%.1f%%', flagged * 100.0::DOUBLE / reporting)
            ELSE 'n/a' END AS flagged_rate_label
FROM (SELECT COUNT(*) AS reporting, COUNT(*) FILTER (WHERE is_anomaly) AS flagged FROM board)"""),
)
def p8_kpis_rule(spark, sf_dir):
    return views.kpis(_board(spark, sf_dir))


@query(
    "p8_all_entities_rule",
    _sql("""
SELECT facility_id AS "Facility", facility_name AS "Name", region AS "Region",
       is_anomaly AS "Flagged", suppression_pct AS "Suppression %",
       forecast_next_quarter_suppression_pct AS "Forecast (next qtr)" FROM board"""),
)
def p8_all_entities_rule(spark, sf_dir):
    return views.all_entities(_board(spark, sf_dir))


@query(
    "p9_versions_rule",
    _sql("SELECT DISTINCT model_version_anomaly, model_version_forecast FROM board"),
)
def p9_versions_rule(spark, sf_dir):
    return views.versions_in_use(_board(spark, sf_dir))


@query(
    "a16_score_summary_rule",
    _sql("""
SELECT COUNT(*) AS rows_scored, COUNT(*) FILTER (WHERE is_anomaly) AS n_flagged_anomaly,
       COUNT(forecast_next_quarter_suppression_pct) AS n_forecasted FROM sc"""),
)
def a16_score_summary_rule(spark, sf_dir):
    return rule_scored(Inputs(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if("is_anomaly").alias("n_flagged_anomaly"),
        F.count(scoring.FORECAST_COL).alias("n_forecasted"),
    )


@query(
    "x2_drift_per_run_rule",
    _sql("""
SELECT run_id, n_scored, n_flagged, round(n_flagged / n_scored, 6) AS flagged_rate,
       abs(n_flagged / n_scored - 0.05) > 0.025 AS drift
FROM (SELECT CAST(year(report_month) AS VARCHAR) AS run_id, COUNT(*) AS n_scored,
             COUNT(*) FILTER (WHERE is_anomaly) AS n_flagged FROM sc GROUP BY 1)"""),
)
def x2_drift_per_run_rule(spark, sf_dir):
    """X2 over several runs: each reporting year stands for one scoring run."""
    runs = rule_scored(Inputs(spark, sf_dir)).withColumn("run_id", F.year(PERIOD).cast("string"))
    return anomaly_rate_drift(runs, group_col="run_id")


@query(
    "x3_live_mae_against_baseline",
    with_base(
        """
SELECT origin_month, n_matched, round(live_mae, 9) AS live_mae,
       round(baseline_mae, 9) AS baseline_mae, round(live_mae, 9) > round(baseline_mae, 9) AS alert
FROM (
  SELECT f.report_month AS origin_month, COUNT(*) AS n_matched,
         avg(abs(a.suppression_pct - f.suppression_pct_roll3_mean)) AS live_mae,
         avg(abs(a.suppression_pct - f.suppression_pct)) AS baseline_mae
  FROM ff f JOIN clean a
    ON a.facility_id = f.facility_id AND a.report_month = f.report_month + INTERVAL 3 MONTH
  WHERE f.suppression_pct_roll3_mean IS NOT NULL
  GROUP BY 1)"""
    ),
)
def x3_live_mae_against_baseline(spark, sf_dir):
    """X3 with the carry-forward baseline beside the forecast (the trailing
    mean), and an alert where the forecast is the worse of the two."""
    from panelops.operators.monitoring import live_mae_against_baseline

    i = Inputs(spark, sf_dir)
    rows = features.forecast_features(i.clean, i.facilities)
    return live_mae_against_baseline(rows, i.clean, "suppression_pct_roll3_mean", "suppression_pct")


@query(
    "s15_upsert_scored_rule",
    _sql("""
SELECT facility_id, report_month, is_anomaly, anomaly_score,
       forecast_next_quarter_suppression_pct, 'run-B' AS run_id,
       CASE WHEN report_month < DATE '1999-01-01' THEN TIMESTAMP '2024-01-01 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS scored_at
FROM sc"""),
)
def s15_upsert_scored_rule(spark, sf_dir):
    """Run-A stored the months before 1999; run-B scores everything.
    Rows are overwritten, ``scored_at`` keeps its first value."""
    s = cut_lineage(rule_scored(Inputs(spark, sf_dir)).drop("anomaly_reasons"), "scored")
    stored = up.stamp_lineage(
        s.where(F.col(PERIOD) < F.lit("1999-01-01").cast("date")), "run-A", "1998-12-31",
        ingested_at="2024-01-01 00:00:00", ts_col="scored_at",
    )
    new = up.stamp_lineage(s, "run-B", "2001-12-31", ingested_at="2024-02-01 00:00:00",
                           ts_col="scored_at")
    return up.upsert(stored, new, preserve=("scored_at",)).select(
        *KEY, "is_anomaly", "anomaly_score", scoring.FORECAST_COL, "run_id", "scored_at"
    )


# --- a forest of two literal trees ------------------------------------------------
# tree_id, node_id, feature (index into _Z, -1: leaf), threshold, left, right, size, depth
_FOREST = [
    (0, 0, 0, 1.0, 1, 2, 8, 0),
    (0, 1, 1, -0.5, 3, 4, 6, 1),
    (0, 2, -1, 0.0, -1, -1, 2, 1),
    (0, 3, -1, 0.0, -1, -1, 1, 2),
    (0, 4, -1, 0.0, -1, -1, 5, 2),
    (1, 0, 3, 0.75, 1, 2, 8, 0),
    (1, 1, -1, 0.0, -1, -1, 7, 1),
    (1, 2, -1, 0.0, -1, -1, 1, 1),
]
_C = "(2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n}::DOUBLE)"


_SCORE_SQL = f"""pow(2, -(CASE WHEN z_patients_tested <= 1 THEN
                        CASE WHEN z_suppression_pct <= -0.5 THEN 2 ELSE 2 + {_C.format(n=5)} END
                      ELSE 2 END
                    + CASE WHEN z_reporting_delay_days <= 0.75 THEN 1 + {_C.format(n=7)} ELSE 1 END)
                  / 2 / {_C.format(n=8)})"""


@query(
    "d2_literal_forest",
    with_base(f"""
SELECT facility_id, report_month, round(s - 0.5, 6) AS anomaly_score, round(s, 9) > 0.5 AS is_anomaly
FROM (SELECT *, {_SCORE_SQL} AS s FROM zs WHERE history_count >= 2)"""),
)
def d2_literal_forest(spark, sf_dir):
    model = _literal_forest()
    f = features.with_enough_history(Inputs(spark, sf_dir).anomaly_features).select(*KEY, *_Z)
    return iforest.decision(f, model).select(
        *KEY, r6("anomaly_score").alias("anomaly_score"), "is_anomaly"
    )


# --- two literal regression trees -------------------------------------------------
# tree_id, node_id, value, cover, left, right, feature, threshold, weight
_TREES = [
    (0, 0, 0.0, 10.0, 1, 2, 0, 80.0, 1.0),
    (0, 1, -3.0, 4.0, -1, -1, -1, None, 1.0),
    (0, 2, 0.0, 6.0, 3, 4, 2, 82.0, 1.0),
    (0, 3, 1.0, 2.0, -1, -1, -1, None, 1.0),
    (0, 4, 5.0, 4.0, -1, -1, -1, None, 1.0),
    (1, 0, 0.0, 10.0, 1, 2, 9, 6.0, 0.5),
    (1, 1, 2.0, 5.0, -1, -1, -1, None, 0.5),
    (1, 2, -1.0, 5.0, -1, -1, -1, None, 0.5),
]
OFFSET = 70.0
# Expectations of tree 0 given neither split, the first, the second, or both.
_SHAP_SQL = """
  SELECT *, (f_a - f_0 + f_ab - f_b) / 2 AS phi_now, (f_b - f_0 + f_ab - f_a) / 2 AS phi_lag,
         phi_month_raw AS phi_month, 70 + f_0 + 0.25 AS shap_base,
         70 + f_ab + 0.25 + phi_month_raw AS total
  FROM (
    SELECT *, (4 * -3.0 + 2 * 1.0 + 4 * 5.0) / 10 AS f_0,
           CASE WHEN suppression_pct <= 80 THEN -3.0 ELSE (2 * 1.0 + 4 * 5.0) / 6 END AS f_a,
           0.4 * -3.0 + 0.6 * CASE WHEN suppression_pct_lag_1 <= 82 THEN 1.0 ELSE 5.0 END AS f_b,
           CASE WHEN suppression_pct <= 80 THEN -3.0
                WHEN suppression_pct_lag_1 <= 82 THEN 1.0 ELSE 5.0 END AS f_ab,
           0.5 * CASE WHEN month_of_year <= 6 THEN 2.0 ELSE -1.0 END - 0.25 AS phi_month_raw
    FROM (SELECT facility_id, report_month, suppression_pct::DOUBLE AS suppression_pct,
                 suppression_pct_lag_1, month_of_year FROM ds))"""


def _literal_shap(spark, sf_dir):
    names = ["tree_id", "node_id", "value", "cover", "left", "right", "feature", "threshold", "weight"]
    return treeshap.explain(
        Inputs(spark, sf_dir).dataset, pd.DataFrame(_TREES, columns=names),
        list(FORECAST_FEATURES), OFFSET,
    )


@query(
    "d10_literal_shap",
    with_base(
        "SELECT facility_id, report_month, round(phi_now::DOUBLE, 6) AS phi_now, "
        "round(phi_lag::DOUBLE, 6) AS phi_lag, round(phi_month::DOUBLE, 6) AS phi_month, "
        "round(shap_base::DOUBLE, 6) AS shap_base, round(total::DOUBLE, 6) AS total FROM shap",
        {"shap": _SHAP_SQL},
    ),
)
def d10_literal_shap(spark, sf_dir):
    at = FORECAST_FEATURES.index
    total = F.aggregate("shap", F.lit(0.0), lambda acc, v: acc + v) + F.col("shap_base")
    return _literal_shap(spark, sf_dir).select(
        *KEY,
        r6(F.get("shap", F.lit(at("suppression_pct")))).alias("phi_now"),
        r6(F.get("shap", F.lit(at("suppression_pct_lag_1")))).alias("phi_lag"),
        r6(F.get("shap", F.lit(at("month_of_year")))).alias("phi_month"),
        r6("shap_base").alias("shap_base"), r6(total).alias("total"),
    )


_IMPORTANCE_SQL = """
SELECT feature, round(m::DOUBLE, 4) AS mean_abs_shap FROM (
  SELECT 'suppression_pct' AS feature, avg(abs(phi_now)) AS m FROM shap
  UNION ALL SELECT 'suppression_pct_lag_1', avg(abs(phi_lag)) FROM shap
  UNION ALL SELECT 'month_of_year', avg(abs(phi_month)) FROM shap
  UNION ALL SELECT unnest([{others}]), 0.0 WHERE EXISTS (SELECT 1 FROM shap))"""
_OTHERS = ", ".join(
    f"'{c}'" for c in FORECAST_FEATURES
    if c not in ("suppression_pct", "suppression_pct_lag_1", "month_of_year")
)


@query(
    "a15_literal_importance",
    with_base(_IMPORTANCE_SQL.format(others=_OTHERS), {"shap": _SHAP_SQL}),
)
def a15_literal_importance(spark, sf_dir):
    return treeshap.mean_abs_shap(_literal_shap(spark, sf_dir), list(FORECAST_FEATURES))


@query(
    "k4_literal_top_features",
    with_base(
        "SELECT * FROM (" + _IMPORTANCE_SQL.format(others=_OTHERS)
        + ") ORDER BY mean_abs_shap DESC, feature LIMIT 5",
        {"shap": _SHAP_SQL},
    ),
)
def k4_literal_top_features(spark, sf_dir):
    return treeshap.top_features(
        treeshap.mean_abs_shap(_literal_shap(spark, sf_dir), list(FORECAST_FEATURES))
    )


@query(
    "a14_improvement_trailing_mean",
    with_base("""
SELECT test_rows, round(m, 4) AS mae_model, round(n, 4) AS mae_naive_baseline,
       round(coalesce((n - m) * 100 / nullif(n, 0), 0), 2) AS improvement_over_baseline_pct
FROM (SELECT COUNT(*) AS test_rows,
             avg(abs(target_suppression_pct - suppression_pct_roll3_mean)) AS m,
             avg(abs(target_suppression_pct - suppression_pct)) AS n
      FROM ds WHERE report_month >= (SELECT cutoff FROM cut))"""),
)
def a14_improvement_trailing_mean(spark, sf_dir):
    """A14 with the trailing mean as the forecast."""
    _, test = features.time_split(Inputs(spark, sf_dir).dataset)
    return evaluate.forecast_metrics(
        test, features.TARGET_COL, "suppression_pct_roll3_mean", "suppression_pct"
    )


# --- two rounds of boosting, fitted -------------------------------------------------
_BOOST_FEATURES = ["suppression_pct", "suppression_pct_roll3_mean", "month_of_year"]
_BOOST_BINS = 16
_SIDE = "CASE {f} " + " ".join(
    f"WHEN {i} THEN {c}" for i, c in enumerate(_BOOST_FEATURES)
) + " END <= {cut}"


def _stump(name: str, rows: str) -> dict:
    """The split with the largest gain on ``left`` and its two leaf values."""
    return {
        name: f"""
  SELECT *, 0.1 * sl / nl AS low, 0.1 * (s - sl) / (n - nl) AS high FROM (
    SELECT e.f, e.cut, count(*) AS nl, sum(r.rest) AS sl, any_value(t.n) AS n, any_value(t.s) AS s
    FROM edges e JOIN long l ON l.f = e.f AND l.x <= e.cut
    JOIN {rows} r ON r.facility_id = l.facility_id AND r.report_month = l.report_month
    CROSS JOIN (SELECT count(*) AS n, sum(rest) AS s FROM {rows}) t
    GROUP BY e.f, e.cut)
  WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, f, cut LIMIT 1"""
    }


_BOOST = {
    "tr": """
  SELECT facility_id, report_month, target_suppression_pct::DOUBLE AS y,
         suppression_pct::DOUBLE AS suppression_pct, suppression_pct_roll3_mean, month_of_year
  FROM ds WHERE report_month < (SELECT cutoff FROM cut)""",
    "long": """
  SELECT facility_id, report_month, unnest([0, 1, 2]) AS f,
         unnest([suppression_pct, suppression_pct_roll3_mean, month_of_year::DOUBLE]) AS x FROM tr""",
    "edges": f"""
  SELECT DISTINCT f, x AS cut FROM (
    SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS rank,
           count(*) OVER (PARTITION BY f) AS n FROM long)
  WHERE list_contains(list_transform(range(1, {_BOOST_BINS}), lambda j: j * n // {_BOOST_BINS}), rank)""",
    "rest1": "SELECT *, y - (SELECT avg(y) FROM tr) AS rest FROM tr",
    **_stump("stump1", "rest1"),
    "rest2": "SELECT r.* REPLACE (rest - CASE WHEN "
    + _SIDE.format(f="t.f", cut="t.cut") + " THEN t.low ELSE t.high END AS rest) FROM rest1 r, stump1 t",
    **_stump("stump2", "rest2"),
}


@query(
    "d6_two_rounds",
    with_base(
        f"""
SELECT facility_id, report_month, round((SELECT avg(y) FROM tr)
  + CASE WHEN {_SIDE.format(f="a.f", cut="a.cut")} THEN a.low ELSE a.high END
  + CASE WHEN {_SIDE.format(f="b.f", cut="b.cut")} THEN b.low ELSE b.high END, 6) AS prediction
FROM ds, stump1 a, stump2 b WHERE report_month >= (SELECT cutoff FROM cut)""",
        _BOOST,
    ),
)
def d6_two_rounds(spark, sf_dir):
    """Two single-split trees fitted on the training months, their
    forecast of the held-out ones."""
    train, test = features.time_split(cut_lineage(Inputs(spark, sf_dir).dataset))
    model = fc.fit_forecaster(
        train, features.TARGET_COL, _BOOST_FEATURES, max_iter=2, max_depth=1, max_bins=_BOOST_BINS
    )
    return fc.predict(test, model).select(*KEY, r6("prediction").alias("prediction"))


# --- fitted models: what must hold of any fit --------------------------------------
_TRAIN = "SELECT count(*) AS n FROM zs WHERE history_count >= 2"


@query(
    "d1_forest_shape",
    with_base(
        f"""
SELECT tree_id::INTEGER AS tree_id, psi, true AS is_binary, true AS sizes_add_up,
       true AS depth_is_bounded
FROM (SELECT unnest(range(0, {IFOREST_TREES})) AS tree_id, least({IFOREST_MAX_SAMPLES}, n) AS psi
      FROM ({_TRAIN}))"""
    ),
)
def d1_forest_shape(spark, sf_dir):
    """D1, per fitted tree: it isolates psi rows, is binary, every split hands
    all its rows on, and no path is longer than allowed."""
    m = fitted(spark, sf_dir)
    nodes = spark.read.parquet(f"{m.forest_path}/nodes")
    psi = F.max(F.when(F.col("depth") == 0, F.col("size"))).cast("bigint")
    limit = F.ceil(F.log2(F.greatest(psi, F.lit(2))))
    inner = F.col("feature") >= 0
    children = F.sum(F.when(F.col("depth") > 0, F.col("size")).otherwise(0))
    return nodes.groupBy(F.col("tree_id").cast("int").alias("tree_id")).agg(
        psi.alias("psi"),
        (F.count(F.lit(1)) == 2 * F.count_if(~inner) - 1).alias("is_binary"),
        (children == F.sum(F.when(inner, F.col("size")).otherwise(0))).alias("sizes_add_up"),
        (F.max("depth") <= limit).alias("depth_is_bounded"),
    )


@query(
    "d3_threshold_share",
    with_base(
        f"SELECT n AS n_train, least({IFOREST_MAX_SAMPLES}, n) AS psi, "
        "n - 1 - floor((n - 1) * 0.95)::BIGINT AS n_above, true AS threshold_splits_there "
        f"FROM ({_TRAIN})"
    ),
)
def d3_threshold_share(spark, sf_dir):
    """D3: the threshold lies between the scores at the two ranks around the
    contamination quantile, so exactly the rows above it are flagged (fewer
    only where scores are tied there)."""
    m = fitted(spark, sf_dir)
    s = iforest.score_samples(m.train_a, m.iforest)
    t = F.lit(m.iforest.threshold)
    found = s.agg(
        F.count(F.lit(1)).alias("n_train"), F.count_if(F.col("_s") > t).alias("above"),
        F.count_if(F.col("_s") >= t).alias("from_on"),
    )
    n = F.col("n_train")
    expected = n - 1 - F.floor((n - 1) * F.lit(1 - m.iforest.contamination)).cast("bigint")
    return found.select(
        "n_train", F.lit(m.iforest.psi).cast("bigint").alias("psi"), expected.alias("n_above"),
        ((F.col("above") <= expected) & (F.col("from_on") >= expected)).alias(
            "threshold_splits_there"
        ),
    )


@query(
    "d13_scored_keys",
    _sql("""
SELECT facility_id, report_month, forecast_next_quarter_suppression_pct IS NOT NULL AS has_forecast,
       true AS flag_follows_score, true AS reasons_follow_flag, true AS forecast_is_percent FROM sc"""),
)
def d13_scored_keys(spark, sf_dir):
    """D13 with the fitted models: which rows are scored and forecast, and
    what must hold of each."""
    m = fitted(spark, sf_dir)
    s = scoring.score_all(m.clean, m.facilities, m.iforest, m.forecast)
    forecast = F.col(scoring.FORECAST_COL)
    explained = F.size(F.coalesce("anomaly_reasons", F.array())) > 0
    return s.select(
        *KEY, forecast.isNotNull().alias("has_forecast"),
        (F.col("is_anomaly") == (F.col("anomaly_score") > 0)).alias("flag_follows_score"),
        (F.col("is_anomaly") | ~explained).alias("reasons_follow_flag"),
        F.coalesce(forecast.between(0, 100), F.lit(True)).alias("forecast_is_percent"),
    )


def _literal_forest() -> iforest.IForestModel:
    names = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]
    return iforest.IForestModel(
        _Z, psi=8, n_trees=2, seed=0, contamination=0.05, threshold=0.5,
        nodes=pd.DataFrame(_FOREST, columns=names),
    )


def _literal_forecaster() -> fc.ForecastModel:
    """70, and 2.5 more where the month's suppression is above 80 percent."""
    tree = boosting.Tree(feature=[0, -1, -1], cut=[0, -1, -1], left=[1, -1, -1], value=[0, 0, 5],
                         cover=[10, 4, 6])
    return fc.ForecastModel(
        boosting.Boosted([[80.0]], [tree], base=140, shift=1, n=10), ["suppression_pct"]
    )


@query(
    "p6_point_scores_rule",
    with_base(
        f"""
SELECT facility_id AS entity_id, report_month,
       CASE WHEN history_count < 2 THEN 'insufficient_history' ELSE 'ok' END AS status,
       CASE WHEN history_count >= 2 THEN round(s, 9) > 0.5 END AS is_anomaly,
       CASE WHEN history_count >= 2 THEN round(s - 0.5, 6) END AS anomaly_score,
       CASE WHEN history_count >= 2 AND complete
            THEN CASE WHEN suppression_pct <= 80 THEN 70.0 ELSE 72.5 END::DOUBLE END AS forecast
FROM (
  SELECT z.*, {_SCORE_SQL} AS s,
         EXISTS (SELECT 1 FROM ff f WHERE f.facility_id = z.facility_id
                 AND f.report_month = z.report_month AND {_LAGS}) AS complete
  FROM zs z
  WHERE z.report_month = (SELECT max(report_month) FROM clean c WHERE c.facility_id = z.facility_id)
    AND z.facility_id IN (SELECT min(facility_id) FROM clean
                          UNION ALL SELECT max(facility_id) FROM clean))
UNION ALL SELECT 'S-unknown', NULL, 'not_found', NULL, NULL, NULL"""
    ),
)
def p6_point_scores_rule(spark, sf_dir):
    """P6, J10 and B10 on literal models: the first and the last entity of the
    clean table and an id that does not occur."""
    i = Inputs(spark, sf_dir)
    clean = cut_lineage(i.clean)
    ends = clean.agg(F.min(ENTITY), F.max(ENTITY)).first()
    out = None
    for entity in [*ends, "S-unknown"]:
        one = scoring.score_entity(
            clean, i.facilities, entity, _literal_forest(), _literal_forecaster(), "1", "1"
        ).select(
            "entity_id", PERIOD, "status", "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
            r6(scoring.FORECAST_COL).alias("forecast"),
        )
        out = one if out is None else out.unionByName(one)
    return out
