"""Model-backed queries (D1-D13, A13-A16, P6-P9, X2) and a SQL-checkable
evaluation of a fixed z-rule detector (D5).

The isolation forest and the GBT are fitted from the given tables inside
the query (deterministic: hash sampling, fixed seeds). Fitted models are
memoised per session and input folder so several queries of one run share
one fit; they are not reproducible by SQL, so these are rows-only checks.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F

from panelops.functions.reasons import build_reasons, reasons_to_sentence
from panelops.models import forecast as fc
from panelops.models import iforest, treeshap
from panelops.operators import evaluate, features, scoring
from panelops.operators.monitoring import anomaly_rate_drift
from panelops.plans import views
from panelops.plans.inputs import Inputs
from panelops.plans.oracle import with_base
from panelops.plans.registry import query, r6
from panelops.schemas import ANOMALY_FIELDS, ENTITY, FORECAST_FEATURES, KEY, PERIOD
from panelops.session import cut_lineage, ensure_checkpoint_dir

_Z = [f"z_{f}" for f in ANOMALY_FIELDS]
_FITTED: dict = {}


class Fitted:
    """Models fitted on one input folder (each when it is first needed) and
    the frames they share."""

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        self.inputs = Inputs(spark, sf_dir)

    @cached_property
    def clean(self):
        return cut_lineage(self.inputs.clean)

    @property
    def facilities(self):
        return self.inputs.facilities

    @cached_property
    def train_a(self):
        feats = features.anomaly_features(self.clean)
        return cut_lineage(features.with_enough_history(feats).select(*KEY, *_Z))

    @cached_property
    def iforest(self):
        return iforest.fit_iforest(self.train_a, _Z, KEY)

    @cached_property
    def forest_path(self) -> str:
        """Where the fitted forest is written (the shared checkpoint folder)."""
        path = self._new_path()
        iforest.save(self.iforest, self.spark, path)
        return path

    @cached_property
    def split(self):
        ds = cut_lineage(features.forecast_dataset(self.clean, self.facilities))
        return features.time_split(ds)

    @property
    def test_f(self):
        return self.split[1]

    @cached_property
    def forecast(self):
        return fc.fit_forecaster(self.split[0], features.TARGET_COL)

    @cached_property
    def nodes(self):
        return fc.tree_nodes(self.forecast)

    def _new_path(self) -> str:
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/panelops-model-{uuid.uuid4().hex}"


def fitted(spark, sf_dir: str) -> Fitted:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = Fitted(spark, sf_dir)
    return _FITTED[key]


def _scored(m: Fitted):
    return iforest.decision(m.train_a, m.iforest)


@query("d1_iforest_nodes")
def d1_iforest_nodes(spark, sf_dir):
    """The node table of the fitted forest, read back from where it was written."""
    return spark.read.parquet(f"{fitted(spark, sf_dir).forest_path}/nodes")


@query("d2_anomaly_scores")
def d2_anomaly_scores(spark, sf_dir):
    s = _scored(fitted(spark, sf_dir))
    return s.select(*KEY, "is_anomaly", r6("anomaly_score").alias("anomaly_score"))


@query("d3_contamination_threshold")
def d3_contamination_threshold(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return _scored(m).agg(
        F.lit(m.iforest.threshold).alias("threshold"),
        F.lit(m.iforest.psi).alias("psi"),
        F.count(F.lit(1)).alias("n_train"),
        F.round(F.avg(F.col("is_anomaly").cast("double")), 6).alias("flagged_share"),
    )


@query("d5_evaluate_iforest")
def d5_evaluate_iforest(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return evaluate.evaluate_against_ground_truth(_scored(m), m.inputs.ledger)


_ZRULE = " OR ".join(f"abs({z}) > 3" for z in _Z)


@query(
    "d5_evaluate_zrule",
    with_base(
        f"""
SELECT (SELECT COUNT(*) FROM candidates) AS total_candidates_injected,
       (SELECT COUNT(*) FROM candidates) - present AS candidates_removed_upstream_by_validation,
       present AS candidates_present_in_monthly_reports,
       tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(fp / nullif(fp + tn, 0), 0), 4) AS false_positive_rate
FROM (
  SELECT COUNT(*) FILTER (WHERE c) AS present,
         COUNT(*) FILTER (WHERE c AND a) AS tp, COUNT(*) FILTER (WHERE NOT c AND a) AS fp,
         COUNT(*) FILTER (WHERE c AND NOT a) AS fn, COUNT(*) FILTER (WHERE NOT c AND NOT a) AS tn
  FROM (
    SELECT (k.facility_id IS NOT NULL) AS c, ({_ZRULE}) AS a
    FROM zs z LEFT JOIN candidates k
      ON z.facility_id = k.facility_id AND z.report_month = k.report_month
    WHERE z.history_count >= 2))"""
    ),
)
def d5_evaluate_zrule(spark, sf_dir):
    """D5 on a fixed rule (any |z| > 3) so the evaluation query itself is
    checked against SQL."""
    i = Inputs(spark, sf_dir)
    f = features.with_enough_history(i.anomaly_features)
    flag = F.lit(False)
    for z in _Z:
        flag = flag | (F.abs(F.col(z)) > F.lit(3.0))
    return evaluate.evaluate_against_ground_truth(f.withColumn("is_anomaly", flag), i.ledger)


@query("d6_d7_forecast_predictions")
def d6_d7_forecast_predictions(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return fc.predict(m.test_f, m.forecast).select(
        *KEY, r6(features.TARGET_COL).alias(features.TARGET_COL),
        r6("prediction").alias("predicted_suppression_pct"),
    )


@query("a13_a14_forecast_metrics")
def a13_a14_forecast_metrics(spark, sf_dir):
    m = fitted(spark, sf_dir)
    pred = fc.predict(m.test_f, m.forecast)
    return evaluate.forecast_metrics(pred, features.TARGET_COL, "prediction", "suppression_pct")


def _explained(m: Fitted):
    pred = fc.predict(m.test_f, m.forecast)
    return treeshap.explain(pred, m.nodes, m.forecast.feature_cols, m.forecast.label_mean)


@query("d10_shap_values")
def d10_shap_values(spark, sf_dir):
    """Per test row: attributions, base value, and the additivity residual
    (sum of attributions + base - prediction, ~1e-12)."""
    ex = _explained(fitted(spark, sf_dir))
    total = F.aggregate("shap", F.lit(0.0), lambda acc, v: acc + v)
    return ex.select(
        *KEY,
        F.transform("shap", lambda v: F.round(v, 6)).alias("shap"),
        r6("shap_base").alias("shap_base"),
        r6("prediction").alias("prediction"),
        r6(total + F.col("shap_base") - F.col("prediction")).alias("additivity_residual"),
    )


@query("a15_shap_importance")
def a15_shap_importance(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return treeshap.mean_abs_shap(_explained(m), m.forecast.feature_cols)


@query("k4_top_features")
def k4_top_features(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return treeshap.top_features(treeshap.mean_abs_shap(_explained(m), m.forecast.feature_cols))


def _score_all(m: Fitted, va="1", vf="1"):
    s = scoring.score_all(m.clean, m.facilities, m.iforest, m.forecast)
    return s.withColumn("model_version_anomaly", F.lit(va)).withColumn(
        "model_version_forecast", F.lit(vf)
    )


@query("d13_score_all")
def d13_score_all(spark, sf_dir):
    s = _score_all(fitted(spark, sf_dir))
    return s.select(
        *KEY, "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
        F.to_json("anomaly_reasons").alias("anomaly_reasons"),
        r6(scoring.FORECAST_COL).alias(scoring.FORECAST_COL),
    )


@query("a16_score_summary")
def a16_score_summary(spark, sf_dir):
    s = _score_all(fitted(spark, sf_dir))
    return s.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if("is_anomaly").alias("n_flagged_anomaly"),
        F.count(scoring.FORECAST_COL).alias("n_forecasted"),
    )


def _latest_month(m: Fitted):
    return m.clean.agg(F.max(PERIOD)).first()[0]


@query("p7_month_board")
def p7_month_board(spark, sf_dir):
    m = fitted(spark, sf_dir)
    b = views.month_board(_score_all(m), m.facilities, m.clean, str(_latest_month(m)))
    return b.select(
        *[c for c in b.columns if c != "anomaly_reasons"],
    )


@query("k3_flagged_this_month")
def k3_flagged_this_month(spark, sf_dir):
    m = fitted(spark, sf_dir)
    b = views.month_board(_score_all(m), m.facilities, m.clean, str(_latest_month(m)))
    return views.flagged(b).select(ENTITY, "facility_name", "region", "anomaly_score", "why_flagged")


@query("p8_kpis")
def p8_kpis(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return views.kpis(views.month_board(_score_all(m), m.facilities, m.clean, str(_latest_month(m))))


@query("p8_all_entities_table")
def p8_all_entities_table(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return views.all_entities(
        views.month_board(_score_all(m), m.facilities, m.clean, str(_latest_month(m)))
    )


@query("p9_versions_in_use")
def p9_versions_in_use(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return views.versions_in_use(
        views.month_board(_score_all(m), m.facilities, m.clean, str(_latest_month(m)))
    )


@query(
    "s8_available_months",
    with_base("SELECT DISTINCT report_month FROM zs WHERE history_count >= 2"),
)
def s8_available_months(spark, sf_dir):
    """Months of the scored table, newest first. Every clean row of an entity
    with enough history is scored, so the month set does not depend on the
    models and is checked against SQL."""
    return views.available_months(_score_all(fitted(spark, sf_dir)))


@query("p6_score_entity")
def p6_score_entity(spark, sf_dir):
    """Point scoring of the roster's first entity (the operator is a point
    lookup by design), plus an id that is not on the roster."""
    m = fitted(spark, sf_dir)
    first = m.facilities.agg(F.min(ENTITY)).first()[0]
    a = scoring.score_entity(m.clean, m.facilities, first, m.iforest, m.forecast, "1", "1")
    b = scoring.score_entity(m.clean, m.facilities, "S-unknown", m.iforest, m.forecast, "1", "1")
    return a.unionByName(b).select(
        "entity_id", PERIOD, "status", "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
        F.to_json("anomaly_reasons").alias("anomaly_reasons"),
        r6(scoring.FORECAST_COL).alias(scoring.FORECAST_COL),
    )


@query("x2_anomaly_rate_drift")
def x2_anomaly_rate_drift(spark, sf_dir):
    return anomaly_rate_drift(_scored(fitted(spark, sf_dir)))


@query("f13_model_reasons")
def f13_model_reasons(spark, sf_dir):
    """Reasons and sentences on the rows the model flagged."""
    m = fitted(spark, sf_dir)
    s = _scored(m).where("is_anomaly")
    r = s.select(*KEY, build_reasons(F.col("is_anomaly")).alias("r"))
    return r.select(*KEY, F.to_json("r").alias("anomaly_reasons"),
                    reasons_to_sentence(F.col("r")).alias("why_flagged"))


@query("s15_upsert_scored")
def s15_upsert_scored(spark, sf_dir):
    """Run-A stored the scores of the months before 1999; run-B scores
    everything. Overwritten in place, ``scored_at`` keeps its first value,
    NaN forecasts become NULL."""
    from panelops.operators import upsert as up

    s = _score_all(fitted(spark, sf_dir)).select(
        *KEY, "is_anomaly", "anomaly_score", "anomaly_reasons",
        up.nan_to_null(scoring.FORECAST_COL), "model_version_anomaly", "model_version_forecast",
    )
    stored = up.stamp_lineage(
        s.where(F.col(PERIOD) < F.lit("1999-01-01").cast("date")), "run-A", "1998-12-31",
        ingested_at="2024-01-01 00:00:00", ts_col="scored_at",
    )
    new = up.stamp_lineage(s, "run-B", "2001-12-31", ingested_at="2024-02-01 00:00:00",
                           ts_col="scored_at")
    out = up.upsert(stored, new, preserve=("scored_at",))
    return out.select(
        *KEY, "is_anomaly", r6("anomaly_score").alias("anomaly_score"),
        F.to_json("anomaly_reasons").alias("anomaly_reasons"),
        r6(scoring.FORECAST_COL).alias(scoring.FORECAST_COL), "run_id", "scored_at",
    )


_REQ_FEATURES = " AND ".join(f"f.{c} IS NOT NULL" for c in FORECAST_FEATURES)


@query(
    "a16_scoring_coverage",
    with_base(
        "SELECT COUNT(*) AS rows_scored, COUNT(f.facility_id) AS n_forecasted "
        "FROM zs z LEFT JOIN (SELECT * FROM ff f WHERE " + _REQ_FEATURES + ") f "
        "ON z.facility_id = f.facility_id AND z.report_month = f.report_month "
        "WHERE z.history_count >= 2"
    ),
)
def a16_scoring_coverage(spark, sf_dir):
    """The model-independent part of A16: rows scored (enough history) and
    rows that get a forecast (complete lag set), from the scoring plan
    itself."""
    s = _score_all(fitted(spark, sf_dir))
    return s.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count(scoring.FORECAST_COL).alias("n_forecasted"),
    )
