"""Model application on the clean panel (D2 + F13, D7 + J3 = D13, P6).

Scoring recomputes over the whole clean table, like the reference: a new
month shifts every z-score of its entity. Rows of entities with too little
history are absent from the output (not null-scored).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.functions.reasons import build_reasons
from panelops.models import forecast as fc
from panelops.models import iforest
from panelops.operators import features as feat
from panelops.schemas import ANOMALY_FIELDS, ENTITY, KEY, PERIOD

Z_COLS = [f"z_{f}" for f in ANOMALY_FIELDS]
FORECAST_COL = "forecast_next_quarter_suppression_pct"


def anomaly_scores(clean: DataFrame, model: iforest.IForestModel, keep_z: bool = False):
    """D2 + B7 + F13: key, is_anomaly, anomaly_score, anomaly_reasons."""
    f = feat.with_enough_history(feat.anomaly_features(clean))
    scored = iforest.decision(f.select(*KEY, *Z_COLS), model)
    out = scored.select(
        *KEY,
        "is_anomaly",
        "anomaly_score",
        build_reasons(F.col("is_anomaly")).alias("anomaly_reasons"),
        *(Z_COLS if keep_z else []),
    )
    return out


def forecasts(clean: DataFrame, facilities: DataFrame, model: fc.ForecastModel) -> DataFrame:
    """D7 on every row with complete lags (no target needed)."""
    rows = feat.forecast_dataset(clean, facilities, require_target=False)
    return fc.predict(rows, model, FORECAST_COL).select(*KEY, FORECAST_COL)


def score_all(
    clean: DataFrame,
    facilities: DataFrame,
    anomaly_model: iforest.IForestModel,
    forecast_model: fc.ForecastModel,
) -> DataFrame:
    """Anomaly scores left-joined with forecasts (NULL when a row has
    no complete lag set)."""
    return anomaly_scores(clean, anomaly_model).join(
        forecasts(clean, facilities, forecast_model), KEY, "left"
    )


def score_entity(
    clean: DataFrame,
    facilities: DataFrame,
    entity_id: str,
    anomaly_model: iforest.IForestModel,
    forecast_model: fc.ForecastModel,
    anomaly_version: str,
    forecast_version: str,
    entity: str = ENTITY,
) -> DataFrame:
    """One row for the entity's latest month with a ``status``:
    ``not_found`` (no rows), ``insufficient_history`` or ``ok``.

    The entity filter is pushed to the scan; z-scores are per entity, so
    filter-first gives the same values as scoring everything.
    """
    rows = clean.where(F.col(entity) == F.lit(entity_id))
    facilities = facilities.where(F.col(entity) == F.lit(entity_id))
    f = feat.anomaly_features(rows)
    latest = f.groupBy(entity).agg(F.max(PERIOD).alias(PERIOD))
    base = f.join(latest, [entity, PERIOD], "left_semi")
    scored = iforest.decision(base.select(*KEY, *Z_COLS, "insufficient_history"), anomaly_model)
    fcast = fc.predict(
        feat.forecast_dataset(rows, facilities, require_target=False), forecast_model, FORECAST_COL
    ).select(*KEY, FORECAST_COL)
    one = scored.join(fcast, KEY, "left").select(
        F.lit(entity_id).alias("entity_id"),
        F.col(PERIOD),
        F.when(F.col("insufficient_history"), F.lit("insufficient_history"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        F.when(~F.col("insufficient_history"), F.col("is_anomaly")).alias("is_anomaly"),
        F.when(~F.col("insufficient_history"), F.col("anomaly_score")).alias("anomaly_score"),
        F.when(
            ~F.col("insufficient_history"), build_reasons(F.col("is_anomaly"))
        ).alias("anomaly_reasons"),
        F.when(~F.col("insufficient_history"), F.col(FORECAST_COL)).alias(FORECAST_COL),
        F.lit(anomaly_version).alias("model_version_anomaly"),
        F.lit(forecast_version).alias("model_version_forecast"),
    )
    # Exactly one row: the scored one, or a not_found marker (one left join, so
    # the scoring is planned once).
    asked = one.sparkSession.range(1).select(F.lit(entity_id).alias("entity_id"))
    return asked.join(one, "entity_id", "left").withColumn(
        "status", F.coalesce("status", F.lit("not_found"))
    ).withColumns(
        {c: F.when(F.col("status") != "not_found", F.col(c))
         for c in ("model_version_anomaly", "model_version_forecast")}
    )
