"""Table schemas and the fixed values the results depend on.

Operators take ``entity`` / ``period`` column names as parameters; the
defaults below name the reporting-panel columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY = "facility_id"
PERIOD = "report_month"
KEY = [ENTITY, PERIOD]

MEASURES = ["patients_tested", "suppression_pct", "drug_stock_level", "reporting_delay_days"]

# --- Fixed values (must equal the reference's for equal results) -----------
# Range rules, inclusive bounds, None = open end; checked in this order.
RANGE_RULES = {
    "patients_tested": (0, None),
    "suppression_pct": (0, 100),
    "drug_stock_level": (0, 100),
    "reporting_delay_days": (0, None),
}
# Robust outlier guardrail: |x - median| / (MAD * 1.4826) > 5.0 on these fields.
OUTLIER_Z_THRESHOLD = 5.0
MAD_SCALE = 1.4826
OUTLIER_FIELDS = ["patients_tested", "suppression_pct", "drug_stock_level"]
# Quarantine reasons, in priority order (first violation wins).
REASON_UNKNOWN = "unknown_facility_id"
REASON_DUPLICATE = "duplicate_facility_month"
REASON_OUTLIER = "statistical_outlier"
# Alert when the unrounded quarantine rate is strictly above this.
QUARANTINE_ALERT_RATE = 0.10
GAP_SAMPLE_SIZE = 20
# Anomaly features and reasons.
ANOMALY_FIELDS = ["patients_tested", "suppression_pct", "drug_stock_level", "reporting_delay_days"]
MIN_HISTORY_MONTHS = 2
Z_REASON_THRESHOLD = 2.0
CONTAMINATION = 0.05
IFOREST_TREES = 200
IFOREST_MAX_SAMPLES = 256
SEED = 42
# Forecast.
FORECAST_TARGET = "suppression_pct"
FORECAST_HORIZON_MONTHS = 3
FORECAST_LAGS = [1, 2, 3]
TEST_MONTHS = 4
GBT_TREES = 150
GBT_DEPTH = 3
GBT_STEP = 0.1
TOP_FEATURES = 5
FORECAST_FEATURES = [
    "suppression_pct",
    "patients_tested",
    "suppression_pct_lag_1",
    "suppression_pct_lag_2",
    "suppression_pct_lag_3",
    "patients_tested_lag_1",
    "patients_tested_lag_2",
    "patients_tested_lag_3",
    "suppression_pct_roll3_mean",
    "month_of_year",
    "baseline_patient_volume",
]
# Plain-language labels for the "why flagged" sentence.
FIELD_LABELS = {
    "patients_tested": "patients tested",
    "suppression_pct": "viral load suppression rate",
    "drug_stock_level": "drug stock level",
    "reporting_delay_days": "reporting delay",
}
# One sentence per reason: "**<label>** was much higher than usual for this clinic",
# joined with "; " and closed with ".".
REASON_SENTENCE = "**{label}** was {direction} than usual for this clinic"
DIRECTION_WORDS = {"high": "much higher", "low": "much lower"}
FALLBACK_SENTENCE = (
    "Flagged by the model, but no single indicator crossed the plain-language threshold."
)
# ---------------------------------------------------------------------------

# Registry model names (ours; any names work).
ANOMALY_MODEL_NAME = "panel-anomaly-detector"
FORECAST_MODEL_NAME = "panel-forecaster"

RAW_REPORT = T.StructType(
    [
        T.StructField(ENTITY, T.StringType(), False),
        T.StructField(PERIOD, T.DateType(), False),
        T.StructField("patients_tested", T.LongType(), True),
        T.StructField("suppression_pct", T.DoubleType(), True),
        T.StructField("drug_stock_level", T.DoubleType(), True),
        T.StructField("reporting_delay_days", T.IntegerType(), True),
    ]
)

FACILITIES = T.StructType(
    [
        T.StructField(ENTITY, T.StringType(), False),
        T.StructField("facility_name", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("ownership_type", T.StringType(), True),
        T.StructField("baseline_patient_volume", T.IntegerType(), True),
        T.StructField("opened_date", T.DateType(), True),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField(ENTITY, T.StringType(), False),
        T.StructField(PERIOD, T.DateType(), False),
        T.StructField("issue_type", T.StringType(), False),
        T.StructField("is_anomaly_candidate", T.BooleanType(), False),
        T.StructField("detail", T.StringType(), True),
    ]
)

LINEAGE = ["run_id", "dag_logical_date"]

REASON_STRUCT = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("direction", T.StringType()),
    ]
)
REASONS = T.ArrayType(REASON_STRUCT)
