"""Published views over the warehouse.

All are DataFrames; ordering is applied only where it is the feature (the
month list, the flagged list). The month filter is on the partition column
of both fact tables, so Spark prunes to one partition per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.functions.reasons import reasons_to_sentence
from panelops.schemas import ENTITY, KEY, PERIOD

DISPLAY_COLUMNS = {
    ENTITY: "Facility",
    "facility_name": "Name",
    "region": "Region",
    "is_anomaly": "Flagged",
    "suppression_pct": "Suppression %",
    "forecast_next_quarter_suppression_pct": "Forecast (next qtr)",
}


def available_months(scored: DataFrame) -> DataFrame:
    """Distinct scored months, newest first."""
    return scored.select(PERIOD).distinct().orderBy(F.desc(PERIOD))


def month_board(
    scored: DataFrame, facilities: DataFrame, clean: DataFrame, month: str
) -> DataFrame:
    """J4 + B11 + F11: one row per scored entity of ``month`` with names,
    measures, model versions and the plain-language sentence."""
    m = F.lit(month).cast("date")
    s = scored.where(F.col(PERIOD) == m)
    c = clean.where(F.col(PERIOD) == m).select(
        *KEY, "patients_tested", "suppression_pct", "drug_stock_level", "reporting_delay_days"
    )
    fac = facilities.select(ENTITY, "facility_name", "region")
    return (
        s.join(fac, ENTITY, "inner")
        .join(c, KEY, "inner")
        .select(
            ENTITY,
            PERIOD,
            F.date_format(PERIOD, "MMMM yyyy").alias("month_label"),
            "is_anomaly",
            "anomaly_score",
            "anomaly_reasons",
            "forecast_next_quarter_suppression_pct",
            "model_version_anomaly",
            "model_version_forecast",
            "facility_name",
            "region",
            "patients_tested",
            "suppression_pct",
            "drug_stock_level",
            "reporting_delay_days",
            F.when(F.col("is_anomaly"), reasons_to_sentence(F.col("anomaly_reasons"))).alias(
                "why_flagged"
            ),
        )
    )


def flagged(board: DataFrame) -> DataFrame:
    """B12 + K3: flagged rows, highest score first (ties by key)."""
    return board.where(F.col("is_anomaly")).orderBy(F.desc("anomaly_score"), ENTITY)


def kpis(board: DataFrame) -> DataFrame:
    """Reporting, flagged, flagged rate in % (NULL = n/a when empty)."""
    return board.agg(
        F.count(F.lit(1)).alias("reporting"),
        F.count_if(F.col("is_anomaly")).alias("flagged"),
    ).select(
        "reporting",
        "flagged",
        F.round(
            F.try_divide(F.col("flagged") * F.lit(100.0), F.nullif(F.col("reporting"), F.lit(0))), 1
        ).alias("flagged_pct"),
        F.when(
            F.col("reporting") > 0,
            F.format_string(
                "%.1f%%", F.try_divide(F.col("flagged") * F.lit(100.0), F.col("reporting"))
            ),
        )
        .otherwise(F.lit("n/a"))
        .alias("flagged_rate_label"),
    )


def all_entities(board: DataFrame) -> DataFrame:
    """The display table with renamed columns."""
    return board.select(*[F.col(c).alias(name) for c, name in DISPLAY_COLUMNS.items()])


def versions_in_use(board: DataFrame) -> DataFrame:
    """Distinct model-version pairs present in the month."""
    return board.select("model_version_anomaly", "model_version_forecast").distinct()
