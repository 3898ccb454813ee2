"""Validation report (A7-A9) and the quality alert.

The report is one row built from one aggregate over the classified batch;
the reason map and the gap sample are scalar subqueries (each a one-row
aggregate), so nothing is collected to the driver and no cross join is
needed to put the pieces side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.operators.checks import REASON
from panelops.schemas import ENTITY, GAP_SAMPLE_SIZE, PERIOD, QUARANTINE_ALERT_RATE


def reason_counts(classified: DataFrame) -> DataFrame:
    """Quarantined rows per reason."""
    return (
        classified.where(F.col(REASON).isNotNull())
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def quarantine_rate_col(total: str = "batch_size", quarantined: str = "quarantined_count"):
    """Unrounded rate, 0.0 for an empty batch."""
    return F.coalesce(
        F.try_divide(F.col(quarantined).cast("double"), F.nullif(F.col(total), F.lit(0))),
        F.lit(0.0),
    )


def report_counts(classified: DataFrame, gaps: DataFrame) -> DataFrame:
    """Scalar part of the report: counts, rounded rate, alert flag."""
    gap_count = gaps.agg(F.count(F.lit(1))).scalar()
    base = classified.agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.count_if(F.col(REASON).isNull()).alias("clean_count"),
        F.count_if(F.col(REASON).isNotNull()).alias("quarantined_count"),
    )
    rate = quarantine_rate_col()
    return base.select(
        "batch_size",
        "clean_count",
        "quarantined_count",
        F.round(rate, 4).alias("quarantine_rate"),
        gap_count.alias("completeness_gap_count"),
        (rate > F.lit(QUARANTINE_ALERT_RATE)).alias("alert_quarantine_rate_exceeded"),
    )


def gap_sample(gaps: DataFrame, n: int = GAP_SAMPLE_SIZE, keys=(ENTITY, PERIOD)) -> DataFrame:
    """K5: first ``n`` gaps by key (top-k, not a full sort)."""
    return gaps.orderBy(*keys).limit(n)


def validation_report(
    classified: DataFrame,
    gaps: DataFrame,
    run_id: str,
    dag_logical_date: str,
    keys=(ENTITY, PERIOD),
) -> DataFrame:
    """One-row report with the reason map and a 20-gap sample."""
    reasons = reason_counts(classified).agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col(REASON), F.col("n_rows"))))
        )
    )
    sample = gap_sample(gaps, keys=keys).agg(
        F.array_sort(
            F.collect_list(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))
        )
    )
    return report_counts(classified, gaps).select(
        F.lit(run_id).alias("run_id"),
        F.to_date(F.lit(dag_logical_date)).alias("dag_logical_date"),
        "batch_size",
        "clean_count",
        "quarantined_count",
        "quarantine_rate",
        F.coalesce(reasons.scalar(), F.create_map().cast("map<string,bigint>")).alias(
            "quarantine_reasons"
        ),
        "completeness_gap_count",
        F.coalesce(
            sample.scalar(),
            F.array().cast(f"array<struct<{keys[0]}:string,{keys[1]}:string>>"),
        ).alias("completeness_gaps_sample"),
        "alert_quarantine_rate_exceeded",
    )


def quality_alerts(report: DataFrame) -> DataFrame:
    """Report rows whose alert flag is set; the caller decides to raise."""
    return report.where(F.col("alert_quarantine_rate_exceeded"))
