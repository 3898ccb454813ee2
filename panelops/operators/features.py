"""Per-entity features on the clean panel (W1-W4, J1, B7, B8) and the
time-based split (D9).

Window note: the clean table's key is unique, so an entity's window
partition holds at most one row per period (bounded by the calendar, not by
data volume). All window columns share one ``(entity) ORDER BY period``
spec, so Spark plans a single shuffle and a single sort for W1-W4 together.
Whole-partition aggregates use the explicit unbounded row frame to stay in
that same window group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.schemas import (
    ANOMALY_FIELDS,
    ENTITY,
    FORECAST_FEATURES,
    FORECAST_HORIZON_MONTHS,
    FORECAST_LAGS,
    FORECAST_TARGET,
    MIN_HISTORY_MONTHS,
    PERIOD,
    TEST_MONTHS,
)

TARGET_COL = f"target_{FORECAST_TARGET}"


def _ordered(entity: str, period: str):
    return Window.partitionBy(entity).orderBy(period)


def _whole(entity: str, period: str):
    return _ordered(entity, period).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def zscore(field: str, w) -> Column:
    """(x - mean) / sample std over the whole entity history; a single
    row (std NULL) or a constant series (std 0) gives 0.0."""
    x = F.col(field).cast("double")
    return F.coalesce((x - F.avg(x).over(w)) / F.nullif(F.stddev_samp(x).over(w), F.lit(0.0)),
                      F.lit(0.0))


def anomaly_features(
    df: DataFrame,
    fields=ANOMALY_FIELDS,
    entity: str = ENTITY,
    period: str = PERIOD,
    min_history: int = MIN_HISTORY_MONTHS,
) -> DataFrame:
    """Adds ``z_<field>``, ``history_count`` and ``insufficient_history``."""
    w = _whole(entity, period)
    return df.select(
        "*",
        *[zscore(f, w).alias(f"z_{f}") for f in fields],
        F.count(F.lit(1)).over(w).alias("history_count"),
    ).withColumn("insufficient_history", F.col("history_count") < F.lit(min_history))


def with_enough_history(features: DataFrame) -> DataFrame:
    """Rows whose entity has at least the minimum history."""
    return features.where(~F.col("insufficient_history"))


def trailing_mean(field: str, n: int, w) -> Column:
    """Mean of the ``n`` rows before the current one, NULL unless all
    ``n`` exist and are non-null."""
    f = w.rowsBetween(-n, -1)
    return F.when(F.count(F.col(field)).over(f) == n, F.avg(F.col(field).cast("double")).over(f))


def forecast_features(
    df: DataFrame,
    facilities: DataFrame,
    entity: str = ENTITY,
    period: str = PERIOD,
    calendar: bool = False,
) -> DataFrame:
    """J1 + month_of_year + W2 lags + W3 lead target + W4 rolling mean.

    ``calendar=False`` (default) shifts by rows, like the reference: a
    missing month is skipped over. ``calendar=True`` takes the value of the
    row exactly n months away (NULL if that month is absent).
    """
    fac = facilities.select(entity, "baseline_patient_volume", "region")
    base = df.join(fac, entity, "inner").withColumn("month_of_year", F.month(period))
    w = _ordered(entity, period)
    if calendar:
        lag = _calendar_shift(entity, period)
    else:
        def lag(c, n):
            return F.lag(c, n).over(w) if n > 0 else F.lead(c, -n).over(w)
    cols = []
    for n in FORECAST_LAGS:
        cols.append(lag(FORECAST_TARGET, n).alias(f"{FORECAST_TARGET}_lag_{n}"))
    for n in FORECAST_LAGS:
        cols.append(lag("patients_tested", n).alias(f"patients_tested_lag_{n}"))
    if calendar:
        prev = [lag(FORECAST_TARGET, n) for n in (1, 2, 3)]
        roll = F.when(
            prev[0].isNotNull() & prev[1].isNotNull() & prev[2].isNotNull(),
            (prev[0] + prev[1] + prev[2]) / F.lit(3.0),
        )
    else:
        roll = trailing_mean(FORECAST_TARGET, 3, w)
    cols.append(roll.alias(f"{FORECAST_TARGET}_roll3_mean"))
    cols.append(lag(FORECAST_TARGET, -FORECAST_HORIZON_MONTHS).alias(TARGET_COL))
    return base.select("*", *cols)


def _calendar_shift(entity: str, period: str):
    """Value of the row exactly ``n`` months earlier (negative n: later),
    found by a range frame on a month index within the entity."""
    idx = (F.year(period) * 12 + F.month(period)).cast("bigint")

    def shift(c: str, n: int) -> Column:
        wr = Window.partitionBy(entity).orderBy(idx).rangeBetween(-n, -n)
        return F.first(F.col(c)).over(wr)

    return shift


def forecast_dataset(
    df: DataFrame,
    facilities: DataFrame,
    require_target: bool = True,
    entity: str = ENTITY,
    period: str = PERIOD,
    calendar: bool = False,
) -> DataFrame:
    """Forecast rows with every feature (and the target if required)."""
    required = list(FORECAST_FEATURES) + ([TARGET_COL] if require_target else [])
    return forecast_features(df, facilities, entity, period, calendar).dropna(subset=required)


def cutoff_month(dataset: DataFrame, test_months: int = TEST_MONTHS, period: str = PERIOD):
    """K2: the ``test_months``-th most recent distinct month, as a scalar
    subquery column; raises at run time when fewer months exist."""
    recent = dataset.select(period).distinct().orderBy(F.desc(period)).limit(test_months)
    return recent.agg(
        F.when(
            F.count(F.lit(1)) < test_months,
            F.raise_error(F.lit(f"time split needs at least {test_months} distinct months")),
        ).otherwise(F.min(period))
    ).scalar()


def time_split(
    dataset: DataFrame,
    test_months: int = TEST_MONTHS,
    period: str = PERIOD,
    embargo_months: int = 0,
):
    """(train, test). Train rows precede the cutoff (optionally by an
    embargo of whole months), test rows are at or after it."""
    cut = cutoff_month(dataset, test_months, period)
    train_limit = F.add_months(cut, -embargo_months) if embargo_months else cut
    return dataset.where(F.col(period) < train_limit), dataset.where(F.col(period) >= cut)


def naive_mae(test: DataFrame, target: str = TARGET_COL, current: str = FORECAST_TARGET):
    """MAE of carry-forward (predict the current value)."""
    return test.agg(F.avg(F.abs(F.col(target) - F.col(current))).alias("mae_naive_baseline"))
