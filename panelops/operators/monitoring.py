"""Monitoring extensions (X1-X3): trends over runs and live accuracy.

All three are window or join queries over tables the pipeline already
writes; none needs a driver loop.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelops.schemas import CONTAMINATION, ENTITY, PERIOD


def quarantine_rate_trend(
    reports: DataFrame,
    order_col: str = "dag_logical_date",
    spike_factor: float = 2.0,
    window: int = 3,
) -> DataFrame:
    """Per run, the quarantine rate, its change from the previous run and
    the mean of the previous ``window`` runs; ``spike`` when the rate is over
    ``spike_factor`` times that mean, ``shift`` when the last ``window`` runs
    are all above the long-run mean of the runs before them."""
    w = Window.orderBy(order_col)  # one row per run: a small, bounded table
    prev = w.rowsBetween(-window, -1)
    rate = F.col("quarantine_rate")
    out = reports.select(
        "run_id",
        order_col,
        rate,
        (rate - F.lag(rate, 1).over(w)).alias("rate_change"),
        F.avg(rate).over(prev).alias("prior_mean"),
        F.avg(rate).over(w.rowsBetween(Window.unboundedPreceding, -(window))).alias("base_mean"),
        F.min(rate).over(w.rowsBetween(-(window - 1), 0)).alias("recent_min"),
    )
    return out.select(
        "run_id",
        order_col,
        "quarantine_rate",
        "rate_change",
        "prior_mean",
        F.when(F.col("prior_mean").isNotNull() & (rate > F.col("prior_mean") * spike_factor),
               F.lit("spike"))
        .when(F.col("base_mean").isNotNull() & (F.col("recent_min") > F.col("base_mean")),
              F.lit("shift"))
        .otherwise(F.lit("stable"))
        .alias("trend"),
    )


def _reset_sum(step: str, order: Window) -> F.Column:
    """``S_t = max(0, S_{t-1} + step_t)``, as the running sum above its running
    minimum (0 at most); ``step`` is the running sum's column."""
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.col(step) - F.least(F.lit(0.0), F.min(step).over(upto))


def quarantine_change_points(
    reports: DataFrame,
    order_col: str = "dag_logical_date",
    baseline_runs: int = 6,
    slack: float = 0.01,
    cap: float = 0.02,
    limit: float = 0.05,
) -> DataFrame:
    """X1 as a change-point test: per run the upper CUSUM of its quarantine
    rate over the mean of the first ``baseline_runs`` runs, and a ``trend``.

    A run adds what its rate has above the mean plus ``slack``, but at most
    ``cap``, so that no single run reaches ``limit``: a *shift* is several runs
    that are higher one after the other; a *spike* is a run that is above
    mean plus slack plus cap and not part of a shift; ``baseline`` marks the
    runs that the mean is taken from. Runs without a rate add nothing. One row
    per run, so the window is over a small table.
    """
    order = Window.orderBy(order_col, "run_id")
    rate = F.col("quarantine_rate")
    numbered = reports.select("run_id", order_col, rate).withColumn("_n", F.row_number().over(order))
    base = F.avg(F.when(F.col("_n") <= baseline_runs, rate)).over(Window.partitionBy(F.lit(1)))
    later = F.col("_n") > baseline_runs
    above = numbered.withColumn("baseline_rate", base).withColumn(
        "_x",
        F.when(later & rate.isNotNull(), F.least(rate - F.col("baseline_rate") - slack, F.lit(cap)))
        .otherwise(0.0),
    )
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Sums are compared as they are reported, at 9 places.
    summed = above.withColumn("_c", F.sum("_x").over(upto)).withColumn(
        "cusum", F.round(_reset_sum("_c", order), 9)
    )
    high = rate > F.col("baseline_rate") + F.lit(slack + cap)
    return summed.select(
        "run_id", order_col, "quarantine_rate", F.round("baseline_rate", 9).alias("baseline_rate"),
        "cusum",
        F.when(~later, "baseline").when(F.col("cusum") > limit, "shift").when(high, "spike")
        .otherwise("stable").alias("trend"),
    )


def sequential_drift(
    scored: DataFrame,
    group_col: str = PERIOD,
    expected: float = CONTAMINATION,
    ratio: float = 1.5,
    false_alarm: float = 0.001,
) -> DataFrame:
    """X2 over runs: a sequential probability-ratio test of the flagged share,
    for a rate ``ratio`` times the expected one and for one as much lower.

    Every run adds its log-likelihood ratio, which knows how many rows it has:
    a small run adds little, however odd its share, and a small drift that
    lasts adds up. A sum that falls below 0 starts again; above
    ``ln(1 / false_alarm)`` the run is in ``drift``, ``up`` or ``down``.
    """
    g = scored.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if("is_anomaly").alias("n_flagged")
    )
    order = Window.orderBy(group_col)  # one row per run
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clean = F.col("n_scored") - F.col("n_flagged")
    out = g
    for name, p in (("up", expected * ratio), ("down", expected / ratio)):
        step = F.col("n_flagged") * math.log(p / expected) + clean * math.log(
            (1 - p) / (1 - expected)
        )
        out = out.withColumn(f"_{name}", F.sum(step).over(upto)).withColumn(
            f"evidence_{name}", F.round(_reset_sum(f"_{name}", order), 6)
        )
    limit = F.lit(math.log(1 / false_alarm))
    return out.select(
        group_col, "n_scored", "n_flagged", "evidence_up", "evidence_down",
        F.when(F.col("evidence_up") > limit, "up").when(F.col("evidence_down") > limit, "down")
        .otherwise("none").alias("drift"),
    )


def anomaly_rate_drift(
    scored: DataFrame, group_col: str = PERIOD, expected: float = CONTAMINATION, tolerance=0.5
) -> DataFrame:
    """Flagged share per group against the contamination assumption;
    ``drift`` when it is off by more than ``tolerance`` (relative)."""
    g = scored.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if("is_anomaly").alias("n_flagged")
    )
    rate = F.col("n_flagged") / F.col("n_scored")
    return g.select(
        group_col,
        "n_scored",
        "n_flagged",
        F.round(rate, 6).alias("flagged_rate"),
        (F.abs(rate - F.lit(expected)) > F.lit(expected * tolerance)).alias("drift"),
    )


def live_forecast_mae(
    forecasts: DataFrame,
    actuals: DataFrame,
    forecast_col: str,
    actual_col: str,
    horizon_months: int = 3,
    entity: str = ENTITY,
    period: str = PERIOD,
    input_decimals: int | None = None,
) -> DataFrame:
    """Once actuals arrive ``horizon_months`` later, MAE per origin
    month (6 dp). Calendar join (not row-based): origin month + horizon must
    match the actual's month exactly.

    With ``input_decimals`` (fixed-point inputs, e.g. 4 dp measures) the
    absolute errors are summed as exact integers in units of
    10^-input_decimals and the mean is rounded half-up with integer
    arithmetic, so the result does not depend on summation order (partition
    layout) at all.
    """
    f = forecasts.select(
        entity,
        F.col(period).alias("origin_month"),
        F.add_months(F.col(period), horizon_months).alias(period),
        F.col(forecast_col).alias("_f"),
    ).where(F.col("_f").isNotNull())
    a = actuals.select(entity, period, F.col(actual_col).alias("_a"))
    j = f.join(a, [entity, period], "inner").groupBy("origin_month")
    err = F.abs(F.col("_a") - F.col("_f"))
    if input_decimals is None:
        return j.agg(
            F.count(F.lit(1)).alias("n_matched"), F.round(F.avg(err), 6).alias("live_mae")
        )
    unit = 10**input_decimals
    out = j.agg(
        F.count(F.lit(1)).alias("n_matched"),
        F.sum(F.round(err * F.lit(float(unit))).cast("bigint")).alias("_units"),
    )
    # mean in 1e-6 units, half-up: (2 * units * 10^(6-d) + n) div (2 * n)
    scale = 10 ** (6 - input_decimals)
    micro = F.expr(f"(_units * {2 * scale} + n_matched) div (n_matched * 2)")
    return out.select("origin_month", "n_matched", (micro / F.lit(1e6)).alias("live_mae"))


def live_mae_against_baseline(
    forecasts: DataFrame,
    actuals: DataFrame,
    forecast_col: str,
    value_col: str,
    horizon_months: int = 3,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """X3 with its comparison: per origin month the MAE of the forecast and of
    carrying the origin's own value forward, over the same matched rows, and
    an ``alert`` where the forecast is worse."""
    f = forecasts.where(F.col(forecast_col).isNotNull()).select(
        entity,
        F.col(period).alias("origin_month"),
        F.add_months(F.col(period), horizon_months).alias(period),
        F.col(forecast_col).alias("_f"),
        F.col(value_col).alias("_v"),
    )
    a = actuals.select(entity, period, F.col(value_col).alias("_a"))
    mae = f.join(a, [entity, period]).groupBy("origin_month").agg(
        F.count(F.lit(1)).alias("n_matched"),
        F.round(F.avg(F.abs(F.col("_a") - F.col("_f"))), 9).alias("live_mae"),
        F.round(F.avg(F.abs(F.col("_a") - F.col("_v"))), 9).alias("baseline_mae"),
    )
    return mae.select("*", (F.col("live_mae") > F.col("baseline_mae")).alias("alert"))
