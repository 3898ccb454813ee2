"""Ground-truth evaluation (D5: U2 + J2 + A10-A12) and forecast metrics
(A13, A14), each one aggregate query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.schemas import KEY


def _ratio(num: str, den: F.Column) -> F.Column:
    return F.round(
        F.coalesce(F.try_divide(F.col(num).cast("double"), F.nullif(den, F.lit(0))), F.lit(0.0)), 4
    )


def evaluate_against_ground_truth(
    scored: DataFrame, ledger: DataFrame, keys=KEY, flag: str = "is_anomaly"
) -> DataFrame:
    """One row: candidates injected / present / removed upstream, confusion
    matrix and precision, recall, false-positive rate (4 dp, 0.0 when the
    denominator is 0)."""
    keys = list(keys)
    cand = ledger.where(F.col("is_anomaly_candidate")).select(*keys).dropDuplicates(keys)
    total = cand.agg(F.count(F.lit(1))).scalar()
    merged = scored.select(*keys, F.col(flag).alias("_flag")).join(
        cand.withColumn("_cand", F.lit(True)), keys, "left"
    )
    c = F.coalesce(F.col("_cand"), F.lit(False))
    a = F.coalesce(F.col("_flag"), F.lit(False))
    m = merged.agg(
        F.count_if(c).alias("candidates_present_in_monthly_reports"),
        F.count_if(c & a).alias("true_positives"),
        F.count_if(~c & a).alias("false_positives"),
        F.count_if(c & ~a).alias("false_negatives"),
        F.count_if(~c & ~a).alias("true_negatives"),
    )
    return m.select(
        total.alias("total_candidates_injected"),
        (total - F.col("candidates_present_in_monthly_reports")).alias(
            "candidates_removed_upstream_by_validation"
        ),
        "candidates_present_in_monthly_reports",
        "true_positives",
        "false_positives",
        "false_negatives",
        "true_negatives",
        _ratio("true_positives", F.col("true_positives") + F.col("false_positives")).alias(
            "precision"
        ),
        _ratio("true_positives", F.col("true_positives") + F.col("false_negatives")).alias(
            "recall"
        ),
        _ratio("false_positives", F.col("false_positives") + F.col("true_negatives")).alias(
            "false_positive_rate"
        ),
    )


def forecast_metrics(test_pred: DataFrame, target: str, pred: str, naive: str) -> DataFrame:
    """A13 + A14: model and naive MAE (4 dp) and the improvement in % (2 dp,
    0.0 when the naive MAE is 0)."""
    m = test_pred.agg(
        F.avg(F.abs(F.col(target) - F.col(pred))).alias("mae_model"),
        F.avg(F.abs(F.col(target) - F.col(naive))).alias("mae_naive_baseline"),
        F.count(F.lit(1)).alias("test_rows"),
    )
    imp = F.coalesce(
        F.try_divide(
            (F.col("mae_naive_baseline") - F.col("mae_model")) * F.lit(100.0),
            F.nullif(F.col("mae_naive_baseline"), F.lit(0.0)),
        ),
        F.lit(0.0),
    )
    return m.select(
        "test_rows",
        F.round("mae_model", 4).alias("mae_model"),
        F.round("mae_naive_baseline", 4).alias("mae_naive_baseline"),
        F.round(imp, 2).alias("improvement_over_baseline_pct"),
    )


# Cumulative probabilities of the Poisson distribution of mean 1.
POISSON_ONE = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676)


def poisson_weight(key: Column, replicate: Column) -> Column:
    """Poisson(1) weight of a row in a bootstrap replicate: a pure function of
    the row's key, so reruns and any partitioning agree."""
    digest = F.md5(F.concat_ws("|", key, replicate.cast("string")))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return sum((F.when(u >= F.lit(p), 1).otherwise(0) for p in POISSON_ONE), F.lit(0))


def paired_mae_difference(
    predictions: DataFrame,
    key_cols: list[str],
    target: str,
    candidate: str,
    current: str,
    replicates: int = 200,
    confidence: float = 0.95,
) -> DataFrame:
    """MAE(candidate) - MAE(current) over the rows that both predict, and
    its bootstrap interval, in one pass: n_rows, mae_difference,
    mae_difference_lower, mae_difference_upper, better.

    Each row counts Poisson(1) times in each replicate, so replicates are
    plain sums (pre-aggregated per task) and rows are never resampled. Rows
    without a target or one of the predictions are left out; without any row
    the numbers are null and ``better`` is false.
    """
    gap = F.abs(F.col(target) - F.col(candidate)) - F.abs(F.col(target) - F.col(current))
    rows = predictions.select(
        F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols]).alias("_key"), gap.alias("_d")
    ).where(F.col("_d").isNotNull() & ~F.isnan("_d"))
    # Replicate -1 has every row once: the difference itself.
    every = rows.select(
        "*", F.explode(F.sequence(F.lit(-1), F.lit(replicates - 1))).alias("_b")
    ).withColumn("_w", F.when(F.col("_b") < 0, 1).otherwise(poisson_weight(F.col("_key"), F.col("_b"))))
    means = every.groupBy("_b").agg(
        F.sum("_w").alias("n"), (F.sum(F.col("_d") * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0))).alias("m")
    )
    own, drawn = F.col("_b") < 0, F.col("_b") >= 0
    tail = (1 - confidence) / 2
    end = lambda q: F.percentile(F.when(drawn, F.col("m")), F.lit(q))
    return means.agg(
        F.coalesce(F.max(F.when(own, F.col("n"))), F.lit(0)).cast("bigint").alias("n_rows"),
        F.round(F.max(F.when(own, F.col("m"))), 6).alias("mae_difference"),
        F.round(end(tail), 6).alias("mae_difference_lower"),
        F.round(end(1 - tail), 6).alias("mae_difference_upper"),
        F.coalesce(end(1 - tail) < 0, F.lit(False)).alias("better"),
    )
