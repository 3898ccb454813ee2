import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelops.functions.quantiles import weighted_quantile


def _expanded_quantile(values, weights, q):
    x = np.repeat(np.asarray(values, float), np.asarray(weights, int))
    return float(np.percentile(x, q * 100))  # linear interpolation, like Spark


@pytest.mark.parametrize("q", [0.5, 0.95, 0.05])
def test_distributed_equals_aggregate_and_numpy(spark, q):
    rng = np.random.default_rng(3)
    # one hot group with many values, a few small ones, ties and weights
    g = np.concatenate([np.zeros(3000, int), rng.integers(1, 6, 400)])
    v = np.round(rng.normal(size=g.size) * 10, 1)
    w = rng.integers(1, 4, g.size)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v, "w": w}))
    agg = {r.g: r.quantile for r in weighted_quantile(df, ["g"], "v", "w", q, strategy="aggregate").collect()}
    dist = {r.g: r.quantile for r in weighted_quantile(df, ["g"], "v", "w", q, strategy="distributed").collect()}
    auto_small = {r.g: r.quantile for r in weighted_quantile(df, ["g"], "v", "w", q, max_group_values=100).collect()}
    for k in agg:
        want = _expanded_quantile(v[g == k], w[g == k], q)
        assert agg[k] == pytest.approx(want, abs=1e-9)
        assert dist[k] == pytest.approx(want, abs=1e-9)
        assert auto_small[k] == pytest.approx(want, abs=1e-9)


def test_global_quantile(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    d = weighted_quantile(df, [], "v", "w", 0.95, strategy="distributed").first().quantile
    assert d == pytest.approx(np.percentile(np.arange(1, 1001), 95))


def test_robust_stats_same_under_both_strategies(spark):
    from conftest import SF_SMALL
    from panelops.operators import checks
    from panelops.plans.inputs import Inputs

    raw = Inputs(spark, SF_SMALL).raw
    a = sorted(checks.robust_stats_wide(raw).collect())
    b = sorted(checks.robust_stats_wide(raw, max_group_values=0).collect())
    assert len(a) == len(b)
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            assert x == y or (x is not None and y is not None and abs(x - y) < 1e-9)


def test_both_strategies_agree_to_the_bit(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), float(v), int(w)) for g, v, w in zip(
        rng.integers(0, 300, 6000), rng.normal(size=6000), rng.integers(1, 4, 6000), strict=True)]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    for q in (0.5, 0.95):
        a, b = (
            {r["g"]: r["t"] for r in weighted_quantile(df, ["g"], "v", "w", q, "t", strategy=s).collect()}
            for s in ("aggregate", "distributed")
        )
        assert a == b
