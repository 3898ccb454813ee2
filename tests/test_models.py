import itertools
import math
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelops.models import forecast as fc
from panelops.models import iforest, treeshap


def _blob(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:6] += 8.0  # six far-away rows
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["k"] = np.arange(n)
    return spark.createDataFrame(pdf)


def test_average_path_length():
    c = iforest.average_path_length([0, 1, 2, 3, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1.0
    assert c[3] == pytest.approx(2 * (math.log(2) + 0.5772156649) - 4 / 3, abs=1e-9)


def test_iforest_isolates_outliers_and_is_partition_independent(spark):
    df = _blob(spark)
    m1 = iforest.fit_iforest(df, ["a", "b", "c"], ["k"], n_trees=50)
    m2 = iforest.fit_iforest(df.repartition(5), ["a", "b", "c"], ["k"], n_trees=50)
    cols = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]
    a = m1.nodes.sort_values(["tree_id", "node_id"])[cols].reset_index(drop=True)
    b = m2.nodes.sort_values(["tree_id", "node_id"])[cols].reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    assert len(m1.nodes) <= 50 * (2 * m1.psi - 1)
    scored = iforest.decision(df, m1).toPandas().sort_values("k")
    assert scored.head(6).is_anomaly.all()
    share = scored.is_anomaly.mean()
    assert 0.03 <= share <= 0.07  # contamination 5 % on the training rows
    assert (scored.head(6).anomaly_score > scored.iloc[6:].anomaly_score.max() - 1e-12).all()


def test_threshold_does_not_depend_on_the_plan(spark):
    """Both selections give the same bits, also with very many equal scores."""
    df = _blob(spark, 400).withColumn("a", F.when(F.col("k") % 10 > 0, 0.0).otherwise(F.col("a")))
    df = df.withColumns({c: F.when(F.col("k") % 10 > 0, 0.0).otherwise(F.col(c)) for c in "bc"})
    got = {iforest.fit_iforest(df, ["a", "b", "c"], ["k"], n_trees=20, strategy=s).threshold
           for s in ("aggregate", "distributed")}
    assert len(got) == 1


def test_iforest_save_load_roundtrip(spark):
    df = _blob(spark, 200)
    m = iforest.fit_iforest(df, ["a", "b", "c"], ["k"], n_trees=20)
    d = tempfile.mkdtemp(dir="/tmp")
    iforest.save(m, spark, d)
    m2 = iforest.load(spark, d)
    assert m2.threshold == m.threshold and len(m2.nodes) == len(m.nodes)
    s1 = iforest.decision(df, m).orderBy("k").select("anomaly_score").collect()
    s2 = iforest.decision(df, m2).orderBy("k").select("anomaly_score").collect()
    assert s1 == s2


def _brute_force_shap(x, nodes_tree, n_features):
    """Shapley values of the path-dependent value function by enumeration."""
    by = {int(r.node_id): r for r in nodes_tree.itertuples()}

    def v(S):
        def rec(nid):
            r = by[nid]
            if r.left < 0:
                return r.value
            lc, rc = by[int(r.left)], by[int(r.right)]
            if r.feature in S:
                return rec(int(r.left)) if x[r.feature] <= r.threshold else rec(int(r.right))
            return (lc.cover * rec(int(r.left)) + rc.cover * rec(int(r.right))) / r.cover
        return rec(int(nodes_tree.node_id.min()))

    phi = np.zeros(n_features)
    players = list(range(n_features))
    for i in players:
        others = [j for j in players if j != i]
        for s in range(len(others) + 1):
            for S in itertools.combinations(others, s):
                w = math.factorial(s) * math.factorial(n_features - s - 1) / math.factorial(n_features)
                phi[i] += w * (v(set(S) | {i}) - v(set(S)))
    return phi, v(set())


def test_treeshap_matches_brute_force_and_is_additive(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)), columns=["a", "b", "c", "d"])
    pdf["y"] = pdf.a * 2 + np.where(pdf.b > 0, 3, -1) + pdf.c * pdf.a + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame(pdf)
    m = fc.fit_forecaster(df, "y", feature_cols=["a", "b", "c", "d"], max_iter=5, max_depth=3)
    nodes = fc.tree_nodes(m)
    x = pdf[["a", "b", "c", "d"]].to_numpy()[:20]
    phi, base = treeshap.shap_values(x, treeshap.compile_trees(nodes), 4)
    for row in range(3):
        bf = np.zeros(4)
        bbase = 0.0
        for _, t in nodes.groupby("tree_id"):
            p, b0 = _brute_force_shap(x[row], t, 4)
            bf += t.weight.iloc[0] * p
            bbase += t.weight.iloc[0] * b0
        np.testing.assert_allclose(phi[row], bf, atol=1e-9)
        assert base == pytest.approx(bbase, abs=1e-9)
    pred = fc.predict(df, m).select("prediction").toPandas().prediction.to_numpy()[:20]
    np.testing.assert_allclose(phi.sum(axis=1) + base + m.label_mean, pred, atol=1e-9)
    ex = treeshap.explain(fc.predict(df, m), nodes, m.feature_cols, m.label_mean)
    resid = ex.select(
        (F.aggregate("shap", F.lit(0.0), lambda a, v: a + v) + F.col("shap_base") - F.col("prediction")).alias("r")
    ).agg(F.max(F.abs("r"))).first()[0]
    assert resid < 1e-9
    top = treeshap.top_features(treeshap.mean_abs_shap(ex, m.feature_cols), 2).collect()
    assert {t.feature for t in top} == {"a", "b"}  # d is pure noise


def test_injected_candidates_outrank_other_rows(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from panelops.operators import features
    from panelops.plans.inputs import Inputs
    from panelops.schemas import ANOMALY_FIELDS, KEY

    i = Inputs(spark, SF_SMALL)
    z = [f"z_{f}" for f in ANOMALY_FIELDS]
    train = features.with_enough_history(features.anomaly_features(i.clean)).select(*KEY, *z)
    m = iforest.fit_iforest(train, z, KEY, n_trees=100)
    s = iforest.decision(train, m).join(
        i.candidates.withColumn("cand", F.lit(True)), KEY, "left"
    ).withColumn("cand", F.coalesce("cand", F.lit(False)))
    means = {r.cand: r.m for r in s.groupBy("cand").agg(F.avg("anomaly_score").alias("m")).collect()}
    assert means[True] > means[False]
    rates = {r.cand: r.r for r in s.groupBy("cand").agg(
        F.avg(F.col("is_anomaly").cast("double")).alias("r")).collect()}
    assert rates[True] > 5 * rates[False]
