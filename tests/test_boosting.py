import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelops.functions.quantiles import ranked_values
from panelops.models import boosting
from panelops.models import forecast as fc

FEATURES = ["a", "b", "c"]


def table(n=900, seed=5):
    g = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": g.normal(size=n), "b": g.integers(0, 4, n).astype(float), "c": g.exponential(size=n)})
    pdf["y"] = 3 * (pdf.a > 0.3) - pdf.b * pdf.c + g.normal(scale=0.2, size=n)
    return pdf


def plain_boosting(x, y, edges, n_trees, depth, rate):
    """Floating-point boosting over the same split points, row by row sums."""
    f = np.full(len(y), y.mean())
    for _ in range(n_trees):
        r = y - f
        node = {0: np.ones(len(y), bool)}
        for _ in range(depth):
            deeper = {}
            for k, rows in node.items():
                best, n, s = (1e-12, None), rows.sum(), r[rows].sum()
                for j, cuts in enumerate(edges):
                    for cut in cuts:
                        left = rows & (x[:, j] <= cut)
                        nl = left.sum()
                        if 0 < nl < n:
                            sl = r[left].sum()
                            gain = sl**2 / nl + (s - sl) ** 2 / (n - nl) - s**2 / n
                            if gain > best[0] * (1 + 1e-12):
                                best = (gain, left)
                if best[1] is None:
                    deeper[2 * k + 1] = rows
                else:
                    deeper[2 * k + 1], deeper[2 * k + 2] = best[1], rows & ~best[1]
            node = deeper
        for rows in node.values():
            f[rows] += rate * r[rows].mean()
    return f


def test_fit_equals_plain_boosting(spark):
    pdf = table()
    m = fc.fit_forecaster(spark.createDataFrame(pdf), "y", FEATURES, max_iter=30, max_depth=2, max_bins=16)
    x = pdf[FEATURES].to_numpy()
    want = plain_boosting(x, pdf.y.to_numpy(), m.trees.edges, 30, 2, 0.1)
    np.testing.assert_allclose(m.trees.predict(x), want, atol=1e-6)


def test_fit_does_not_depend_on_partitions_or_blocks(spark, monkeypatch):
    df = spark.createDataFrame(table())
    one = fc.fit_forecaster(df.repartition(1), "y", FEATURES, max_iter=6).trees
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    many = fc.fit_forecaster(df.repartition(7, "c"), "y", FEATURES, max_iter=6).trees
    assert one == many


def test_first_tree_has_the_learning_rate_too(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 8.0), (1.0, 8.0)], "x double, y double")
    m = fc.fit_forecaster(df, "y", ["x"], max_iter=1, max_depth=3)
    assert m.label_mean == 4.0
    assert m.trees.predict(np.array([[0.0], [1.0]])).tolist() == pytest.approx([3.6, 4.4])


def test_odd_rows_and_saved_models(spark, tmp_path):
    rows = [(1.0, 2.0, 3.0), (None, 2.0, 9.0), (float("nan"), 1.0, 9.0), (2.0, None, 1.0),
            (3.0, 2.0, None), (float("inf"), 2.0, -1.0), (1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "x double, k double, y double").withColumn("f0", F.lit("clash"))
    m = fc.fit_forecaster(df, "y", ["x", "k"], max_iter=3)
    assert m.trees.n == 3 and m.trees.edges[1] == [2.0]
    fc.save(m, spark, str(tmp_path / "m"))
    again = fc.load(spark, str(tmp_path / "m"))
    assert again == m
    out = fc.predict(df, again).collect()
    assert [r.prediction is None for r in out] == [False, True, True, True, False, False, False]
    assert out[0].f0 == "clash"
    with pytest.raises(ValueError, match="at least one"):
        fc.fit_forecaster(df.where("y > 100"), "y", ["x"])


def test_constant_label_gives_single_leaves(spark):
    df = spark.createDataFrame([(float(k), 5.0) for k in range(9)], "x double, y double")
    m = fc.fit_forecaster(df, "y", ["x"], max_iter=2)
    assert [len(t.left) for t in m.trees.trees] == [1, 1]
    assert m.trees.predict(np.array([[3.0]])).tolist() == [5.0]


@pytest.mark.parametrize("n", [1, 7, 5000])
def test_ranked_values(spark, n):
    g = np.random.default_rng(n)
    pdf = pd.DataFrame({"u": g.normal(size=n), "v": g.integers(0, 3, n).astype(float), "w": -np.arange(n, dtype=float)})
    ranks = [j * n // 10 for j in range(1, 10)]
    got = ranked_values(spark.createDataFrame(pdf).repartition(5), ["u", "v", "w"], ranks)
    for c, values in zip("uvw", got, strict=True):
        assert values == sorted(set(np.sort(pdf[c].to_numpy())[ranks].tolist()))
