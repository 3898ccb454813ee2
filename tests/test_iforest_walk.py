import numpy as np
import pandas as pd

from panelops.models import iforest

COLS = ["a", "b", "c"]


def table(spark, n=700):
    g = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": g.normal(size=n), "b": g.integers(0, 3, n).astype(float), "c": np.zeros(n)})
    pdf["k"] = np.arange(n)
    return spark.createDataFrame(pdf)


def walked(x, model):
    """One row after the other down the node table."""
    out = []
    for row in x:
        total = 0.0
        for _, t in model.nodes.sort_values(["tree_id", "node_id"]).groupby("tree_id"):
            t = t.reset_index(drop=True)
            at = 0
            while t.feature[at] >= 0:
                at = t.left[at] if row[t.feature[at]] <= t.threshold[at] else t.right[at]
            total += t.depth[at] + iforest.average_path_length([t["size"][at]])[0]
        mean = total / model.n_trees
        out.append(2.0 ** (-mean / iforest.average_path_length([model.psi])[0]))
    return np.array(out)


def test_scores_equal_a_walk_down_every_tree(spark):
    """Also for leaves above the last level, missing and infinite values."""
    m = iforest.fit_iforest(table(spark), COLS, ["k"], n_trees=12, max_samples=64)
    x = np.random.default_rng(1).normal(size=(60, 3)) * 2
    x[0, 0], x[1, 1], x[2, 0], x[3, 2] = np.nan, np.inf, -np.inf, np.nan
    x[4] = np.nan
    np.testing.assert_allclose(iforest.raw_scores(x, m.arrays()), walked(x, m), rtol=1e-14)


def test_fit_scores_its_rows_once(spark, monkeypatch):
    """The scores behind the threshold are written; before, the sketch and the
    selection each scored all rows again."""
    scored = []
    plain = iforest.weighted_quantile

    def quantile(df, *args, **kwargs):
        scored.append("MapInPandas" in df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(iforest, "weighted_quantile", quantile)
    iforest.fit_iforest(table(spark, 200), COLS, ["k"], n_trees=5)
    assert scored == [False]


def test_trees_are_drawn_in_generated_code(spark, monkeypatch):
    """Every row has to be hashed once per tree; a ``filter`` over an array of
    tree ids does that outside generated code, at six times the time."""
    plans = []
    df_type = type(spark.range(1))
    to_pandas = df_type.toPandas

    def recorded(self):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return to_pandas(self)

    monkeypatch.setattr(df_type, "toPandas", recorded)
    m = iforest.fit_iforest(table(spark, 300), COLS, ["k"], n_trees=7, max_samples=32)
    assert m.nodes.tree_id.nunique() == 7
    assert "filter(sequence" not in plans[0].lower() and "lambdafunction" not in plans[0].lower()
    # Each tree has its rows of smallest hash.
    assert (m.nodes[m.nodes.node_id == 0]["size"] == 32).all()
