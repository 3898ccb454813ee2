import numpy as np
import pandas as pd
from pyspark import RDD

from panelops.models import boosting
from panelops.models import forecast as fc

FEATURES = ["a", "b", "c"]


def table(n=600):
    g = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": g.normal(size=n), "b": g.integers(0, 5, n).astype(float), "c": g.exponential(size=n)})
    pdf["y"] = pdf.a * pdf.b - pdf.c + g.normal(scale=0.1, size=n)
    return pdf


def test_driver_gets_splits_and_not_the_sums_of_every_task(spark, monkeypatch):
    """What a pass brings to the driver does not grow with its tasks: a few
    numbers per (node, feature) and no sums per bin."""
    got = []
    plain = RDD.collect

    def collect(self):
        rows = plain(self)
        got.append((self.getNumPartitions(), rows))
        return rows

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 16)
    monkeypatch.setattr(boosting, "TASK_ROWS", 64, raising=False)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 2, raising=False)
    df = spark.createDataFrame(table()).repartition(8, "a")
    monkeypatch.setattr(RDD, "collect", collect)
    m = fc.fit_forecaster(df, "y", FEATURES, max_iter=2, max_depth=3)
    passes = [rows for _, rows in got if rows and isinstance(rows[0], tuple)]
    assert len(passes) == 2 * 3 and len(m.trees.trees) == 2
    for rows in passes:
        numbers = [v for _, nodes in rows for node in nodes for v in node]
        assert sorted(f for f, _ in rows) == [0, 1, 2]
        assert len(numbers) <= 6 * 4 * len(FEATURES)
        assert all(v is None or isinstance(v, int | float) for v in numbers)


def test_leaf_numbers_equal_a_walk_down_the_tree():
    g = np.random.default_rng(3)
    x = g.integers(0, 9, (3, 500))
    for wide in (15, 301):  # the second has numbers above a byte
        t = boosting.Tree()
        t.add(0)
        k = 0
        while len(t.left) < wide:
            t.feature[k], t.cut[k], t.left[k] = int(g.integers(3)), int(g.integers(9)), len(t.left)
            t.add(0), t.add(0)
            k += 1
        values = np.arange(len(t.left)) * 1000
        got = t.per_row(lambda k, t=t: x[t.feature[k]] <= t.cut[k], values)
        for row in range(x.shape[1]):
            at = 0
            while t.left[at] >= 0:
                at = t.left[at] + int(x[t.feature[at], row] > t.cut[at])
            assert got[row] == values[at]


def test_both_ways_of_adding_up_give_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 16)
    df = spark.createDataFrame(table()).repartition(8, "a")
    direct = fc.fit_forecaster(df, "y", FEATURES, max_iter=3).trees
    monkeypatch.setattr(boosting, "TASK_ROWS", 64)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 2)
    assert fc.fit_forecaster(df, "y", FEATURES, max_iter=3).trees == direct
