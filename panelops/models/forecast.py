"""Gradient-boosted forecaster (D6, D7) on :mod:`panelops.models.boosting`.

Squared loss; the model starts from the mean label and every tree, the first
one too, is added with the learning rate.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.models import boosting
from panelops.models.signature import enforce, signature_of
from panelops.schemas import FORECAST_FEATURES, GBT_DEPTH, GBT_STEP, GBT_TREES

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree_id", T.LongType(), False),
        T.StructField("node_id", T.LongType(), False),
        T.StructField("feature", T.LongType()),
        T.StructField("cut", T.LongType()),
        T.StructField("left", T.LongType()),
        T.StructField("value", T.LongType()),
        T.StructField("cover", T.LongType()),
    ]
)


@dataclass
class ForecastModel:
    trees: boosting.Boosted
    feature_cols: list[str]
    signature: dict | None = None

    @property
    def label_mean(self) -> float:
        """What every prediction starts from."""
        return self.trees.base * self.trees.unit


def fit_forecaster(
    train: DataFrame,
    label: str,
    feature_cols=FORECAST_FEATURES,
    max_iter: int = GBT_TREES,
    max_depth: int = GBT_DEPTH,
    step_size: float = GBT_STEP,
    max_bins: int = boosting.BINS,
) -> ForecastModel:
    """Fit on rows that have every feature and the label."""
    cols = list(feature_cols)
    trees = boosting.fit(train, cols, label, max_iter, max_depth, step_size, max_bins)
    return ForecastModel(trees, cols, signature_of(train, cols, {"prediction": "double"}))


def predict(df: DataFrame, model: ForecastModel, out_col: str = "prediction") -> DataFrame:
    """Append ``out_col``; rows with a missing feature get NULL. The
    columns have to fit the model's signature."""
    enforce(df, model.signature)
    return boosting.predict(df, model.trees, model.feature_cols, out_col)


def tree_nodes(model: ForecastModel) -> pd.DataFrame:
    """Node table of the ensemble (bounded: trees * (2^(depth+1) - 1) rows)
    for attributions: tree, node, children, split, cover, value, weight."""
    return model.trees.nodes()


def save(model: ForecastModel, spark: SparkSession, path: str) -> None:
    rows = [
        (i, k, t.feature[k], t.cut[k], t.left[k], t.value[k], t.cover[k])
        for i, t in enumerate(model.trees.trees)
        for k in range(len(t.left))
    ]
    spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/nodes"
    )
    b = model.trees
    meta = {
        "model_type": "GradientBoostedTrees", "feature_cols": model.feature_cols, "base": b.base,
        "shift": b.shift, "n_train": b.n, "edges": [[repr(e) for e in f] for f in b.edges],
        "n_trees": len(b.trees), "signature": model.signature,
    }
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> ForecastModel:
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    trees = [boosting.Tree() for _ in range(meta["n_trees"])]
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
    for r in nodes.orderBy("tree_id", "node_id").collect():
        t = trees[r["tree_id"]]
        for column in ("feature", "cut", "left", "value", "cover"):
            getattr(t, column).append(r[column])
    edges = [[float(e) for e in f] for f in meta["edges"]]
    boosted = boosting.Boosted(edges, trees, meta["base"], meta["shift"], meta["n_train"])
    return ForecastModel(boosted, meta["feature_cols"], meta["signature"])
