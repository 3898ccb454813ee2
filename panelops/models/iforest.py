"""Isolation forest (Liu, Ting, Zhou 2008) fitted and scored as Spark jobs.

Fit (D1):
  1. every training row gets a uniform hash ``u(key, t)`` per tree id ``t``
     (xxhash64 of the key, the tree id and the seed), so sampling is
     deterministic under any partitioning;
  2. every row joins the trees whose hash of it falls below
     ``oversample * psi / n`` (``explode`` of the tree ids, then ``where``, both
     in generated code, which a ``filter`` over the array is not), so any row
     can enter any tree at every input size;
  3. per tree the ``psi`` rows with the smallest hash are kept (a window over
     groups of about ``oversample * psi`` rows);
  4. ``groupBy(tree_id).applyInPandas`` grows each tree from its <= psi rows:
     a random feature that is not constant in the node, a uniform threshold
     between its min and max, depth limit ceil(log2 psi).
  Training memory is bounded by trees * psi rows whatever the input size.

Score (D2): the node table (at most trees * (2 psi - 1) rows, a proven bound)
goes to the executors as a broadcast, level by level with every level full
(a leaf above the last level is repeated below itself), so that the children of
node ``k`` are ``2 k`` and ``2 k + 1``; ``mapInPandas`` walks all trees
vectorised over each Arrow batch. ``s = 2 ** (-E[h] / c(psi))``.

Threshold (D3): the exact (1 - contamination) quantile of the training
scores by the distributed selection of ``functions.quantiles``, over scores
counted first (equal scores are common and would otherwise meet in one
task). Stored with
the model and never recomputed at scoring time; ``anomaly_score = s - thr``
and ``is_anomaly = s > thr`` (the sign convention of the reference).
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.functions.quantiles import weighted_quantile
from panelops.models.signature import enforce, signature_of
from panelops.schemas import CONTAMINATION, IFOREST_MAX_SAMPLES, IFOREST_TREES, SEED
from panelops.session import cut_lineage

EULER_GAMMA = 0.5772156649015329
_MASK63 = (1 << 63) - 1

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree_id", T.IntegerType(), False),
        T.StructField("node_id", T.IntegerType(), False),
        T.StructField("feature", T.IntegerType(), False),
        T.StructField("threshold", T.DoubleType(), False),
        T.StructField("left", T.IntegerType(), False),
        T.StructField("right", T.IntegerType(), False),
        T.StructField("size", T.IntegerType(), False),
        T.StructField("depth", T.IntegerType(), False),
    ]
)


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search; c(<=1)=0, c(2)=1."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    m = n[big]
    out[big] = 2.0 * (np.log(m - 1.0) + EULER_GAMMA) - 2.0 * (m - 1.0) / m
    return out


def _uniform(key_cols, salt) -> F.Column:
    """Deterministic uniform [0, 1) from the key and a salt column/literal."""
    h = F.xxhash64(*[F.col(k) for k in key_cols], salt)
    return (h.bitwiseAND(F.lit(_MASK63)).cast("double")) / F.lit(float(1 << 63))


def _grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Grow one isolation tree; returns parallel node lists."""
    feat, thr, left, right, size, depth = [], [], [], [], [], []

    def new_node(n, d):
        feat.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        size.append(n)
        depth.append(d)
        return len(feat) - 1

    stack = [(np.arange(len(x)), 0, new_node(len(x), 0))]
    n_features = x.shape[1]
    while stack:
        idx, d, node = stack.pop()
        if len(idx) <= 1 or d >= max_depth:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = hi > lo
        if not usable.any():
            continue
        # Visit features in random order and take the first non-constant one.
        order = rng.permutation(n_features)
        f = int(order[np.argmax(usable[order])])
        t = float(rng.uniform(lo[f], hi[f]))
        if not (lo[f] <= t < hi[f]):
            t = float(lo[f])
        go_left = sub[:, f] <= t
        li, ri = idx[go_left], idx[~go_left]
        feat[node], thr[node] = f, t
        left[node] = new_node(len(li), d + 1)
        right[node] = new_node(len(ri), d + 1)
        stack.append((ri, d + 1, right[node]))
        stack.append((li, d + 1, left[node]))
    return feat, thr, left, right, size, depth


def _tree_builder(feature_cols, max_depth: int, seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values(["_u", "_rk"], kind="mergesort")
        x = pdf[feature_cols].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree_id])
        feat, thr, left, right, size, depth = _grow_tree(x, rng, max_depth)
        n = len(feat)
        return pd.DataFrame(
            {
                "tree_id": np.full(n, tree_id, dtype=np.int32),
                "node_id": np.arange(n, dtype=np.int32),
                "feature": np.asarray(feat, dtype=np.int32),
                "threshold": np.asarray(thr, dtype=float),
                "left": np.asarray(left, dtype=np.int32),
                "right": np.asarray(right, dtype=np.int32),
                "size": np.asarray(size, dtype=np.int32),
                "depth": np.asarray(depth, dtype=np.int32),
            }
        )

    return build


@dataclass
class IForestModel:
    feature_cols: list[str]
    psi: int
    n_trees: int
    seed: int
    contamination: float
    threshold: float = float("nan")
    n_train: int = 0
    nodes: pd.DataFrame = field(default_factory=pd.DataFrame)
    signature: dict | None = None

    # --- arrays for vectorised traversal -------------------------------------
    def arrays(self):
        """Per tree the features and thresholds of every level and the heights
        of the last one, which has at most 2 ** ceil(log2 psi) places."""
        nodes = self.nodes.sort_values(["tree_id", "node_id"])
        height = nodes["depth"].to_numpy(float) + average_path_length(nodes["size"].to_numpy())
        nodes = nodes.assign(height=height)
        max_depth = int(nodes["depth"].max()) if len(nodes) else 0
        trees = []
        for _, t in nodes.groupby("tree_id", sort=True):
            feature, threshold = t["feature"].to_numpy(np.int64), t["threshold"].to_numpy(float)
            left, right = t["left"].to_numpy(np.int64), t["right"].to_numpy(np.int64)
            at, levels = np.zeros(1, np.int64), []
            for _ in range(max_depth):
                inner = feature[at] >= 0
                # Below a leaf every row goes left, to the leaf again.
                levels.append(
                    (np.where(inner, feature[at], 0), np.where(inner, threshold[at], np.inf))
                )
                below = [np.where(inner, child[at], at) for child in (left, right)]
                at = np.column_stack(below).ravel()
            trees.append((levels, t["height"].to_numpy()[at]))
        return {"trees": trees, "c_psi": float(average_path_length([self.psi])[0])}

    def node_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)


def raw_scores(x: np.ndarray, arr: dict) -> np.ndarray:
    """s(x) for a batch: mean isolation depth over all trees, normalised."""
    n = len(x)
    total, rows = np.zeros(n), np.arange(n)
    # A missing value is below no threshold, like infinity.
    values = np.where(np.isnan(x), np.inf, x).T.ravel()
    for levels, heights in arr["trees"]:
        node = np.zeros(n, np.intp)
        for feature, threshold in levels:
            place = (feature * n).take(node)
            place += rows
            right = values.take(place) > threshold.take(node)
            node += node
            node += right
        total += heights.take(node)
    mean_h = total / len(arr["trees"])
    c = arr["c_psi"] if arr["c_psi"] > 0 else 1.0
    return np.power(2.0, -mean_h / c)


def fit_iforest(
    df: DataFrame,
    feature_cols: list[str],
    key_cols: list[str],
    n_trees: int = IFOREST_TREES,
    max_samples: int = IFOREST_MAX_SAMPLES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    oversample: float = 2.0,
    strategy: str = "distributed",
) -> IForestModel:
    """D1 + D3: fit on ``df`` (rows = training set) and set the threshold."""
    data = df.select(*key_cols, *[F.col(c).cast("double").alias(c) for c in feature_cols])
    # Read three times below (count, sample, threshold).
    data = cut_lineage(data, "training")
    n = data.count()
    if n == 0:
        raise ValueError("isolation forest needs at least one training row")
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    tree_frac = min(1.0, oversample * psi / n)
    tree_ids = F.sequence(F.lit(0), F.lit(n_trees - 1))
    u = _uniform(key_cols, F.col("tree_id") * F.lit(1_000_003) + F.lit(seed))
    every = data.select("*", F.explode(tree_ids).alias("tree_id"))
    picked = every.where(u < F.lit(tree_frac)).withColumn("_u", u)
    # Tie-break on a key hash so the order is total even if _u collides.
    picked = picked.withColumn("_rk", F.xxhash64(*[F.col(k) for k in key_cols]))
    from pyspark.sql import Window

    w = Window.partitionBy("tree_id").orderBy("_u", "_rk")
    sample = picked.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= psi)
    nodes = (
        sample.select("tree_id", "_u", "_rk", *feature_cols)
        .groupBy("tree_id")
        .applyInPandas(_tree_builder(feature_cols, max_depth, seed), NODE_SCHEMA)
    )
    # Bounded: at most n_trees * (2 * psi - 1) node rows.
    node_pdf = nodes.toPandas()
    model = IForestModel(
        feature_cols=list(feature_cols),
        psi=psi,
        n_trees=n_trees,
        seed=seed,
        contamination=contamination,
        n_train=n,
        nodes=node_pdf,
        signature=signature_of(
            df, feature_cols, {"anomaly_score": "double", "is_anomaly": "boolean"}
        ),
    )
    counted = score_samples(data, model).groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    # Read by the sketch and by the selection: written, or each scores all rows.
    counted = cut_lineage(counted, "scores")
    q = 1.0 - contamination
    thr = weighted_quantile(counted, [], "_s", "_n", q, "t", strategy=strategy).first()["t"]
    model.threshold = float(thr)
    return model


def score_samples(df: DataFrame, model: IForestModel, out_col: str = "_s") -> DataFrame:
    """Append the raw isolation score ``s`` (higher = more isolated)."""
    spark = df.sparkSession
    arr = model.arrays()
    bc = spark.sparkContext.broadcast(arr)
    cols = model.feature_cols
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.DoubleType())])

    def score(batches):
        a = bc.value
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            pdf[out_col] = raw_scores(x, a) if len(pdf) else np.zeros(0)
            yield pdf

    return df.mapInPandas(score, schema)


def decision(df: DataFrame, model: IForestModel) -> DataFrame:
    """``anomaly_score = s - thr``, ``is_anomaly = s > thr``. The columns
    have to fit the model's signature."""
    enforce(df, model.signature)
    s = score_samples(df, model)
    thr = F.lit(model.threshold)
    return s.withColumn("anomaly_score", F.col("_s") - thr).withColumn(
        "is_anomaly", F.col("_s") > thr
    ).drop("_s")


# --- persistence --------------------------------------------------------------
def save(model: IForestModel, spark: SparkSession, path: str) -> None:
    model.node_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = {
        "model_type": "IsolationForest",
        "feature_cols": ",".join(model.feature_cols),
        "psi": str(model.psi),
        "n_trees": str(model.n_trees),
        "seed": str(model.seed),
        "contamination": repr(model.contamination),
        "threshold": repr(model.threshold),
        "n_train": str(model.n_train),
        "signature": json.dumps(model.signature),
    }
    spark.createDataFrame([(k, v) for k, v in meta.items()], "key string, value string").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> IForestModel:
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/meta").collect()}
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    return IForestModel(
        feature_cols=meta["feature_cols"].split(","),
        psi=int(meta["psi"]),
        n_trees=int(meta["n_trees"]),
        seed=int(meta["seed"]),
        contamination=float(meta["contamination"]),
        threshold=float(meta["threshold"]),
        n_train=int(meta["n_train"]),
        nodes=nodes,
        signature=json.loads(meta["signature"]),
    )
