"""Run log and model registry as tables.

``training_runs``: one row per training (params, metrics, features, details,
model path); a run that trains again gets a new training id and a new model
folder, so a registered version never changes. ``model_versions``: one row per promotion; the current model is
the highest **integer** version of a name (a string comparison would rank
"9" above "10").
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.sources.tables import RUNS_TABLE, VERSIONS_TABLE, Warehouse

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("model_name", T.StringType(), False),
        T.StructField("training_id", T.IntegerType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("details", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("signature", T.StringType()),
        T.StructField("logged_at", T.TimestampNTZType()),
    ]
)

VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("model_path", T.StringType()),
        T.StructField("registered_at", T.TimestampNTZType()),
    ]
)


def trainings(wh: Warehouse, run_id: str, model_name: str) -> DataFrame:
    return wh.read(RUNS_TABLE, RUNS_SCHEMA).where(
        (F.col("run_id") == run_id) & (F.col("model_name") == model_name)
    )


def next_training(wh: Warehouse, run_id: str, model_name: str, model_root: str) -> tuple[int, str]:
    """(training id, model folder) of the next training of a run."""
    n = trainings(wh, run_id, model_name).count() + 1
    return n, f"{model_root}/{model_name}/{run_id}/{n}"


def log_run(
    wh: Warehouse,
    run_id: str,
    model_name: str,
    training_id: int,
    params: dict,
    metrics: dict,
    features: list[str],
    model_path: str,
    logged_at: str,
    signature: dict | None = None,
) -> None:
    """Append one row per training. Numbers go to ``metrics``; the whole
    document, text and nested values included, to ``details`` as JSON."""
    row = (
        run_id,
        model_name,
        training_id,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if isinstance(v, (int, float))},
        list(features),
        json.dumps(metrics, default=str, sort_keys=True),
        model_path,
        json.dumps(signature) if signature else None,
    )
    df = wh.spark.createDataFrame([row], T.StructType(RUNS_SCHEMA.fields[:-1])).withColumn(
        "logged_at", F.lit(logged_at).cast("timestamp_ntz")
    )
    wh.append_small(RUNS_TABLE, df)


class Registered(str):
    """The version in use after ``register``; ``promoted`` tells whether this
    training is it, ``reason`` why not."""

    promoted: bool
    reason: str | None

    def __new__(cls, version: str, promoted: bool = True, reason: str | None = None):
        out = super().__new__(cls, version)
        out.promoted, out.reason = promoted, reason
        return out


def versions(wh: Warehouse) -> DataFrame:
    return wh.read(VERSIONS_TABLE, VERSIONS_SCHEMA)


def latest_versions(vers: DataFrame) -> DataFrame:
    """Per model name, the row with the highest integer version."""
    return vers.groupBy("model_name").agg(
        F.max_by(F.struct("version", "run_id", "model_path"), F.col("version").cast("int")).alias(
            "v"
        )
    ).select("model_name", "v.version", "v.run_id", "v.model_path")


def register(
    wh: Warehouse,
    run_id: str,
    model_name: str,
    registered_at: str,
    gate: tuple[str, bool] | None = None,
    paired: bool = False,
) -> Registered:
    """R2: promote the last training of a run to version max+1 of
    ``model_name``; a training that has a version keeps it.

    X4, two gates. ``paired``: the training was compared with the current
    version on the same held-out rows (``mae_difference_upper`` in its
    metrics), and is promoted only if the upper end of the interval of the
    difference is below 0. ``gate``: (metric, lower is better), each on its
    own rows. A training that is held back leaves the current version, which
    is returned with ``promoted`` false and the reason."""
    runs = trainings(wh, run_id, model_name)
    run = runs.orderBy(F.desc("training_id")).select("model_path").limit(1).collect()
    if not run:
        raise LookupError(f"no logged run {run_id} for model {model_name}")
    known = versions(wh).where(
        (F.col("model_name") == model_name) & (F.col("model_path") == run[0]["model_path"])
    ).select("version").first()
    if known:
        return Registered(known["version"])
    has_current = (paired or gate) and not versions(wh).where(
        F.col("model_name") == model_name
    ).isEmpty()
    if paired and has_current:
        current, _ = resolve_latest(wh, model_name)
        found = run_metrics(wh, run_id, model_name)
        if "mae_difference_upper" not in found:
            raise LookupError(f"run {run_id} was not compared with version {current}")
        low, up = found["mae_difference_lower"], found["mae_difference_upper"]
        if not up < 0:
            return Registered(
                current, False, f"MAE difference {low:.6g} to {up:.6g} is not below 0"
            )
    if gate and has_current:
        metric, lower_is_better = gate
        current, path = resolve_latest(wh, model_name)
        held = wh.read(RUNS_TABLE, RUNS_SCHEMA).where(F.col("model_path") == path).first()
        if not promotion_gate(
            run_metrics(wh, run_id, model_name), held and dict(held["metrics"]), metric,
            lower_is_better,
        ):
            return Registered(current, False, f"not better than version {current} on {metric}")
    cur = (
        versions(wh)
        .where(F.col("model_name") == model_name)
        .agg(F.max(F.col("version").cast("int")).alias("m"))
        .first()["m"]
    )
    version = str((cur or 0) + 1)
    df = wh.spark.createDataFrame(
        [(model_name, version, run_id, run[0]["model_path"])],
        T.StructType(VERSIONS_SCHEMA.fields[:-1]),
    ).withColumn("registered_at", F.lit(registered_at).cast("timestamp_ntz"))
    wh.append_small(VERSIONS_TABLE, df)
    return Registered(version)


def resolve_latest(wh: Warehouse, model_name: str) -> tuple[str, str]:
    """(version, model_path) of the current model; error if none."""
    row = (
        latest_versions(versions(wh).where(F.col("model_name") == model_name))
        .select("version", "model_path")
        .first()
    )
    if row is None:
        raise LookupError(f"no registered versions for model '{model_name}'")
    return row["version"], row["model_path"]


def promotion_gate(candidate: dict, current: dict | None, metric: str, lower_is_better: bool):
    """Promote only when the candidate beats the current model's metric."""
    if current is None or metric not in current:
        return True
    if lower_is_better:
        return candidate[metric] < current[metric]
    return candidate[metric] > current[metric]


def run_metrics(wh: Warehouse, run_id: str, model_name: str) -> dict | None:
    row = (
        trainings(wh, run_id, model_name)
        .orderBy(F.desc("training_id"))
        .select("metrics")
        .first()
    )
    return dict(row["metrics"]) if row else None
