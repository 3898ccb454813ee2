import json
import tempfile

import pytest
from pyspark.sql import functions as F

from panelops.models import forecast as fc
from panelops.models import iforest, registry, signature
from panelops.sources.tables import Warehouse

STAMP = "2024-01-01 00:00:00"


@pytest.fixture(scope="module")
def train(spark):
    df = spark.range(300).select(
        F.col("id"), (F.col("id") % 17).cast("double").alias("size"), (F.col("id") % 5).alias("count"),
    )
    return df.withColumn("y", F.col("size") * 2 + F.col("count"))


@pytest.fixture(scope="module")
def model(train):
    return fc.fit_forecaster(train, "y", ["size", "count"], max_iter=3)


def test_one_message_names_every_difference(train, model):
    wrong = train.select(F.col("size").alias("sizes"), F.col("count").cast("string").alias("count"))
    with pytest.raises(ValueError) as e:
        fc.predict(wrong, model)
    assert str(e.value) == (
        "input does not fit the model's signature: size is missing (renamed to sizes?); "
        "count is string, not bigint"
    )
    with pytest.raises(ValueError, match="count is missing"):
        fc.predict(train.drop("count"), model)
    extra = fc.predict(train.select("y", "count", "size", F.lit("x").alias("more")), model)
    assert extra.where("prediction is null").count() == 0


def test_null_where_the_model_saw_values(spark, train):
    sig = signature.signature_of(train, ["id"], {"out": "double"})
    assert sig["inputs"][0] == {"name": "id", "type": "bigint", "nullable": False}
    nullable = train.select(F.when(F.col("id") > 3, F.col("id")).alias("id"))
    assert signature.problems(nullable, sig) == ["id may be null"]
    assert signature.problems(train, sig) == []
    signature.enforce(nullable, None)


def test_signatures_are_stored_with_models_and_runs(spark, train, model):
    root = tempfile.mkdtemp(prefix="sig-", dir="/tmp")
    fc.save(model, spark, f"{root}/f")
    assert fc.load(spark, f"{root}/f").signature == model.signature
    forest = iforest.fit_iforest(train, ["size", "y"], ["id"], n_trees=5)
    iforest.save(forest, spark, f"{root}/a")
    again = iforest.load(spark, f"{root}/a")
    assert [o["name"] for o in again.signature["outputs"]] == ["anomaly_score", "is_anomaly"]
    with pytest.raises(ValueError, match="y is int, not double"):
        iforest.decision(train.withColumn("y", F.lit(1)), again)
    wh = Warehouse(spark, f"{root}/wh")
    registry.log_run(wh, "r", "m", 1, {}, {"mae": 1.0}, ["size"], "/p", STAMP, model.signature)
    stored = registry.trainings(wh, "r", "m").first()["signature"]
    assert json.loads(stored) == model.signature


def test_paired_gate_reports_what_it_holds_back(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    runs = [("a", {}), ("b", {"mae_difference_lower": -0.3, "mae_difference_upper": 0.1}),
            ("c", {"mae_difference_lower": -0.4, "mae_difference_upper": -0.2})]
    got = []
    for run, metrics in runs:
        registry.log_run(wh, run, "m", 1, {}, {"mae": 3.0, **metrics}, ["x"], f"/models/{run}", STAMP)
        got.append(registry.register(wh, run, "m", STAMP, paired=True))
    assert got == ["1", "1", "2"] and [g.promoted for g in got] == [True, False, True]
    assert got[1].reason == "MAE difference -0.3 to 0.1 is not below 0"
    registry.log_run(wh, "d", "m", 1, {}, {"mae": 3.0}, ["x"], "/models/d", STAMP)
    with pytest.raises(LookupError, match="not compared"):
        registry.register(wh, "d", "m", STAMP, paired=True)
    held = registry.register(wh, "d", "m", STAMP, gate=("mae", True))
    assert held == "2" and not held.promoted and "not better" in held.reason
