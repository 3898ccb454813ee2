import tempfile

import pytest

from panelops.models import registry
from panelops.sources.tables import Warehouse


def test_register_and_resolve_integer_versions(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    with pytest.raises(LookupError):
        registry.resolve_latest(wh, "m")
    for k in range(10):
        registry.log_run(wh, f"r{k}", "m", 1, {"a": 1}, {"mae": 1.0 + k, "top": {"x": 0.5}}, ["x"],
                         f"/p/{k}", "2024-01-01 00:00:00")
        assert registry.register(wh, f"r{k}", "m", "2024-01-01 00:00:00") == str(k + 1)
    version, path = registry.resolve_latest(wh, "m")
    assert version == "10" and path == "/p/9"  # "9" > "10" as strings: must compare as ints
    with pytest.raises(LookupError):
        registry.register(wh, "nope", "m", "2024-01-01 00:00:00")
    assert registry.run_metrics(wh, "r3", "m") == {"mae": 4.0}


def test_training_again_keeps_what_is_registered(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    stamp = "2024-01-01 00:00:00"
    paths = []
    for k in (1, 2):
        n, path = registry.next_training(wh, "r", "m", "/models")
        assert n == k
        registry.log_run(wh, "r", "m", n, {}, {"mae": 5.0 - k, "cutoff": "2024-01"}, ["x"], path, stamp)
        paths.append(path)
        assert registry.register(wh, "r", "m", stamp) == str(k)
        assert registry.register(wh, "r", "m", stamp) == str(k)  # the same training again
    assert len(set(paths)) == 2
    kept = {v["version"]: v["model_path"] for v in registry.versions(wh).collect()}
    assert kept == {"1": paths[0], "2": paths[1]}
    details = [r["details"] for r in registry.trainings(wh, "r", "m").collect()]
    assert len(details) == 2 and all('"cutoff": "2024-01"' in d for d in details)


def test_register_behind_a_gate(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    stamp = "2024-01-01 00:00:00"
    got = []
    for run, mae in (("a", 3.0), ("b", 4.0), ("c", 2.0)):
        registry.log_run(wh, run, "m", 1, {}, {"mae": mae}, ["x"], f"/models/{run}", stamp)
        got.append(registry.register(wh, run, "m", stamp, gate=("mae", True)))
    assert got == ["1", "1", "2"]
    assert registry.resolve_latest(wh, "m") == ("2", "/models/c")


def test_promotion_gate():
    assert registry.promotion_gate({"mae": 1.0}, None, "mae", True)
    assert registry.promotion_gate({"mae": 1.0}, {"mae": 2.0}, "mae", True)
    assert not registry.promotion_gate({"mae": 3.0}, {"mae": 2.0}, "mae", True)
