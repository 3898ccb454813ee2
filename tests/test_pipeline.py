import json
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelops.models import registry
from panelops.operators import scoring
from panelops.plans import jobs, views
from panelops.plans.inputs import Inputs
from panelops.schemas import ANOMALY_MODEL_NAME, FORECAST_MODEL_NAME
from panelops.sources import tables as tb


def test_monthly_run_end_to_end_and_rerun(spark):
    i = Inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="wh-", dir="/tmp")
    wh = tb.Warehouse(spark, f"{root}/wh")
    ctx = jobs.RunContext("run-1", "2001-12-31", "2002-01-01 00:00:00")
    out = jobs.monthly_run(wh, i.facilities, i.raw, ctx, f"{root}/models", ledger=i.ledger,
                           gbt_iter=5, iforest_trees=30)
    rep = out["report"]
    assert (rep["batch_size"], rep["clean_count"], rep["quarantined_count"]) == (819, 768, 51)
    assert rep["completeness_gap_count"] == 29 and len(rep["completeness_gaps_sample"]) == 20
    assert out["versions"] == ("1", "1")
    assert out["score"]["rows_scored"] == wh.read(tb.SCORED_TABLE).count()
    assert out["forecast"]["test_rows"] > 0 and len(out["forecast"]["top_features_by_shap"]) == 5
    scored_before = sorted(wh.read(tb.SCORED_TABLE).drop("scored_at").collect())
    first_stamp = wh.read(tb.SCORED_TABLE).agg(F.min("scored_at")).first()[0]

    # Re-run validate + score for the same period: same tables; scored_at keeps first insert.
    ctx2 = jobs.RunContext("run-1", "2001-12-31", "2002-02-01 00:00:00")
    jobs.validate(wh, ctx2)
    jobs.score(wh, ctx2)
    assert sorted(wh.read(tb.SCORED_TABLE).drop("scored_at").collect()) == scored_before
    assert wh.read(tb.SCORED_TABLE).agg(F.max("scored_at")).first()[0] == first_stamp

    # Registering the same training again changes nothing; training again makes version 2.
    assert registry.register(wh, "run-1", ANOMALY_MODEL_NAME, "2002-03-01 00:00:00") == "1"
    jobs.train_anomaly(wh, ctx2, f"{root}/models", n_trees=10)
    assert registry.register(wh, "run-1", ANOMALY_MODEL_NAME, "2002-03-01 00:00:00") == "2"
    assert len({v["model_path"] for v in registry.versions(wh).collect()}) == 3
    # The re-run replaced its report; the run's document and artifacts are there.
    assert wh.read(tb.REPORTS_TABLE).where("run_id = 'run-1'").count() == 1
    doc = json.loads(spark.read.text(wh.path("published/run-1")).first().value)
    assert doc["run_id"] == "run-1" and doc["scoring"]["rows_scored"] == out["score"]["rows_scored"]
    for name, parts in ((ANOMALY_MODEL_NAME, ["scored_rows"]),
                        (FORECAST_MODEL_NAME, ["predictions", "importance"])):
        for part in parts:
            assert spark.read.option("header", True).csv(f"{root}/models/{name}/run-1/1/{part}").count()
        assert spark.read.json(f"{root}/models/{name}/run-1/1/evaluation").count() == 1

    # Month board and KPIs for the latest month.
    month = views.available_months(wh.read(tb.SCORED_TABLE)).first()[0]
    board = views.month_board(wh.read(tb.SCORED_TABLE), wh.read(tb.FACILITIES_TABLE),
                              wh.read(tb.CLEAN_TABLE), str(month))
    k = views.kpis(board).first()
    assert k.reporting == board.count() and k.flagged == views.flagged(board).count()
    assert views.versions_in_use(board).count() == 1

    # Point scoring: ok for a known entity, not_found for an unknown one.
    from panelops.models import forecast as fc, iforest
    va, pa = registry.resolve_latest(wh, ANOMALY_MODEL_NAME)
    vf, pf = registry.resolve_latest(wh, FORECAST_MODEL_NAME)
    a, f = iforest.load(spark, pa), fc.load(spark, pf)
    clean = wh.read(tb.CLEAN_TABLE)
    fac = wh.read(tb.FACILITIES_TABLE)
    ok = scoring.score_entity(clean, fac, "S-1", a, f, va, vf).collect()
    assert len(ok) == 1 and ok[0].status == "ok"
    missing = scoring.score_entity(clean, fac, "S-nope", a, f, va, vf).collect()
    assert len(missing) == 1 and missing[0].status == "not_found"
    one_month = clean.limit(1).withColumn("facility_id", F.lit("S-new"))
    short = scoring.score_entity(clean.unionByName(one_month), fac, "S-new", a, f, va, vf).collect()
    assert len(short) == 1 and short[0].status == "insufficient_history"
    assert short[0].is_anomaly is None and short[0].anomaly_score is None


def test_quality_alert_raises():
    import pytest

    jobs.quality_alert({"alert_quarantine_rate_exceeded": False})
    with pytest.raises(RuntimeError):
        jobs.quality_alert({"alert_quarantine_rate_exceeded": True, "quarantine_rate": 0.2,
                            "run_id": "r"})


def test_publish_writes_one_document(spark):
    import json
    import tempfile as tf

    root = tf.mkdtemp(prefix="pub-", dir="/tmp")
    wh = tb.Warehouse(spark, root)
    jobs.publish(wh, {"run_id": "r1", "batch_size": 3}, {"rows_scored": 2}, f"{root}/summary")
    text = spark.read.text(f"{root}/summary").collect()
    doc = json.loads(text[0].value)
    assert doc["run_id"] == "r1" and doc["scoring"]["rows_scored"] == 2


def test_lineage_scope_deletes_its_cuts(spark):
    import os

    from panelops.session import cut_lineage, lineage_scope

    with lineage_scope(spark):
        df = cut_lineage(spark.range(10), "t")
        path = df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
        assert df.count() == 10 and os.path.exists(path)
    assert not os.path.exists(path)


def test_scopes_of_two_threads_are_apart(spark):
    import threading

    from panelops.session import cut_lineage, lineage_scope

    made, go_on = threading.Event(), threading.Event()
    got = []

    def other():
        with lineage_scope(spark):
            df = cut_lineage(spark.range(7), "other")
            made.set()
            go_on.wait(60)
            got.append(df.count())

    t = threading.Thread(target=other)
    t.start()
    with lineage_scope(spark):
        assert made.wait(60)
        cut_lineage(spark.range(3), "mine")
    go_on.set()
    t.join()
    assert got == [7]


def test_a_month_gets_few_files_and_bad_rows_are_refused(spark):
    import glob

    from conftest import entry, frame, history
    import pytest

    from panelops.operators import upsert as up
    from panelops.schemas import FACILITIES

    wh = tb.Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    rows = [e for k in range(40) for e in history(f"H-{k}", "patients_tested", [3_000_000_000 + k] * 12)]
    df = up.stamp_lineage(frame(spark, rows), "r", "2024-01-31", ingested_at="2024-01-01 00:00:00")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wh.overwrite_touched(tb.CLEAN_TABLE, df.repartition(64), df.select("report_month"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = glob.glob(f"{wh.path(tb.CLEAN_TABLE)}/v=*/report_month=*/*.parquet")
    assert len(files) <= 12 * tb.FILES_PER_VALUE and wh.read(tb.CLEAN_TABLE).count() == len(rows)

    one = df.limit(1)
    with pytest.raises(Exception, match="duplicate key"):
        up.upsert(df.limit(0), one.unionByName(one)).collect()

    fac = spark.createDataFrame([("H-01", "n", "North", "public", 1, None)], FACILITIES)
    ctx = jobs.RunContext("r", "2024-06-30", "2024-07-01 00:00:00")
    jobs.ingest(wh, fac, frame(spark, [entry(), entry(month="2019-04-01", suppression_pct=None)]),
                ctx, "r.csv")
    with pytest.raises(ValueError, match="not_null_suppression_pct"):
        jobs.validate(wh, ctx)
