import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import entry, frame
from panelops.operators import upsert as up
from panelops.plans import jobs
from panelops.sources import tables as tb

TS1, TS2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _stored(spark, rows, run_id, ts=TS1):
    return up.stamp_lineage(frame(spark, rows), run_id, "2024-01-31", ingested_at=ts)


def test_upsert_overwrites_and_preserves_first_insert_time(spark):
    t = _stored(spark, [entry(patients_tested=1), entry(month="2024-02-01")], "run-A")
    inc = _stored(spark, [entry(patients_tested=2), entry(month="2024-03-01")], "run-B", TS2)
    out = {str(r.report_month): r for r in up.upsert(t, inc, preserve=("ingested_at",)).collect()}
    assert len(out) == 3
    jan = out["2019-03-01"]
    assert jan.patients_tested == 2 and jan.run_id == "run-B"
    assert str(jan.ingested_at) == "2024-01-01 00:00:00"
    assert out["2024-02-01"].run_id == "run-A"
    assert str(out["2024-03-01"].ingested_at) == "2024-02-01 00:00:00"


def test_upsert_is_idempotent(spark):
    t = _stored(spark, [entry(), entry(month="2024-02-01")], "run-A")
    inc = _stored(spark, [entry(patients_tested=7)], "run-B", TS2)
    once = up.upsert(t, inc, preserve=("ingested_at",))
    twice = up.upsert(once, inc, preserve=("ingested_at",))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_retraction_same_run_only(spark):
    t = _stored(spark, [entry("A"), entry("B")], "run-A").unionByName(
        _stored(spark, [entry("C")], "run-B"))
    q = frame(spark, [entry("A"), entry("C")])
    kept = {r.facility_id for r in up.retract(t, q, "run-A").collect()}
    assert kept == {"B", "C"}  # C was written by run-B: stays (reference semantics)
    kept_any = {r.facility_id for r in up.retract(t, q, "run-A", retract_scope="any_run").collect()}
    assert kept_any == {"B"}


def test_replace_run(spark):
    t = _stored(spark, [entry("A")], "run-A").unionByName(_stored(spark, [entry("B")], "run-B"))
    new = _stored(spark, [entry("Z")], "run-B")
    assert {r.facility_id for r in up.replace_run(t, new, "run-B").collect()} == {"A", "Z"}


def test_nan_forecast_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "f double")
    assert [r.f for r in df.select(up.nan_to_null("f")).collect()] == [None, 1.0]


def _wh(spark):
    return tb.Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))


def test_full_refresh_replaces_all_runs(spark):
    wh = _wh(spark)
    a = up.stamp_lineage(frame(spark, [entry("A"), entry("B")]), "run-A", "2024-01-31", "a.csv", TS1)
    b = up.stamp_lineage(frame(spark, [entry("C"), entry("D")]), "run-B", "2024-02-29", "b.csv", TS2)
    wh.full_refresh(tb.RAW_TABLE, a)
    wh.full_refresh(tb.RAW_TABLE, b)
    got = wh.read(tb.RAW_TABLE).collect()
    assert len(got) == 2 and {r.run_id for r in got} == {"run-B"}


def test_empty_quarantine_deletes_partition(spark):
    wh = _wh(spark)
    q = up.stamp_lineage(frame(spark, [entry()]).withColumn("quarantine_reason", F.lit("x")),
                         "run-A", "2024-01-31").withColumn(
        "quarantined_at", F.lit(TS1).cast("timestamp_ntz"))
    q = q.select(*tb.SCHEMAS[tb.QUARANTINE_TABLE].names)
    wh.replace_partition(tb.QUARANTINE_TABLE, q, "run-A")
    assert wh.read(tb.QUARANTINE_TABLE).count() == 1
    wh.replace_partition(tb.QUARANTINE_TABLE, q.limit(0), "run-A")
    assert wh.read(tb.QUARANTINE_TABLE).where("run_id = 'run-A'").count() == 0



def test_validate_twice_is_idempotent_and_retracts(spark):
    from panelops.schemas import FACILITIES
    wh = _wh(spark)
    fac = spark.createDataFrame(
        [(i, f"name-{i}", "North", "public", 100, dt.date(2020, 1, 1)) for i in ("H-01", "H-02")],
        FACILITIES)
    rows = [entry("H-01", f"2024-{m:02d}-01") for m in range(1, 7)]
    ctx = jobs.RunContext("run-A", "2024-06-30", TS1)
    jobs.ingest(wh, fac, frame(spark, rows), ctx, "r.csv")
    jobs.validate(wh, ctx)
    first = sorted(wh.read(tb.CLEAN_TABLE).collect())
    jobs.validate(wh, jobs.RunContext("run-A", "2024-06-30", TS2))
    second = sorted(wh.read(tb.CLEAN_TABLE).collect())
    assert first == second and len(first) == 6
    # Same run re-delivers June twice (conflicting): June is retracted from the clean table.
    rows2 = rows + [entry("H-01", "2024-06-01", patients_tested=999)]
    jobs.ingest(wh, fac, frame(spark, rows2), ctx, "r.csv")
    rep = jobs.validate(wh, ctx)
    months = {str(r.report_month) for r in wh.read(tb.CLEAN_TABLE).collect()}
    assert "2024-06-01" not in months and len(months) == 5
    assert rep["quarantine_reasons"] == {"duplicate_facility_month": 2}
    assert wh.read(tb.QUARANTINE_TABLE).count() == 2
    # Another run quarantining May does not retract run-A's May (reference semantics).
    rows3 = [entry("H-01", "2024-05-01"), entry("H-01", "2024-05-01", patients_tested=5)]
    ctx_b = jobs.RunContext("run-B", "2024-07-31", TS2)
    jobs.ingest(wh, fac, frame(spark, rows3), ctx_b, "r.csv")
    jobs.validate(wh, ctx_b)
    months = {str(r.report_month) for r in wh.read(tb.CLEAN_TABLE).collect()}
    assert "2024-05-01" in months
