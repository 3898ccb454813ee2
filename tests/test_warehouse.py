import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import entry, frame
from panelops.operators import features, history
from panelops.operators import upsert as up
from panelops.plans import jobs
from panelops.schemas import ANOMALY_FIELDS, FACILITIES
from panelops.sources import tables as tb

TABLES = [tb.RAW_TABLE, tb.CLEAN_TABLE, tb.QUARANTINE_TABLE, tb.SCORED_TABLE, tb.HISTORY_TABLE,
          tb.FACILITIES_TABLE]
Z = [f"z_{f}" for f in ANOMALY_FIELDS]


def warehouse(spark):
    return tb.Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))


def roster(spark, ids):
    return spark.createDataFrame(
        [(i, f"n-{i}", "North", "public", 100, dt.date(2020, 1, 1)) for i in ids], FACILITIES
    )


def scored_of(clean):
    """A scored table that has every clean row."""
    return clean.select(
        "facility_id", "report_month", F.lit(False).alias("is_anomaly"), F.lit(0.0).alias("anomaly_score"),
        F.lit(None).cast(tb.SCHEMAS[tb.SCORED_TABLE]["anomaly_reasons"].dataType).alias("anomaly_reasons"),
        F.lit(1.0).alias("forecast_next_quarter_suppression_pct"), F.lit("1").alias("model_version_anomaly"),
        F.lit("1").alias("model_version_forecast"), "run_id", "dag_logical_date",
        F.col("ingested_at").alias("scored_at"),
    )


def content(wh, names=TABLES):
    out = {n: sorted(map(str, wh.read(n, FACILITIES if n == tb.FACILITIES_TABLE else None).collect()))
           for n in names}
    out["report"] = wh.entries(tb.REPORTS_TABLE) and sorted(map(str, wh.read(tb.REPORTS_TABLE).collect()))
    return out


def test_a_run_that_fails_at_any_step_changes_nothing(spark, monkeypatch):
    wh = warehouse(spark)
    ids = ["H-01", "H-02"]
    first = jobs.RunContext("run-A", "2024-06-30", "2024-07-01 00:00:00")
    rows = [entry(i, f"2024-{m:02d}-01", patients_tested=200 + 7 * m) for i in ids for m in range(1, 7)]
    jobs.ingest(wh, roster(spark, ids), frame(spark, rows), first, "r.csv")
    jobs.validate(wh, first)
    wh.full_refresh(tb.SCORED_TABLE, scored_of(wh.read(tb.CLEAN_TABLE)))
    second = jobs.RunContext("run-A", "2024-07-31", "2024-08-01 00:00:00")
    rows2 = [*rows[1:], entry("H-02", "2024-06-01", patients_tested=9), entry("H-01", "2024-07-01")]
    jobs.ingest(wh, roster(spark, ids), frame(spark, rows2), second, "r2.csv")
    old = content(wh)

    real, names = tb.Warehouse._write, []

    def failing(at):
        def write(self, name, df):
            names.append(name)
            version = real(self, name, df)  # the files of the step are there, and then
            if len(names) == at:
                raise OSError("lost")
            return version
        return write

    steps = [tb.CLEAN_TABLE, tb.HISTORY_TABLE, tb.SCORED_TABLE, tb.QUARANTINE_TABLE, tb.REPORTS_TABLE]
    for at in range(1, len(steps) + 1):
        names.clear()
        monkeypatch.setattr(tb.Warehouse, "_write", failing(at))
        with pytest.raises(OSError, match="lost"):
            jobs.validate(wh, second)
        assert names == steps[:at]
        assert content(wh) == old and content(tb.Warehouse(spark, wh.root)) == old
    # The manifest itself does not get there.
    names.clear()
    monkeypatch.setattr(tb.Warehouse, "_write", real)
    monkeypatch.setattr(tb.Warehouse, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        jobs.validate(wh, second)
    assert content(wh) == old
    monkeypatch.undo()

    assert len(wh.vacuum()) >= 20 and content(wh) == old
    jobs.validate(wh, second)
    new = content(wh)
    assert all(new[n] != old[n] for n in steps[:4]) and new["report"] != old["report"]
    assert wh.vacuum() == []


def test_readers_keep_their_state_and_writers_do_not_undo_each_other(spark):
    wh, other = warehouse(spark), None
    q = lambda k: up.stamp_lineage(
        frame(spark, [entry(f"H-{k}")]).withColumn("quarantine_reason", F.lit("x")), f"run-{k}", "2024-01-31"
    ).withColumn("quarantined_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).select(
        *tb.SCHEMAS[tb.QUARANTINE_TABLE].names)
    wh.replace_partition(tb.QUARANTINE_TABLE, q(1), "run-1")
    planned = wh.read(tb.QUARANTINE_TABLE)
    wh.replace_partition(tb.QUARANTINE_TABLE, q(1).limit(0), "run-1")
    assert planned.count() == 1 and wh.read(tb.QUARANTINE_TABLE).count() == 0

    other = tb.Warehouse(spark, wh.root)
    with wh.transaction():
        wh.replace_partition(tb.QUARANTINE_TABLE, q(2), "run-2")
        assert other.read(tb.QUARANTINE_TABLE).count() == 0
        other.replace_small(tb.FACILITIES_TABLE, roster(spark, ["H-9"]))  # another table: both stay
        other.append_small("log", spark.range(1))
        wh.append_small("log", spark.range(2))
    assert wh.read(tb.QUARANTINE_TABLE).count() == 1 and wh.read(tb.FACILITIES_TABLE, FACILITIES).count() == 1
    assert other.read("log").count() == 3
    with pytest.raises(tb.WriteConflict):
        with wh.transaction():
            wh.replace_partition(tb.QUARANTINE_TABLE, q(3), "run-3")
            other.replace_partition(tb.QUARANTINE_TABLE, q(3), "run-3")
    with wh.transaction():  # partitions of two runs
        wh.replace_partition(tb.QUARANTINE_TABLE, q(4), "run-4")
        other.replace_partition(tb.QUARANTINE_TABLE, q(5), "run-5")
    assert sorted(r.run_id for r in wh.read(tb.QUARANTINE_TABLE).collect()) == [
        "run-2", "run-3", "run-4", "run-5"]
    with pytest.raises(tb.WriteConflict):
        with wh.transaction():
            wh.replace_partition(tb.QUARANTINE_TABLE, q(2).limit(0), "run-2")
            other.replace_partition(tb.QUARANTINE_TABLE, q(2), "run-2")
    with pytest.raises(ValueError, match="outside"):
        wh.replace_partition(tb.QUARANTINE_TABLE, q(5), "run-6")


def test_partition_values_with_special_characters(spark):
    wh = warehouse(spark)
    q = up.stamp_lineage(frame(spark, [entry()]).withColumn("quarantine_reason", F.lit("x")),
                         "run: a/b=1%", "2024-01-31").withColumn(
        "quarantined_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    q = q.select(*tb.SCHEMAS[tb.QUARANTINE_TABLE].names)
    for _ in range(2):
        wh.replace_partition(tb.QUARANTINE_TABLE, q, "run: a/b=1%")
        assert [r.run_id for r in wh.read(tb.QUARANTINE_TABLE).collect()] == ["run: a/b=1%"]
    wh.replace_partition(tb.QUARANTINE_TABLE, q.limit(0), "run: a/b=1%")
    assert wh.read(tb.QUARANTINE_TABLE).count() == 0


def test_point_lookup_reads_only_where_the_entity_is(spark):
    """Bloom filters and statistics: of twelve months of 2,000 entities, the
    row groups of the two months without the entity give no rows at all."""
    wh = warehouse(spark)
    months = [f"2024-{m:02d}-01" for m in range(1, 13)]
    df = spark.range(2000).select(F.concat(F.lit("H-"), F.col("id")).alias("facility_id")).crossJoin(
        spark.createDataFrame([(m,) for m in months], "m string"))
    df = df.where("not (facility_id = 'H-777' and m in ('2024-03-01', '2024-08-01'))").select(
        "facility_id", F.to_date("m").alias("report_month"), F.lit(5).cast("long").alias("patients_tested"),
        F.lit(1.0).alias("suppression_pct"), F.lit(1.0).alias("drug_stock_level"),
        F.lit(1).alias("reporting_delay_days"))
    stamped = up.stamp_lineage(df, "r", "2024-01-31", ingested_at="2024-01-01 00:00:00").select(
        *tb.SCHEMAS[tb.CLEAN_TABLE].names)
    wh.overwrite_touched(tb.CLEAN_TABLE, stamped, stamped.select("report_month"))
    one = wh.read(tb.CLEAN_TABLE).where("facility_id = 'H-777'")
    assert one.count() == 10

    def rows_read(month):
        hit = wh.read(tb.CLEAN_TABLE).where(
            F.col("report_month").isin(dt.date.fromisoformat(month)) & (F.col("facility_id") == "H-777"))
        hit.collect()
        plan = hit._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        scan = leaves.apply(0)
        if "AdaptiveSparkPlan" in scan.nodeName():
            scan = scan.executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()

    assert rows_read("2024-03-01") == rows_read("2024-08-01") == 0
    assert 0 < rows_read("2024-05-01") <= 2000


def z_of(df):
    return {(r.facility_id, str(r.report_month)): (*(round(r[z], 9) for z in Z), r.history_count)
            for r in df.collect()}


def test_history_follows_late_changed_and_retracted_rows(spark):
    base = [entry(f"H-{k}", f"2024-{m:02d}-01", patients_tested=100 + 13 * k * m % 97,
                  suppression_pct=50.0 + (k + m) / 7 * 0 + round((k * m) % 11 / 4, 4))
            for k in range(6) for m in range(1, 9)]
    base += [entry("H-late", "2024-05-01"), entry("H-gone", "2024-02-01"), entry("H-nan", "2024-01-01", suppression_pct=float("nan"))]
    after = [r for r in base if r[0] != "H-gone" and not (r[0] == "H-3" and str(r[1]) == "2024-04-01")]
    after = [(*r[:2], 7777, *r[3:]) if r[0] == "H-2" and str(r[1]) == "2024-06-01" else r for r in after]
    after += [entry("H-late", "2024-03-01", patients_tested=1), entry("H-new", "2024-08-01")]
    before_df, after_df = frame(spark, base), frame(spark, after)
    state = history.moments(before_df)
    # Only the months that change are handed over.
    changed = ["2024-02-01", "2024-03-01", "2024-04-01", "2024-06-01", "2024-08-01"]
    old, new = (d.where(F.col("report_month").cast("string").isin(changed)) for d in (before_df, after_df))
    updated = history.changed(state, old, new)
    whole = history.moments(after_df)
    assert sorted(updated.collect()) == sorted(whole.collect())
    assert z_of(history.anomaly_features(after_df, updated)) == z_of(features.anomaly_features(
        after_df.withColumn("suppression_pct", F.when(~F.isnan("suppression_pct"), F.col("suppression_pct")))))
    touched = {r.facility_id for r in history.touched_entities(old, new).collect()}
    assert touched == {"H-2", "H-3", "H-late", "H-gone", "H-new"}
    assert sorted(history.changed(updated, new.limit(0), new.limit(0)).collect()) == sorted(updated.collect())


def test_a_series_that_becomes_constant_has_no_spread(spark):
    rows = [entry("H", f"2024-{m:02d}-01", suppression_pct=v) for m, v in ((1, 0.1), (2, 0.3), (3, 0.1), (4, 0.1))]
    df = frame(spark, rows)
    odd = df.where("suppression_pct > 0.2")
    state = history.changed(history.moments(df), odd, odd.limit(0))
    z = history.anomaly_features(df.where("suppression_pct < 0.2"), state)
    assert {r.z_suppression_pct for r in z.collect()} == {0.0}
