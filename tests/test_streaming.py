import datetime as dt
import tempfile

from conftest import entry, frame
from panelops.schemas import FACILITIES
from panelops.sources import tables as tb
from panelops.streaming.landing import start_landing


def test_each_micro_batch_is_a_validated_run(spark):
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    wh = tb.Warehouse(spark, f"{root}/wh")
    fac = spark.createDataFrame([("H-01", "n", "North", "public", 100, dt.date(2020, 1, 1))],
                                FACILITIES)
    wh.replace_small(tb.FACILITIES_TABLE, fac)
    src = f"{root}/in"
    frame(spark, [entry(month=f"2024-{m:02d}-01") for m in range(1, 4)]).coalesce(1) \
        .write.mode("append").parquet(src)
    frame(spark, [entry(month="2024-04-01"), entry(month="2024-04-01", patients_tested=7),
                  entry("H-99", "2024-05-01")]).coalesce(1).write.mode("append").parquet(src)
    reports = []
    q = start_landing(spark, src, wh, "2024-12-31", run_prefix="s", max_files_per_trigger=1,
                      checkpoint_location=f"{root}/ckpt", clock=lambda: "2025-01-01 00:00:00",
                      on_report=reports.append)
    q.awaitTermination(300)
    assert len(reports) == 2
    runs = {r.run_id for r in wh.read(tb.RAW_TABLE).select("run_id").distinct().collect()}
    assert runs == {"s-000000", "s-000001"}
    assert wh.read(tb.CLEAN_TABLE).count() == 3
    q_rows = wh.read(tb.QUARANTINE_TABLE).collect()
    assert sorted(r.quarantine_reason for r in q_rows) == [
        "duplicate_facility_month", "duplicate_facility_month", "unknown_facility_id"]
    # A restart with the same checkpoint processes nothing new.
    q2 = start_landing(spark, src, wh, "2024-12-31", run_prefix="s", max_files_per_trigger=1,
                       checkpoint_location=f"{root}/ckpt", clock=lambda: "2025-01-02 00:00:00",
                       on_report=reports.append)
    q2.awaitTermination(300)
    assert len(reports) == 2
