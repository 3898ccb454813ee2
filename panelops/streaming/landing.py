"""Incremental landing of raw report files (X5) with Structured Streaming.

``readStream`` over a folder of Parquet report files (explicit schema);
each micro-batch becomes its own run: its rows are landed into the run's
partition of ``raw_monthly_reports`` and validated with the batch job. Check
semantics become per micro-batch (duplicates and robust statistics are
computed within the batch, as for any single run).

Exactly-once effect: ``foreachBatch`` may replay a batch after a failure;
the run id is derived from the batch id, landing replaces that run's
partition and validation is idempotent per run, so a replay rewrites the same
rows. The stream's checkpoint lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelops.operators import upsert as up
from panelops.plans import jobs
from panelops.schemas import RAW_REPORT
from panelops.session import ensure_checkpoint_dir
from panelops.sources import tables as tb


def _utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def landing_batch_handler(
    wh: tb.Warehouse,
    run_prefix: str,
    dag_logical_date: str,
    clock: Callable[[], str] = _utc_now,
    on_report: Callable[[dict], None] | None = None,
):
    """The ``foreachBatch`` function: land one micro-batch as a run and
    validate it. The wall-clock stamp comes from ``clock`` at the job
    boundary, never from inside an operator."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{run_prefix}-{batch_id:06d}"
        now = clock()
        stamped = up.stamp_lineage(
            batch.select(*RAW_REPORT.names), run_id, dag_logical_date, "stream", now
        ).select(*tb.SCHEMAS[tb.RAW_TABLE].names)
        # The landed rows and what the checks make of them appear together.
        with wh.transaction():
            wh.replace_partition(tb.RAW_TABLE, stamped, run_id)
            if wh.read(tb.RAW_TABLE).where(f"run_id = '{run_id}'").limit(1).count() == 0:
                return  # empty micro-batch: nothing to validate
            report = jobs.validate(wh, jobs.RunContext(run_id, dag_logical_date, now))
        if on_report is not None:
            on_report(report)

    return handle


def start_landing(
    spark: SparkSession,
    source_dir: str,
    wh: tb.Warehouse,
    dag_logical_date: str,
    run_prefix: str = "stream",
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    clock: Callable[[], str] = _utc_now,
    on_report: Callable[[dict], None] | None = None,
):
    """Start the landing stream; returns the ``StreamingQuery``.

    A micro-batch is the batch that the duplicate and outlier checks see. By
    default that is everything that has arrived; ``max_files_per_trigger``
    sets it to so many files (1: every delivered file is a batch of its own).
    """
    if checkpoint_location is None:
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{run_prefix}"
    reader = spark.readStream.schema(RAW_REPORT)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    writer = (
        stream.writeStream.foreachBatch(
            landing_batch_handler(wh, run_prefix, dag_logical_date, clock, on_report)
        )
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start()
