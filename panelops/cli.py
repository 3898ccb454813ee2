"""Command-line entry points, one per pipeline job (for ``spark-submit``).

    spark-submit --py-files panelops.zip panelops/cli.py ingest --warehouse W --facilities-csv F --reports-csv R \\
        --run-id RUN --dag-logical-date 2024-12-31 --now "2025-01-01 00:00:00"
    ... validate | quality-alert | train-anomaly | train-forecast | register | score | publish
    ... score-entity --facility-id ID | month-board --month 2024-12-01 --out DIR

The logical date and the wall-clock stamp are required arguments; nothing
reads the clock. Each command prints its JSON result and can also write it
to ``--output-file``.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("panelops").getOrCreate()
    from panelops.session import ensure_checkpoint_dir, ship_package

    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _emit(result, output_file: str | None) -> None:
    text = json.dumps(result, default=str)
    print(text)
    if output_file:
        Path(output_file).write_text(text)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="panelops")
    sub = p.add_subparsers(dest="cmd", required=True)

    def add(name, *extra):
        s = sub.add_parser(name)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--output-file")
        for a in extra:
            s.add_argument(*a[0], **a[1])
        return s

    run = (["--run-id"], {"required": True})
    date = (["--dag-logical-date"], {"required": True})
    now = (["--now"], {"required": True, "help": "yyyy-MM-dd HH:mm:ss stamp of this job"})
    models = (["--model-root"], {"required": True})
    add("ingest", run, date, now, (["--facilities-csv"], {"required": True}),
        (["--reports-csv"], {"required": True}))
    add("validate", run, date, now, (["--retract-scope"], {"default": "same_run"}))
    add("train-anomaly", run, date, now, models, (["--ledger-csv"], {}),
        (["--trees"], {"type": int, "default": 200}))
    add("train-forecast", run, date, now, models, (["--trees"], {"type": int, "default": 150}))
    add("register", run, now, (["--model-name"], {"required": True}),
        (["--gate-metric"], {"help": "promote only if better than the current version on it"}),
        (["--higher-is-better"], {"action": "store_true"}),
        (["--paired-gate"], {"action": "store_true", "help": "promote only if the paired "
                             "bootstrap interval of the MAE difference is below 0"}))
    add("score", run, date, now)
    add("quality-alert", (["--report-file"], {"required": True}))
    add("publish", (["--report-file"], {"required": True}), (["--score-file"], {"required": True}),
        (["--out"], {"required": True}))
    add("score-entity", (["--facility-id"], {"required": True}))
    add("month-board", (["--month"], {"required": True}), (["--out"], {"required": True}),
        (["--flagged-only"], {"action": "store_true"}))
    args = p.parse_args(argv)

    from panelops.plans import jobs, views
    from panelops.sources import files
    from panelops.sources import tables as tb

    spark = _session()
    wh = tb.Warehouse(spark, args.warehouse)
    ctx = (
        jobs.RunContext(args.run_id, getattr(args, "dag_logical_date", ""), args.now)
        if hasattr(args, "run_id") and hasattr(args, "now")
        else None
    )
    if args.cmd == "ingest":
        res = jobs.ingest(
            wh, files.read_facilities_csv(spark, args.facilities_csv),
            files.read_reports_csv(spark, args.reports_csv), ctx, args.reports_csv,
        )
    elif args.cmd == "validate":
        res = jobs.validate(wh, ctx, args.retract_scope)
    elif args.cmd == "train-anomaly":
        ledger = files.read_ledger_csv(spark, args.ledger_csv) if args.ledger_csv else None
        res = jobs.train_anomaly(wh, ctx, args.model_root, ledger, args.trees)
    elif args.cmd == "train-forecast":
        res = jobs.train_forecast(wh, ctx, args.model_root, args.trees)
    elif args.cmd == "register":
        from panelops.models import registry

        gate = (args.gate_metric, not args.higher_is_better) if args.gate_metric else None
        done = registry.register(
            wh, args.run_id, args.model_name, args.now, gate, args.paired_gate
        )
        res = {"model_name": args.model_name, "run_id": args.run_id, "version": str(done),
               "promoted": done.promoted, "reason": done.reason}
    elif args.cmd == "score":
        res = jobs.score(wh, ctx)
    elif args.cmd == "quality-alert":
        rep = json.loads(Path(args.report_file).read_text())
        jobs.quality_alert(rep)
        res = {"run_id": rep.get("run_id"), "alert": False}
    elif args.cmd == "publish":
        rep = json.loads(Path(args.report_file).read_text())
        summ = json.loads(Path(args.score_file).read_text())
        jobs.publish(wh, rep, summ, args.out)
        res = {"published": args.out}
    elif args.cmd == "score-entity":
        from panelops.models import forecast as fc
        from panelops.models import iforest, registry
        from panelops.operators import scoring
        from panelops.schemas import ANOMALY_MODEL_NAME, FACILITIES, FORECAST_MODEL_NAME

        va, pa = registry.resolve_latest(wh, ANOMALY_MODEL_NAME)
        vf, pf = registry.resolve_latest(wh, FORECAST_MODEL_NAME)
        row = scoring.score_entity(
            wh.read(tb.CLEAN_TABLE), wh.read(tb.FACILITIES_TABLE, FACILITIES), args.facility_id,
            iforest.load(spark, pa), fc.load(spark, pf), va, vf,
        ).first()
        res = row.asDict(recursive=True)
    else:  # month-board
        from panelops.schemas import FACILITIES

        board = views.month_board(
            wh.read(tb.SCORED_TABLE), wh.read(tb.FACILITIES_TABLE, FACILITIES),
            wh.read(tb.CLEAN_TABLE), args.month,
        )
        if args.flagged_only:
            board = views.flagged(board)
        # The board is written out (JSON lines, reasons kept nested); only the
        # one-row KPIs come back to the driver.
        files.write_json(board, args.out)
        res = {"kpis": views.kpis(board).first().asDict(), "board": args.out}
    _emit(res, args.output_file)
    return 0


if __name__ == "__main__":
    sys.exit(main())
