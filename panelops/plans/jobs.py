"""Pipeline jobs (P1-P5): ingest -> validate -> train -> register -> score
-> publish, as plain functions on one SparkSession and one warehouse root.

Every job takes its run id, logical date and wall-clock stamp as arguments
(never the clock), and is idempotent: re-running any job for the same run
leaves the tables as one run would. Lineage is cut where one intermediate
feeds several writes: the classified batch is checkpointed into the shared
checkpoint folder (``spark.checkpoint.dir``), and each job reads its inputs
back from written tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.functions.scalars import input_example
from panelops.models import forecast as fc
from panelops.models import iforest, registry, treeshap
from panelops.operators import checks, evaluate, features, history, report, scoring
from panelops.operators import upsert as up
from panelops.schemas import (
    ANOMALY_FIELDS,
    ANOMALY_MODEL_NAME,
    CONTAMINATION,
    ENTITY,
    FACILITIES,
    FORECAST_FEATURES,
    FORECAST_MODEL_NAME,
    GBT_DEPTH,
    GBT_STEP,
    GBT_TREES,
    IFOREST_TREES,
    KEY,
    PERIOD,
    SEED,
    TOP_FEATURES,
    Z_REASON_THRESHOLD,
)
from panelops.session import cut_lineage, lineage_scope
from panelops.sources import files
from panelops.sources import tables as tb

RAW_COLUMNS = [f.name for f in tb.RAW_REPORT.fields]


@dataclass(frozen=True)
class RunContext:
    run_id: str
    dag_logical_date: str  # yyyy-MM-dd
    now: str  # yyyy-MM-dd HH:mm:ss, the job's wall-clock stamp


def _scoped(fn):
    """Run a job as one transaction inside a lineage scope: its table writes
    become visible together when it returns, and its intermediate cuts are
    deleted then (results are plain dicts)."""
    import functools

    @functools.wraps(fn)
    def wrapper(wh, *args, **kwargs):
        with lineage_scope(wh.spark), wh.transaction():
            return fn(wh, *args, **kwargs)

    return wrapper


# --- P1 -------------------------------------------------------------------------
@_scoped
def ingest(
    wh: tb.Warehouse, facilities: DataFrame, raw: DataFrame, ctx: RunContext, source_file: str
) -> dict:
    """S11 facilities upsert, S10 full refresh of the landing zone, S9 stamp."""
    fac = up.upsert(
        wh.read(tb.FACILITIES_TABLE, FACILITIES) if wh.has(tb.FACILITIES_TABLE)
        else facilities.limit(0),
        facilities,
        keys=[ENTITY],
    )
    wh.replace_small(tb.FACILITIES_TABLE, fac)
    stamped = up.stamp_lineage(
        raw.select(*RAW_COLUMNS), ctx.run_id, ctx.dag_logical_date, source_file, ctx.now
    )
    wh.full_refresh(tb.RAW_TABLE, stamped)
    return {"run_id": ctx.run_id, "raw_rows": wh.read(tb.RAW_TABLE).count()}


# --- P2 -------------------------------------------------------------------------
@_scoped
def validate(wh: tb.Warehouse, ctx: RunContext, retract_scope: str = "same_run") -> dict:
    """S6/S7 -> B1-B5 -> S13+S12 (one merge) -> S14 -> A9 report."""
    batch = wh.read(tb.RAW_TABLE).where(F.col("run_id") == ctx.run_id).select(*RAW_COLUMNS)
    if batch.limit(1).count() == 0:
        raise LookupError(f"no raw_monthly_reports rows for run_id={ctx.run_id}")
    roster = wh.read(tb.FACILITIES_TABLE, FACILITIES)
    classified = cut_lineage(checks.classify(batch, roster))
    clean_rows, quarantined = checks.split(classified, RAW_COLUMNS)
    # Structural constraints of the stored table: nothing is written if one
    # does not hold for the rows to be stored.
    broken = checks.constraint_violations(clean_rows, roster).where("violations > 0").collect()
    if broken:
        raise ValueError(
            "rows to be stored break constraints: "
            + ", ".join(f"{r['rule']} ({r['violations']})" for r in broken)
        )

    touched = classified.select(PERIOD).distinct()
    # The batch's months as a literal list (bounded by the calendar span, a
    # few hundred values at most): static partition pruning, so only the
    # touched months of the stored tables are read.
    months = [r[0] for r in touched.collect()]
    in_batch = F.col(PERIOD).isin(months)
    stored = wh.read(tb.CLEAN_TABLE).where(in_batch)
    incoming = up.stamp_lineage(
        clean_rows, ctx.run_id, ctx.dag_logical_date, ingested_at=ctx.now
    )
    merged = up.upsert_clean(
        stored, incoming, quarantined, ctx.run_id, retract_scope=retract_scope
    )
    merged = cut_lineage(merged, "merged")
    wh.overwrite_touched(tb.CLEAN_TABLE, merged, touched)
    # The entities' moments, from the touched months alone.
    state = history.changed(wh.read(tb.HISTORY_TABLE), stored, merged)
    wh.replace_small(tb.HISTORY_TABLE, cut_lineage(state, "history"))

    # Cascade: scored rows whose key left the clean table go too.
    if wh.has(tb.SCORED_TABLE):
        scored = wh.read(tb.SCORED_TABLE).where(in_batch)
        kept = up.cascade_retraction(scored, wh.read(tb.CLEAN_TABLE).where(in_batch))
        wh.overwrite_touched(tb.SCORED_TABLE, cut_lineage(kept), touched)

    q = up.stamp_lineage(quarantined, ctx.run_id, ctx.dag_logical_date).withColumn(
        "quarantined_at", F.lit(ctx.now).cast("timestamp_ntz")
    )
    wh.replace_partition(tb.QUARANTINE_TABLE, q.select(*tb.SCHEMAS[tb.QUARANTINE_TABLE].names),
                         ctx.run_id)

    gaps = cut_lineage(checks.completeness_gaps(batch, roster), "gaps")
    rep = cut_lineage(
        report.validation_report(classified, gaps, ctx.run_id, ctx.dag_logical_date), "report"
    )
    wh.replace_partition(tb.REPORTS_TABLE, rep, ctx.run_id)
    return rep.first().asDict(recursive=True)


def quality_alert(report_row: dict) -> None:
    """Raise when the report's alert flag is set."""
    if report_row.get("alert_quarantine_rate_exceeded"):
        raise RuntimeError(
            f"quarantine rate {report_row['quarantine_rate']:.1%} exceeds the 10% limit "
            f"for run {report_row['run_id']}"
        )


def _document(wh: tb.Warehouse, values: dict) -> DataFrame:
    """One row with the values as JSON, for the JSON sink."""
    import json

    return wh.spark.createDataFrame(
        [(json.dumps(values, default=str, sort_keys=True),)], "evaluation string"
    )


# --- train ------------------------------------------------------------------------
@_scoped
def train_anomaly(
    wh: tb.Warehouse,
    ctx: RunContext,
    model_root: str,
    ledger: DataFrame | None = None,
    n_trees: int = IFOREST_TREES,
) -> dict:
    """Fit on rows with enough history, score them, evaluate against
    the ledger when given, log the run (R1)."""
    clean = wh.read(tb.CLEAN_TABLE)
    feats = cut_lineage(features.anomaly_features(clean), "features")
    train = features.with_enough_history(feats)
    z = [f"z_{f}" for f in ANOMALY_FIELDS]
    model = iforest.fit_iforest(train, z, KEY, n_trees=n_trees)
    training_id, path = registry.next_training(wh, ctx.run_id, ANOMALY_MODEL_NAME, model_root)
    iforest.save(model, wh.spark, path)
    scored = cut_lineage(iforest.decision(train.select(*KEY, *z), model), "scored")
    files.write_csv(scored, f"{path}/scored_rows")
    metrics = scored.agg(
        F.count_if("is_anomaly").alias("n_flagged"), F.count(F.lit(1)).alias("n_rows_scored")
    ).first().asDict()
    metrics["excluded_insufficient_history"] = feats.where("insufficient_history").count()
    if ledger is not None:
        metrics.update(evaluate.evaluate_against_ground_truth(scored, ledger).first().asDict())
    example = input_example(train, KEY, z).toJSON().collect()  # K9: 5 rows
    files.write_json(_document(wh, metrics), f"{path}/evaluation")
    registry.log_run(
        wh, ctx.run_id, ANOMALY_MODEL_NAME, training_id,
        {"model_type": "IsolationForest", "contamination": CONTAMINATION,
         "n_estimators": n_trees, "random_state": SEED, "z_reason_threshold": Z_REASON_THRESHOLD,
         "input_example": "[" + ",".join(example) + "]"},
        metrics, z, path, ctx.now, model.signature,
    )
    return metrics


@_scoped
def train_forecast(
    wh: tb.Warehouse, ctx: RunContext, model_root: str, max_iter: int = GBT_TREES
) -> dict:
    """Time split, GBT fit on train, MAE vs naive on test, SHAP
    importance of the test rows, log the run (R1)."""
    clean = wh.read(tb.CLEAN_TABLE)
    roster = wh.read(tb.FACILITIES_TABLE, FACILITIES)
    ds = cut_lineage(features.forecast_dataset(clean, roster, require_target=True))
    train, test = features.time_split(ds)
    model = fc.fit_forecaster(train, features.TARGET_COL, max_iter=max_iter)
    training_id, path = registry.next_training(wh, ctx.run_id, FORECAST_MODEL_NAME, model_root)
    fc.save(model, wh.spark, path)
    pred = cut_lineage(fc.predict(test, model), "predictions")
    files.write_csv(
        pred.select(*KEY, features.TARGET_COL, "prediction", "suppression_pct"),
        f"{path}/predictions",
    )
    m = evaluate.forecast_metrics(pred, features.TARGET_COL, "prediction", "suppression_pct")
    metrics = m.first().asDict()
    metrics["train_rows"] = train.count()
    metrics.update(_against_current(wh, pred))
    nodes = fc.tree_nodes(model)
    explained = treeshap.explain(pred, nodes, model.feature_cols, model.label_mean)
    importance = cut_lineage(treeshap.mean_abs_shap(explained, model.feature_cols), "importance")
    files.write_csv(importance, f"{path}/importance")
    top = treeshap.top_features(importance, TOP_FEATURES)
    metrics["top_features_by_shap"] = {r["feature"]: r["mean_abs_shap"] for r in top.collect()}
    metrics["test_month_cutoff"] = str(ds.select(features.cutoff_month(ds)).first()[0])
    example = input_example(test, KEY, list(FORECAST_FEATURES)).toJSON().collect()  # K9
    files.write_json(_document(wh, metrics), f"{path}/evaluation")
    registry.log_run(
        wh, ctx.run_id, FORECAST_MODEL_NAME, training_id,
        {"model_type": "GradientBoostedTrees", "n_estimators": max_iter, "max_depth": GBT_DEPTH,
         "step_size": GBT_STEP, "random_state": SEED, "horizon_months": 3, "test_months_held_out": 4,
         "input_example": "[" + ",".join(example) + "]"},
        metrics, list(FORECAST_FEATURES), path, ctx.now, model.signature,
    )
    return metrics


def _against_current(wh: tb.Warehouse, pred: DataFrame) -> dict:
    """This training against the current version on the same rows; empty
    where there is no version yet."""
    if registry.versions(wh).where(F.col("model_name") == FORECAST_MODEL_NAME).isEmpty():
        return {}
    version, path = registry.resolve_latest(wh, FORECAST_MODEL_NAME)
    both = fc.predict(pred, fc.load(wh.spark, path), "current")
    found = evaluate.paired_mae_difference(both, KEY, features.TARGET_COL, "prediction", "current")
    row = found.first().asDict()
    return {"compared_with_version": version,
            **{k: v for k, v in row.items() if k.startswith("mae_difference") and v is not None}}


# --- P4 -------------------------------------------------------------------------
@_scoped
def score(wh: tb.Warehouse, ctx: RunContext) -> dict:
    """D13 with the registered models, S15 upsert (``scored_at`` keeps its
    first value), A16 summary."""
    va, pa = registry.resolve_latest(wh, ANOMALY_MODEL_NAME)
    vf, pf = registry.resolve_latest(wh, FORECAST_MODEL_NAME)
    a_model, f_model = iforest.load(wh.spark, pa), fc.load(wh.spark, pf)
    clean = wh.read(tb.CLEAN_TABLE)
    roster = wh.read(tb.FACILITIES_TABLE, FACILITIES)
    scored = scoring.score_all(clean, roster, a_model, f_model).select(
        *KEY, "is_anomaly", "anomaly_score", "anomaly_reasons",
        up.nan_to_null(scoring.FORECAST_COL),
        F.lit(str(va)).alias("model_version_anomaly"),
        F.lit(str(vf)).alias("model_version_forecast"),
    )
    scored = up.stamp_lineage(scored, ctx.run_id, ctx.dag_logical_date, ingested_at=ctx.now,
                              ts_col="scored_at")
    scored = cut_lineage(scored)
    stored = wh.read(tb.SCORED_TABLE)
    touched = scored.select(PERIOD).distinct()
    # As in validate: only the months that are scored are read and rewritten.
    months = [r[0] for r in touched.collect()]
    merged = up.upsert(stored.where(F.col(PERIOD).isin(months)), scored, preserve=("scored_at",))
    wh.overwrite_touched(tb.SCORED_TABLE, cut_lineage(merged), touched)
    s = scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if("is_anomaly").alias("n_flagged_anomaly"),
        F.count(scoring.FORECAST_COL).alias("n_forecasted"),
    ).first().asDict()
    s.update(run_id=ctx.run_id, anomaly_model_version=str(va), forecast_model_version=str(vf))
    return s


# --- P5 -------------------------------------------------------------------------
def publish(wh: tb.Warehouse, report_row: dict, summary: dict, out_path: str) -> DataFrame:
    """One document with the validation report and the scoring summary."""
    import json

    doc = {"run_id": report_row.get("run_id"), "validation": report_row,
           "scoring": summary}
    df = wh.spark.createDataFrame([(json.dumps(doc, default=str),)], "document string")
    df.coalesce(1).write.mode("overwrite").text(out_path)
    return df


def monthly_run(
    wh: tb.Warehouse,
    facilities: DataFrame,
    raw: DataFrame,
    ctx: RunContext,
    model_root: str,
    ledger: DataFrame | None = None,
    gbt_iter: int = GBT_TREES,
    iforest_trees: int = IFOREST_TREES,
) -> dict:
    """The whole DAG in order, published as one document below the warehouse
    root. The quality alert is reported there and does not block the run."""
    ingest(wh, facilities, raw, ctx, "raw.parquet")
    rep = validate(wh, ctx)
    a = train_anomaly(wh, ctx, model_root, ledger, iforest_trees)
    f = train_forecast(wh, ctx, model_root, gbt_iter)
    va = registry.register(wh, ctx.run_id, ANOMALY_MODEL_NAME, ctx.now)
    vf = registry.register(wh, ctx.run_id, FORECAST_MODEL_NAME, ctx.now)
    s = score(wh, ctx)
    try:
        quality_alert(rep)
        alert = None
    except RuntimeError as e:
        alert = str(e)
    publish(wh, rep, {**s, "alert": alert}, wh.path(f"published/{ctx.run_id}"))
    return {"report": rep, "anomaly": a, "forecast": f, "versions": (va, vf), "score": s,
            "alert": alert}
