"""Idempotent table maintenance as pure ``DataFrame -> DataFrame`` functions
(S9, S11-S15, R4). Writes live in :mod:`panelops.sources.tables`.

``merge`` folds an upsert and a retraction into one full outer join on the
key, so the stored table and the change set are each shuffled once:

* change ``upsert``  -> the incoming row (``preserve`` columns keep their
  stored value, e.g. ``ingested_at`` keeps its first-insert time);
* change ``retract`` -> the stored row is dropped when it was written by
  this run (or by any run with ``retract_scope='any_run'``), else kept;
* no change          -> the stored row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.schemas import KEY

OP = "_op"


def stamp_lineage(
    df: DataFrame,
    run_id: str,
    dag_logical_date: str,
    source_file: str | None = None,
    ingested_at: str | None = None,
    ts_col: str = "ingested_at",
) -> DataFrame:
    """Literal lineage columns (never the clock inside an operator)."""
    out = df.withColumn("run_id", F.lit(run_id)).withColumn(
        "dag_logical_date", F.to_date(F.lit(dag_logical_date))
    )
    if source_file is not None:
        out = out.withColumn("source_file", F.lit(source_file))
    if ingested_at is not None:
        out = out.withColumn(ts_col, F.lit(ingested_at).cast("timestamp_ntz"))
    return out


def changes(upserts: DataFrame | None, retract_keys: DataFrame | None = None, keys=KEY):
    """Change set: incoming rows tagged ``upsert`` plus keys tagged ``retract``."""
    parts = []
    if upserts is not None:
        parts.append(upserts.withColumn(OP, F.lit("upsert")))
    if retract_keys is not None:
        parts.append(retract_keys.select(*keys).distinct().withColumn(OP, F.lit("retract")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge(
    target: DataFrame,
    change_set: DataFrame,
    keys=KEY,
    preserve=(),
    run_id: str | None = None,
    retract_scope: str = "same_run",
) -> DataFrame:
    """Apply a change set (see module doc) to ``target``; target schema kept."""
    if retract_scope not in ("same_run", "any_run"):
        raise ValueError("retract_scope must be 'same_run' or 'any_run'")
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    c = change_set.select(
        *keys, *[F.col(x).alias(f"_c_{x}") for x in cols if x in change_set.columns], OP
    )
    # Two changes for one key would write it twice; the check shares the join's
    # partitioning by key.
    c = c.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    j = t.join(c, keys, "full_outer")
    op = F.when(
        F.col("_n") > 1, F.raise_error(F.lit("duplicate key in the change set")).cast("string")
    ).otherwise(F.col(OP))
    has_t = F.coalesce(F.col("_t"), F.lit(False))
    if retract_scope == "any_run" or "run_id" not in cols:
        drop_it = op == "retract"
    else:
        drop_it = (op == "retract") & (
            ~has_t | F.coalesce(F.col("_t_run_id") == F.lit(run_id), F.lit(False))
        )

    def value(x: str) -> Column:
        new = F.col(f"_c_{x}") if x in change_set.columns else F.lit(None)
        old = F.col(f"_t_{x}")
        if x in preserve:
            new = F.when(has_t, old).otherwise(new)
        return F.when(op == "upsert", new).otherwise(old).alias(x)

    return j.where(~F.coalesce(drop_it, F.lit(False))).select(*keys, *[value(x) for x in cols])


def upsert(target: DataFrame, incoming: DataFrame, keys=KEY, preserve=()) -> DataFrame:
    """Insert new keys, overwrite existing ones."""
    return merge(target, changes(incoming, None, keys), keys, preserve)


def retract(
    target: DataFrame,
    quarantined: DataFrame,
    run_id: str,
    keys=KEY,
    retract_scope: str = "same_run",
) -> DataFrame:
    """Delete stored rows whose key is now quarantined."""
    return merge(target, changes(None, quarantined, keys), keys, (), run_id, retract_scope)


def upsert_clean(
    target: DataFrame,
    clean: DataFrame,
    quarantined: DataFrame,
    run_id: str,
    keys=KEY,
    preserve=("ingested_at",),
    retract_scope: str = "same_run",
) -> DataFrame:
    """S12 + S13 in one pass: retract this run's now-quarantined keys and
    upsert the clean rows (``ingested_at`` keeps its first value)."""
    return merge(
        target, changes(clean, quarantined, keys), keys, preserve, run_id, retract_scope
    )


def replace_run(target: DataFrame, incoming: DataFrame, run_id: str) -> DataFrame:
    """Drop every stored row of ``run_id`` and add the incoming rows."""
    return target.where(F.col("run_id") != F.lit(run_id)).unionByName(incoming)


def nan_to_null(c: str) -> Column:
    """NaN -> NULL (the scored forecast column)."""
    return F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)).alias(c)


def cascade_retraction(scored: DataFrame, clean: DataFrame, keys=KEY) -> DataFrame:
    """Scored rows whose key is no longer in the clean table are removed
    (the reference would abort on its foreign key instead)."""
    return scored.join(clean.select(*keys), list(keys), "left_semi")
