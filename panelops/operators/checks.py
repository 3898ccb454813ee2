"""Row-level quality checks, classification and completeness gaps.

All checks are evaluated on the **full** batch (orphans, copies and
range-violating rows included) before the first-violation-wins reason is
chosen.

Plan shape (one batch):

* per-entity robust statistics come from an unpivoted (entity, field,
  value) -> count pre-aggregate, so copies collapse map-side and a hot entity
  never ships raw rows to one reducer; medians are exact (a percentile
  aggregate under a checked bound, the distributed selection of
  ``functions.quantiles`` above it);
* the roster flag is a join with the distinct roster ids (AQE broadcasts them
  when their run-time bytes are small);
* the robust statistics (one row per entity) are joined back on ``entity``;
* duplicate keys come from a partial ``groupBy(key).count()`` and only keys
  seen twice are joined back on the full key.

The join-backs are plain equi-joins: AQE broadcasts them when the runtime side
is small and splits skewed batch partitions when one entity is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.functions.quantiles import (
    DEFAULT_MAX_GROUP_VALUES,
    choose_strategy,
    weighted_quantile,
)
from panelops.schemas import (
    ENTITY,
    MAD_SCALE,
    OUTLIER_FIELDS,
    OUTLIER_Z_THRESHOLD,
    PERIOD,
    RANGE_RULES,
    REASON_DUPLICATE,
    REASON_OUTLIER,
    REASON_UNKNOWN,
)
from panelops.session import cut_lineage

REASON = "quarantine_reason"


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# --- B3 ---------------------------------------------------------------------
def measure(field: str) -> Column:
    """A measure as a number; NaN counts as missing (Spark would order it
    above every number and so flag it)."""
    return F.nanvl(F.col(field).cast("double"), F.lit(None).cast("double"))


def range_violation(field: str, lo, hi) -> Column:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (measure(field) < F.lit(float(lo)))
    if hi is not None:
        bad = bad | (measure(field) > F.lit(float(hi)))
    return _false_if_null(bad)


def check_ranges(df: DataFrame, rules: dict = RANGE_RULES) -> DataFrame:
    """One boolean ``range_<field>`` column per rule, True = violation."""
    return df.select(
        "*", *[range_violation(f, lo, hi).alias(f"range_{f}") for f, (lo, hi) in rules.items()]
    )


# --- B1 ---------------------------------------------------------------------
def known_entities(roster: DataFrame, entity: str = ENTITY) -> DataFrame:
    return roster.select(entity).distinct().withColumn("_known", F.lit(True))


def check_referential(df: DataFrame, roster: DataFrame, entity: str = ENTITY) -> DataFrame:
    """Adds ``is_known``: True where the entity is on the roster."""
    known = known_entities(roster, entity)
    return df.join(known, entity, "left").select(
        *[F.col(c) for c in df.columns], _false_if_null(F.col("_known")).alias("is_known")
    )


# --- B2 / A5 / W6 -----------------------------------------------------------
def key_counts(df: DataFrame, keys=(ENTITY, PERIOD)) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df: DataFrame, keys=(ENTITY, PERIOD)) -> DataFrame:
    return key_counts(df, keys).where(F.col("n_rows") > 1).select(*keys)


def check_duplicates(df: DataFrame, keys=(ENTITY, PERIOD)) -> DataFrame:
    """Adds ``is_duplicate``: every row of a key seen more than once."""
    dups = duplicate_keys(df, keys).withColumn("_dup", F.lit(True))
    return df.join(dups, list(keys), "left").select(
        *[F.col(c) for c in df.columns], _false_if_null(F.col("_dup")).alias("is_duplicate")
    )


# --- B4 / A3 / A4 -----------------------------------------------------------
def value_counts_long(df: DataFrame, fields=OUTLIER_FIELDS, entity: str = ENTITY) -> DataFrame:
    """(entity, field, value, cnt) over the non-null values of ``fields``."""
    stacked = df.select(
        entity,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), measure(f).alias("value"))
                    for f in fields
                ]
            )
        ).alias("fv"),
    ).select(entity, "fv.field", "fv.value")
    return (
        stacked.where(F.col("value").isNotNull())
        .groupBy(entity, "field", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def robust_stats_long(
    df: DataFrame,
    fields=OUTLIER_FIELDS,
    entity: str = ENTITY,
    max_group_values: int = DEFAULT_MAX_GROUP_VALUES,
) -> DataFrame:
    """(entity, field, median, mad): exact interpolated medians over the
    value counts; MAD = median of |value - median| with the same weights.

    A per-(entity, field) percentile aggregate is used while every group has
    at most ``max_group_values`` distinct values (checked); beyond that the
    exact distributed selection of :mod:`panelops.functions.quantiles` splits
    hot groups over many tasks.
    """
    vc = value_counts_long(df, fields, entity)
    keys = [entity, "field"]
    # Read by the size check and by both medians.
    vc = cut_lineage(vc, "values")
    strategy = choose_strategy(vc, keys, max_group_values)
    if strategy == "aggregate":
        # One shuffle by entity: the window, both aggregates and the pivot of the
        # caller share it (the check bounds what an entity brings).
        half, cnt = F.lit(0.5), F.col("cnt")
        median = F.percentile(F.col("value"), half, cnt).over(Window.partitionBy(*keys))
        return (
            vc.repartition(entity)
            .withColumn("median", median)
            .groupBy(*keys)
            .agg(
                F.first("median").alias("median"),
                F.percentile(F.abs(F.col("value") - F.col("median")), half, cnt).alias("mad"),
            )
        )
    med = weighted_quantile(vc, keys, "value", "cnt", 0.5, "median", strategy=strategy)
    dev = vc.join(med, keys).select(
        *keys, F.abs(F.col("value") - F.col("median")).alias("value"), "cnt"
    )
    mad = weighted_quantile(dev, keys, "value", "cnt", 0.5, "mad", strategy=strategy)
    return med.join(mad, keys)


def robust_stats_wide(
    df: DataFrame,
    fields=OUTLIER_FIELDS,
    entity: str = ENTITY,
    max_group_values: int = DEFAULT_MAX_GROUP_VALUES,
) -> DataFrame:
    """One row per entity: ``med_<f>``, ``mad_<f>`` for every field."""
    long = robust_stats_long(df, fields, entity, max_group_values)
    aggs = []
    for f in fields:
        aggs.append(F.max(F.when(F.col("field") == f, F.col("median"))).alias(f"med_{f}"))
        aggs.append(F.max(F.when(F.col("field") == f, F.col("mad"))).alias(f"mad_{f}"))
    return long.groupBy(entity).agg(*aggs)


def robust_outlier(field: str, threshold: float = OUTLIER_Z_THRESHOLD) -> Column:
    mad = F.nullif(F.col(f"mad_{field}"), F.lit(0.0))
    z = F.abs(measure(field) - F.col(f"med_{field}")) / (mad * F.lit(MAD_SCALE))
    return _false_if_null(z > F.lit(threshold))


def check_statistical_outliers(
    df: DataFrame, fields=OUTLIER_FIELDS, entity: str = ENTITY
) -> DataFrame:
    """Adds ``is_outlier``: robust z above the threshold on any field."""
    stats = robust_stats_wide(df, fields, entity)
    flag = F.lit(False)
    for f in fields:
        flag = flag | robust_outlier(f)
    return df.join(stats, entity, "left").select(
        *[F.col(c) for c in df.columns], flag.alias("is_outlier")
    )


# --- B5 / B6 ------------------------------------------------------------------
def classify(
    batch: DataFrame,
    roster: DataFrame,
    entity: str = ENTITY,
    period: str = PERIOD,
    rules: dict = RANGE_RULES,
    fields=OUTLIER_FIELDS,
    outlier_threshold: float = OUTLIER_Z_THRESHOLD,
    max_group_values: int = DEFAULT_MAX_GROUP_VALUES,
) -> DataFrame:
    """Batch rows plus the check flags and ``quarantine_reason`` (NULL = clean).

    Priority: unknown id > duplicate key > range rules in rule order >
    statistical outlier.
    """
    stats = robust_stats_wide(batch, fields, entity, max_group_values)
    known = known_entities(roster, entity)
    dups = duplicate_keys(batch, (entity, period)).withColumn("_dup", F.lit(True))
    joined = (
        batch.join(known, entity, "left")
        .join(stats, entity, "left")
        .join(dups, [entity, period], "left")
    )
    outlier = F.lit(False)
    for f in fields:
        outlier = outlier | robust_outlier(f, outlier_threshold)
    range_cols = {f"range_{f}": range_violation(f, lo, hi) for f, (lo, hi) in rules.items()}
    flagged = joined.select(
        *[F.col(c) for c in batch.columns],
        _false_if_null(F.col("_known")).alias("is_known"),
        _false_if_null(F.col("_dup")).alias("is_duplicate"),
        *[v.alias(k) for k, v in range_cols.items()],
        outlier.alias("is_outlier"),
    )
    reason = F.coalesce(
        F.when(~F.col("is_known"), F.lit(REASON_UNKNOWN)),
        F.when(F.col("is_duplicate"), F.lit(REASON_DUPLICATE)),
        *[F.when(F.col(k), F.lit(k)) for k in range_cols],
        F.when(F.col("is_outlier"), F.lit(REASON_OUTLIER)),
    )
    return flagged.withColumn(REASON, reason)


def split(classified: DataFrame, batch_columns: list[str]):
    """(clean, quarantined) projections of one classified DataFrame."""
    clean = classified.where(F.col(REASON).isNull()).select(*batch_columns)
    quarantined = classified.where(F.col(REASON).isNotNull()).select(*batch_columns, REASON)
    return clean, quarantined


# --- J7 / U4 ------------------------------------------------------------------
def completeness_gaps(
    batch: DataFrame, roster: DataFrame, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """(entity, period) pairs of roster entities missing from the batch, over
    the months observed anywhere in the batch.

    The expected roster x month grid is never built. The months of the batch
    are numbered (a list bounded by the calendar span); an entity's months are
    a few 64-bit words with one bit per month, set by ``bit_or``: fixed bytes
    per entity whatever the number of its rows, added up per task before the
    shuffle. Joined to the roster, only the months whose bit is missing are
    exploded, so the output rows are the gaps themselves. Rows without a month
    count for no month.
    """
    found = batch.where(F.col(period).isNotNull()).select(period).distinct()
    months = sorted(r[0] for r in found.collect())
    if not months:
        return roster.select(entity, F.lit(None).cast(batch.schema[period].dataType).alias(period)).limit(0)
    at = F.array_position(F.lit(months), F.col(period)) - 1
    words = -(-len(months) // 64)
    place = F.pmod("_at", F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    present = (
        batch.where(F.col(period).isNotNull()).select(entity, at.alias("_at")).groupBy(entity)
        .agg(*[
            F.bit_or(F.when(F.floor(F.col("_at") / 64) == w, bit).otherwise(F.lit(0).cast("bigint")))
            .alias(f"_w{w}") for w in range(words)
        ])
    )
    have = F.array(*[F.coalesce(f"_w{w}", F.lit(0).cast("bigint")) for w in range(words)])
    missing = F.filter(
        F.sequence(F.lit(0), F.lit(len(months) - 1)),
        lambda i: F.getbit(F.get("_have", F.floor(i / 64).cast("int")), F.pmod(i, F.lit(64)).cast("int")) == 0,
    )
    return (
        roster.select(entity)
        .distinct()
        .join(present, entity, "left")
        .select(entity, have.alias("_have"))
        .select(entity, F.explode(missing).alias("_at"))
        .select(entity, F.element_at(F.lit(months), F.col("_at") + 1).alias(period))
    )


def classify_batch(batch: DataFrame, roster: DataFrame, entity: str = ENTITY, period: str = PERIOD):
    """(clean, quarantined, gaps) like the reference's batch classifier."""
    classified = classify(batch, roster, entity, period)
    clean, quarantined = split(classified, batch.columns)
    return clean, quarantined, completeness_gaps(batch, roster, entity, period)


# --- B9 -------------------------------------------------------------------------
def constraint_violations(
    table: DataFrame, roster: DataFrame, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Structural constraints of the clean fact table as a report: one row
    per rule with the number of violating rows (0 = holds). Rules: NOT NULL
    on key and measures, unique key, entity on the roster, and the CHECK
    constraints (patients >= 0, 0 <= suppression <= 100, stock >= 0 with no
    upper bound, delay >= 0). NULL measures are reported, not fatal."""
    keyed = table.join(
        duplicate_keys(table, (entity, period)).withColumn("_dup", F.lit(True)),
        [entity, period],
        "left",
    ).join(known_entities(roster, entity), entity, "left")
    measures = ["patients_tested", "suppression_pct", "drug_stock_level", "reporting_delay_days"]
    rules = [(f"not_null_{c}", F.col(c).isNull()) for c in [entity, period, *measures]]
    rules += [
        ("unique_key", F.coalesce(F.col("_dup"), F.lit(False))),
        ("foreign_key_facility", F.col("_known").isNull()),
        ("check_patients_tested", F.col("patients_tested") < 0),
        ("check_suppression_pct",
         (F.col("suppression_pct") < 0) | (F.col("suppression_pct") > 100)),
        ("check_drug_stock_level", F.col("drug_stock_level") < 0),
        ("check_reporting_delay_days", F.col("reporting_delay_days") < 0),
    ]
    counts = keyed.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n, _ in rules])
        ).alias("r")
    ).select("r.rule", "r.violations")
