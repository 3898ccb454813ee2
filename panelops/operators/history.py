"""Incremental history: the moments of every entity's clean rows, kept as a
table and changed by what changes (W1, D13).

Per entity and field the state has the number of rows and the sums of x and
x^2, as exact decimals (measures are fixed-point with at most ``DECIMALS``
places). Sums of exact numbers can be added and taken away again without
trace: after any sequence of inserts, changes and retractions the state is
what a full recompute would give, and a series that has become constant has a
variance of exactly 0.

A run changes the state by (rows of its months as stored after it) minus (rows
of its months as stored before it), so it reads the months it touches and
nothing of the years before. z-scores follow from rows joined with the state
by entity, without a window over the whole history.

Defined cases: a null or NaN measure counts as a row without that value; an
entity whose last row is retracted leaves the state; an empty change leaves
everything as it is; repeated keys count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.schemas import ANOMALY_FIELDS, ENTITY, MIN_HISTORY_MONTHS

DECIMALS = 6
UNITS = "decimal(38,0)"


def state_schema(fields=ANOMALY_FIELDS, entity: str = ENTITY) -> T.StructType:
    cols = [T.StructField(entity, T.StringType()), T.StructField("history_count", T.LongType())]
    for f in fields:
        cols += [T.StructField(f"{m}_{f}", T.DecimalType(38, 0)) for m in ("n", "s1", "s2")]
    return T.StructType(cols)


def _units(field: str) -> Column:
    """The measure in units of 10^-DECIMALS, exactly; null for null and NaN."""
    x = F.nanvl(F.col(field).cast("double"), F.lit(None).cast("double"))
    return F.round(x * F.lit(float(10**DECIMALS)), 0).cast(UNITS)


def moments(rows: DataFrame, fields=ANOMALY_FIELDS, entity: str = ENTITY, sign: int = 1) -> DataFrame:
    """State of ``rows``; with ``sign=-1`` what they take away."""
    value = lambda c: F.coalesce(c, F.lit(0)).cast(UNITS)
    one = F.lit(sign).cast("long")
    cols = []
    for f in fields:
        x = _units(f)
        cols += [
            value(F.when(x.isNotNull(), one)).alias(f"n_{f}"),
            value(x * sign).alias(f"s1_{f}"),
            value((x * x).cast(UNITS) * sign).alias(f"s2_{f}"),
        ]
    return added(rows.select(entity, one.alias("history_count"), *cols), fields, entity)


def added(states: DataFrame, fields=ANOMALY_FIELDS, entity: str = ENTITY) -> DataFrame:
    """One row per entity: the sum of its state rows; entities without rows go."""
    sums = [F.sum("history_count").alias("history_count")]
    for f in fields:
        sums += [F.sum(f"{m}_{f}").cast(UNITS).alias(f"{m}_{f}") for m in ("n", "s1", "s2")]
    schema = state_schema(fields, entity)
    return states.groupBy(entity).agg(*sums).where(F.col("history_count") != 0).select(*schema.names)


def changed(
    state: DataFrame, before: DataFrame, after: DataFrame, fields=ANOMALY_FIELDS, entity: str = ENTITY
) -> DataFrame:
    """The state after the rows ``before`` were replaced by ``after``."""
    delta = moments(before, fields, entity, -1).unionByName(moments(after, fields, entity))
    return added(state.select(*state_schema(fields, entity).names).unionByName(delta), fields, entity)


def touched_entities(before: DataFrame, after: DataFrame, entity: str = ENTITY) -> DataFrame:
    """Entities whose state, hence all of whose z-scores, a change moves:
    those with a row that is not the same before and after it."""
    cols = [entity, *[c for c in after.columns if c != entity and c in before.columns]]
    a, b = after.select(*cols), before.select(*cols)
    return a.exceptAll(b).unionByName(b.exceptAll(a)).select(entity).distinct()


def zscore(field: str) -> Column:
    """(x - mean) / sample std from the state; 0 for a single value or a
    constant series, like W1."""
    n, s1, s2 = (F.col(f"{m}_{field}") for m in ("n", "s1", "s2"))
    scale = F.lit(float(10**DECIMALS))
    # n s2 - s1^2 is exact; only the last division and root are rounded.
    spread = (n * s2).cast(UNITS) - (s1 * s1).cast(UNITS)
    std = F.sqrt(spread.cast("double") / (n.cast("double") * (n - 1).cast("double"))) / scale
    mean = s1.cast("double") / n.cast("double") / scale
    x = F.nanvl(F.col(field).cast("double"), F.lit(None).cast("double"))
    z = F.when((n > 1) & (spread > 0), (x - mean) / std)
    return F.coalesce(z, F.lit(0.0))


def anomaly_features(
    rows: DataFrame,
    state: DataFrame,
    fields=ANOMALY_FIELDS,
    entity: str = ENTITY,
    min_history: int = MIN_HISTORY_MONTHS,
) -> DataFrame:
    """``rows`` with ``z_<field>``, ``history_count`` and
    ``insufficient_history``, like ``features.anomaly_features`` of the whole
    table, from the rows and the state alone."""
    joined = rows.join(state.select(*state_schema(fields, entity).names), entity)
    return joined.select(
        *[F.col(c) for c in rows.columns], *[zscore(f).alias(f"z_{f}") for f in fields],
        "history_count", (F.col("history_count") < F.lit(min_history)).alias("insufficient_history"),
    )
