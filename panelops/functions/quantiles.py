"""Exact quantiles, safe for hot groups.

``weighted_quantile(df, groups, value, weight, q)`` returns one row per
group with the interpolated q-quantile of the multiset in which ``value``
occurs ``weight`` times (Spark's ``percentile`` semantics: position
``(n - 1) * q``, linear interpolation between the neighbouring ranks).

Two exact strategies with the same result to the bit, chosen from a checked
bound on the group sizes (a choice of plan only):

* every group has at most ``max_group_values`` distinct values: a plain
  ``percentile(value, q, weight)`` aggregate (its buffer holds one entry per
  distinct value, so the bound is the memory bound);
* otherwise a guided selection. A KLL sketch per group (mergeable, a few
  kilobytes) proposes cut points; one pass counts the weight between them
  exactly, which tells the slot that holds the wanted rank, and how much lies
  before it; one more pass takes the rows of that slot alone and picks the
  value. The sketch decides how large the slots are and nothing else: any
  cut points give the same value. No pass shuffles a group's values whole.

``ranked_values(df, columns, ranks)`` selects many ranks of many columns of
one table the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelops.session import cut_lineage

DEFAULT_MAX_GROUP_VALUES = 1_000_000
# Sketch sizes and numbers of slots: per group, and for whole columns.
GROUP_SKETCH, GROUP_SLOTS = 400, 64
SKETCH, SLOTS = 4096, 1024


def weighted_quantile(
    df: DataFrame,
    groups: list[str],
    value: str,
    weight: str,
    q: float,
    out: str = "quantile",
    max_group_values: int = DEFAULT_MAX_GROUP_VALUES,
    strategy: str = "auto",
) -> DataFrame:
    """``strategy``: ``auto`` (checked bound), ``aggregate`` or ``distributed``."""
    groups = list(groups)
    if strategy == "auto":
        strategy = choose_strategy(df, groups, max_group_values)
    if strategy == "aggregate":
        agg = F.percentile(F.col(value), F.lit(q), F.col(weight)).alias(out)
        return df.groupBy(*groups).agg(agg) if groups else df.agg(agg)
    return distributed_quantile(df, groups, value, weight, q, out)


def choose_strategy(df: DataFrame, groups: list[str], max_group_values: int) -> str:
    """``aggregate`` when no group has more than ``max_group_values`` rows
    (distinct values, for pre-aggregated input), else ``distributed``."""
    sizes = (
        df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_m"))
        if groups
        else df.agg(F.count(F.lit(1)).alias("_m"))
    )
    biggest = sizes.agg(F.max("_m")).first()[0] or 0
    return "aggregate" if biggest <= max_group_values else "distributed"


def distributed_quantile(
    df: DataFrame, groups: list[str], value: str, weight: str, q: float, out: str = "quantile"
) -> DataFrame:
    """Exact selection guided by a sketch per group."""
    keys = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys, strict=False)] or [F.lit(0).alias("_g0")]
    base = df.select(*named, F.col(value).cast("double").alias("_v"),
                     F.col(weight).cast("bigint").alias("_w"))
    base = base.where(F.col("_v").isNotNull() & (F.col("_w") > 0))
    grid = F.array(*[F.lit(i / GROUP_SLOTS) for i in range(1, GROUP_SLOTS)])
    sketch = F.kll_sketch_agg_double("_v", F.lit(GROUP_SKETCH))
    cuts = base.groupBy(*keys).agg(sketch.alias("_s")).select(
        *[F.col(k).alias(f"{k}c") for k in keys],
        F.array_distinct(F.kll_sketch_get_quantile_double("_s", grid)).alias("_cuts"),
    )
    same = lambda mark: [F.col(k).eqNullSafe(F.col(f"{k}{mark}")) for k in keys]
    slot = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    # Read twice, and a sketch that is drawn again may cut elsewhere.
    placed = cut_lineage(
        base.join(cuts, same("c")).select(*keys, "_v", "_w", slot.alias("_slot")), "slots"
    )
    slots = placed.groupBy(*keys, "_slot").agg(F.sum("_w").alias("_sw"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ranked = slots.select(
        *keys, "_slot", "_sw", F.coalesce(F.sum("_sw").over(before), F.lit(0)).alias("_off"),
        F.sum("_sw").over(group).alias("_n"),
    )
    pos = (F.col("_n") - F.lit(1)).cast("double") * F.lit(q)
    lo, hi = F.floor(pos), F.ceil(pos)

    def holds(rank, start, end):
        return (start <= rank) & (rank < end)

    start, end = F.col("_off"), F.col("_off") + F.col("_sw")
    wanted = ranked.where(holds(lo, start, end) | holds(hi, start, end)).select(
        *[F.col(k).alias(f"{k}s") for k in keys], F.col("_slot").alias("_slots"), "_off", "_n"
    )
    upto = Window.partitionBy(*keys, "_slot").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, 0
    )
    inside = placed.join(wanted, [*same("s"), F.col("_slot") == F.col("_slots")]).select(
        *keys, "_v", "_n", (F.col("_off") + F.sum("_w").over(upto)).alias("_end"), "_w"
    )
    start, end = F.col("_end") - F.col("_w"), F.col("_end")
    picked = inside.where(holds(lo, start, end) | holds(hi, start, end))
    res = picked.groupBy(*keys).agg(
        F.max(F.when(holds(lo, start, end), F.col("_v"))).alias("_vlo"),
        F.max(F.when(holds(hi, start, end), F.col("_v"))).alias("_vhi"),
        F.max(pos).alias("_pos"),
    )
    # The arithmetic of Spark's ``percentile``, so both strategies agree to the bit.
    lower, higher = F.floor("_pos"), F.ceil("_pos")
    between = (higher - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - lower) * F.col("_vhi")
    flat = (lower == higher) | (F.col("_vlo") == F.col("_vhi"))
    back = [F.col(k).alias(g) for g, k in zip(groups, keys, strict=False)]
    return res.select(*back, F.when(flat, F.col("_vlo")).otherwise(between).alias(out))


def ranked_values(df: DataFrame, columns: list[str], ranks: list[int]) -> list[list[float]]:
    """Per column, the distinct values at the given ranks (from 0) of its
    ascending order. Columns are numbers without nulls and NaN.

    The driver gets the cut points, one count per slot, and the values.
    """
    df = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    names = df.columns
    grid = F.array(*[F.lit(i / SLOTS) for i in range(1, SLOTS)])
    sketches = df.agg(*[F.kll_sketch_agg_double(c, F.lit(SKETCH)).alias(c) for c in names])
    row = sketches.select(
        *[F.kll_sketch_get_quantile_double(c, grid).alias(c) for c in names]
    ).first()
    cuts = [np.unique(np.array(row[c], float)) for c in names]

    def slots_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        x = batch.column(i).to_numpy(zero_copy_only=False)
        return x, np.searchsorted(cuts[i], x, side="left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(c) + 1, np.int64) for c in cuts]
        for batch in batches:
            for i in range(len(names)):
                total[i] += np.bincount(slots_of(batch, i)[1], minlength=len(total[i]))
        at = [(i, s) for i, t in enumerate(total) for s in range(len(t))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at]), pa.array([s for _, s in at]), pa.array(np.concatenate(total))],
            names=["i", "slot", "n"],
        )

    counted = df.mapInArrow(count, "i long, slot long, n long").groupBy("i", "slot").agg(
        F.sum("n").alias("n")
    )
    sizes = [np.zeros(len(c) + 1, np.int64) for c in cuts]
    for r in counted.collect():
        sizes[r["i"]][r["slot"]] = r["n"]
    starts = [np.cumsum(s) - s for s in sizes]
    holding = [
        np.unique(np.searchsorted(np.cumsum(s), np.array(ranks), side="right")) for s in sizes
    ]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(names)):
                x, slot = slots_of(batch, i)
                mine = np.isin(slot, holding[i])
                v, n = np.unique(x[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(v), i)),
                        pa.array(np.searchsorted(cuts[i], v, side="left")),
                        pa.array(v), pa.array(n),
                    ],
                    names=["i", "slot", "v", "n"],
                )

    values = df.mapInArrow(chosen, "i long, slot long, v double, n long").groupBy(
        "i", "slot", "v"
    ).agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("i", "slot").orderBy("v")
    ended = values.withColumn("end", F.sum("n").over(upto))
    # The wanted ranks inside each slot, as literals (as many as ranks).
    asked = [
        (i, int(s), int(r - starts[i][s]))
        for i, slots in enumerate(holding)
        for s in slots
        for r in ranks
        if starts[i][s] <= r < starts[i][s] + sizes[i][s]
    ]
    want = df.sparkSession.createDataFrame(asked, "i long, slot long, at long")
    found = ended.join(want, ["i", "slot"]).where(
        (F.col("end") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("end"))
    )
    out: list[list[float]] = [[] for _ in names]
    for r in found.select("i", "v").distinct().collect():
        out[r["i"]].append(r["v"])
    return [sorted(v) for v in out]
