"""Mixing sources to target weights by pivotal dependent rounding.

Targets: sources in code-point order (null last) get the repeating weights;
their shares of the wanted total are capped at ``max_epochs`` times a source's
size, and the excess is shared again by weight until no source is above its
cap (solved in closed form: sources ordered by cap per weight are capped in
that order, so one running sum finds the level).

Copies: a document of source s wants ``c = target / size`` copies. It gets
``floor(c)`` for sure and the fraction ``p`` at random, where the fractions of
a source are rounded together (Deville and Tille's pivotal method, with the
words as the mass that is transferred). Two units a and b of u and v words can
move ``up = min((1 - a) u, b v)`` words from b to a, or
``down = min(a u, (1 - b) v)`` the other way; either makes one of them 0 or 1.
``up`` is drawn with chance ``down / (up + down)``, so every unit keeps its
expectation, while the words taken never change: a source misses its target
by less than the last unit left, one document.

Reduction tree: units are dealt to blocks of about ``BLOCK`` by (source,
hash); a block is rounded in one array pass, large units first, and hands its
one residual unit to the next level, ``BLOCK`` blocks to one, until one
residual per source is left. About ``RESERVE`` units of each source are kept
back for the last level, where they settle a large residual; what is left then
is mostly one small unit, drawn by itself. A source with a third of all
documents is only more blocks; nothing is collected beyond a block.

Random numbers are hashes of the unit, so reruns and any partitioning agree.

Native: DataFrame functions only.

Defined cases: a null text has size 0; documents of size 0 have the whole part
of their source's copies (they hold no words); rows equal in doc_id, source
and size are units of their own, told apart by a number (which row has which
number is not defined, nor does it matter); a null source is a source of
its own, last in order; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.llm.common import unit_random, words
from panelops.session import cut_lineage

# Fixed values of the query contract.
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2.0

BLOCK = 128
RESERVE = 1024
UNIT = ["doc_id", "source", "size"]


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share=TOTAL_SHARE,
                   max_epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per
    source. The windows run over that aggregate only."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    rows = sizes.withColumn("_w", weight).withColumn(
        "_cap", F.col("source_size") * F.lit(float(max_epochs))
    )
    every = Window.partitionBy(F.lit(1))
    first_capped = Window.partitionBy(F.lit(1)).orderBy(
        F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source"
    )
    before = first_capped.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.lit(float(total_share)) * F.sum("source_size").over(every)
    left = wanted - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    # Words per weight if this source and all later ones were below the cap.
    level = left / weight_left
    rows = rows.withColumn("_level", level).withColumn(
        "_capped", F.col("_level") * F.col("_w") >= F.col("_cap")
    )
    # Below the last capped source the levels only fall, so the one that holds
    # is the highest of those that cap nothing.
    final = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(every)
    return rows.select(
        "source", "source_size",
        F.when(F.col("_capped"), F.col("_cap")).otherwise(final * F.col("_w")).alias("target"),
    )


# A unit of the tree; ``order`` is minus its words, so sorting puts large first.
FIELDS = ["order", "h", "doc_id", "size", "copies"]


def _pivot(units: Column, level: int) -> Column:
    """Round an array of units with fractions p in order. Struct (done, rest):
    ``done`` has every unit that became 0 or 1 with that value in p, ``rest``
    the one that is left."""

    def with_p(unit: Column, p: Column) -> Column:
        return F.struct(*[unit[c].alias(c) for c in FIELDS], p.alias("p"))

    def step(state: Column, b: Column) -> Column:
        a = state["rest"]
        wa, wb = -a["order"], -b["order"]
        up = F.least((1 - a["p"]) * wa, b["p"] * wb)
        down = F.least(a["p"] * wa, (1 - b["p"]) * wb)
        rises = unit_random(F.lit(level), b["h"]) * (up + down) < down
        # The unit that becomes 0 or 1, and what the other one has then.
        a_done = F.when(rises, (1 - a["p"]) * wa <= b["p"] * wb).otherwise(
            a["p"] * wa <= (1 - b["p"]) * wb
        )
        moved = F.when(rises, up).otherwise(-down)
        done = F.when(a_done, with_p(a, F.when(rises, 1.0).otherwise(0.0))).otherwise(
            with_p(b, F.when(rises, 0.0).otherwise(1.0))
        )
        inside = lambda p: F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
        rest = F.when(a_done, with_p(b, inside(b["p"] - moved / wb))).otherwise(
            with_p(a, inside(a["p"] + moved / wa))
        )
        return F.struct(F.array_append(state["done"], done).alias("done"), rest.alias("rest"))

    start = F.struct(F.slice(units, 1, 0).alias("done"), F.element_at(units, 1).alias("rest"))
    return F.aggregate(F.slice(units, F.lit(2), F.size(units)), start, step)


def _round_level(
    units: DataFrame, keys: list[str], level: int
) -> tuple[DataFrame, DataFrame]:
    """One level of the tree: (settled units, one residual unit per key)."""
    block = F.sort_array(F.collect_list(F.struct(*FIELDS, "p")))
    rounded = cut_lineage(
        units.groupBy(*keys).agg(block.alias("_b")).select(
            *keys, _pivot(F.col("_b"), level).alias("_r")
        ),
        "pivot",
    )
    settled = rounded.select("source", F.explode("_r.done").alias("_u")).select("source", "_u.*")
    return settled, rounded.select(*keys, "_r.rest.*")


def copies(units: DataFrame) -> DataFrame:
    """Copies of each unit. ``units``: doc_id, source, size, nth (tells equal
    rows apart), want (copies wanted, a real number).

    Returns doc_id, source, size, copies.
    """
    whole = F.floor("want")
    fraction = F.when(F.col("size") > 0, F.col("want") - whole).otherwise(0.0)
    start = cut_lineage(
        units.select(
            "source", (-F.col("size")).cast("double").alias("order"),
            F.xxhash64("doc_id", "source", "size", "nth").alias("h"), "doc_id", "size",
            whole.alias("copies"), fraction.alias("p"),
        ),
        "units",
    )
    done = [start.where(F.col("p") <= 0)]
    open_units = start.where(F.col("p") > 0)
    sources = cut_lineage(
        open_units.groupBy(F.col("source").alias("_s")).agg(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("_blocks"),
            (F.lit(float(RESERVE)) / F.count(F.lit(1))).alias("_share"),
        ),
        "blocks",
    )
    blocks = sources.agg(F.max("_blocks")).first()[0] or 0
    kept_back = (F.col("_share") > 0.5) | (unit_random(F.lit(-2), "h") < F.col("_share"))
    dealt = open_units.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", *FIELDS, "p", F.pmod("h", "_blocks").alias("block"), kept_back.alias("_back")
    )
    reserve = dealt.where("_back").select("source", *FIELDS, "p")
    level = dealt.where("not _back").drop("_back")
    rounds = 1 + (math.ceil(math.log(blocks, BLOCK) - 1e-9) if blocks > 1 else 0)
    for r in range(rounds):
        settled, residual = _round_level(level, ["source", "block"], r)
        done.append(settled)
        level = residual.withColumn("block", F.floor(F.col("block") / BLOCK))
    last = level.select("source", *FIELDS, "p").unionByName(reserve)
    settled, level = _round_level(last, ["source"], rounds)
    done.append(settled)
    # One residual per source is left; the last unit is drawn by itself.
    drawn = F.when(unit_random(F.lit(-1), "h") < F.col("p"), 1.0).otherwise(0.0)
    done.append(level.withColumn("p", drawn))
    out = done[0].select("source", *FIELDS, "p")
    for d in done[1:]:
        out = out.unionByName(d.select("source", *FIELDS, "p"))
    return out.select(
        "doc_id", "source", "size", (F.col("copies") + F.round("p").cast("bigint")).alias("copies")
    )


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.size(words(text)).cast("bigint")


def mix(docs: DataFrame, weights=WEIGHTS, total_share=TOTAL_SHARE,
        max_epochs=MAX_EPOCHS) -> DataFrame:
    """Copies of every document (``docs``: doc_id, source, text).

    Returns one row per input row: doc_id, source, size, source_size, target,
    copies.
    """
    rows = cut_lineage(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size")),
        "sizes",
    )
    units = rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n")).select(
        *UNIT, F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("nth")
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sources, weights, total_share, max_epochs), "targets")
    t = targets.withColumnRenamed("source", "_s")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Never above the cap, whatever the last bit of the quotient says.
    want = F.least(wanted, F.lit(float(max_epochs)))
    priced = units.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        *UNIT, "nth", want.alias("want")
    )
    # Units are the rows: equal rows differ in nothing that is returned.
    return copies(priced).join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        *UNIT, "source_size", "target", "copies"
    )
