"""Plain-language explanations as column expressions.

Both run inside whole-stage codegen as higher-order functions over a small
fixed array; no Python per row.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelops.schemas import (
    ANOMALY_FIELDS,
    DIRECTION_WORDS,
    FALLBACK_SENTENCE,
    FIELD_LABELS,
    REASON_SENTENCE,
    REASONS,
    Z_REASON_THRESHOLD,
)


def build_reasons(
    flagged: Column,
    fields=ANOMALY_FIELDS,
    z_prefix: str = "z_",
    threshold: float = Z_REASON_THRESHOLD,
) -> Column:
    """``array<struct<field, z_score, direction>>`` of the fields whose
    |z| is strictly above the threshold, in field order, only on flagged
    rows; an empty typed array otherwise. z is rounded to 2 dp."""
    candidates = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{z_prefix}{f}").cast("double").alias("z_score"),
            )
            for f in fields
        ]
    )
    over = F.filter(candidates, lambda r: F.abs(r["z_score"]) > F.lit(threshold))
    shaped = F.transform(
        over,
        lambda r: F.struct(
            r["field"].alias("field"),
            F.round(r["z_score"], 2).alias("z_score"),
            F.when(r["z_score"] > 0, F.lit("high")).otherwise(F.lit("low")).alias("direction"),
        ),
    )
    return F.when(F.coalesce(flagged, F.lit(False)), shaped).otherwise(
        F.array().cast(REASONS)
    )


def _labels() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(FIELD_LABELS.items())])


def reasons_to_sentence(reasons: Column) -> Column:
    """one sentence per reason joined by '; ' with a final '.', or the
    fallback sentence for an empty list. Unknown fields keep their name."""
    labels = _labels()
    head, rest = REASON_SENTENCE.split("{label}")
    middle, tail = rest.split("{direction}")
    parts = F.transform(
        reasons,
        lambda r: F.concat(
            F.lit(head),
            F.coalesce(F.element_at(labels, r["field"]), r["field"]),
            F.lit(middle),
            F.when(r["direction"] == "high", F.lit(DIRECTION_WORDS["high"])).otherwise(
                F.lit(DIRECTION_WORDS["low"])
            ),
            F.lit(tail),
        ),
    )
    return F.when(
        F.coalesce(F.size(reasons), F.lit(0)) <= 0, F.lit(FALLBACK_SENTENCE)
    ).otherwise(F.concat(F.array_join(parts, "; "), F.lit(".")))
