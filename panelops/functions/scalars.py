"""Small scalar helpers (F3, F8, F10, K9) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip(c: Column, lo: float, hi: float) -> Column:
    """clamp to [lo, hi]."""
    return F.greatest(F.least(c, F.lit(hi)), F.lit(lo))


def month_range(start: Column, n: int) -> Column:
    """F8: array of ``n`` first-of-month dates from ``start``."""
    first = F.trunc(start, "MM")
    return F.sequence(first, F.add_months(first, n - 1), F.expr("interval 1 month"))


def padded_id(prefix: str, num: Column, width: int = 3) -> Column:
    """zero-padded identifier, e.g. ``CL-001``."""
    return F.format_string(f"{prefix}%0{width}d", num)


def input_example(df: DataFrame, keys: list[str], cols: list[str], n: int = 5) -> DataFrame:
    """K9: first ``n`` rows by key, stored with a model as its input example
    (a top-k, not a sort of the whole input)."""
    return df.orderBy(*keys).limit(n).select(*cols)
