"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the query contracts: a word is a run of characters other
# than the space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null, empty or blank texts.

    Trimmed first, so the split gives no empty strings to filter out and the
    expression stays inside generated code.
    """
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(
        F.coalesce(F.length(trimmed), F.lit(0)) > 0, F.split(trimmed, SPACE_RUN)
    ).otherwise(F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda that indexes into an array expression would otherwise compute
    that expression again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_random(*cols: Column | str) -> Column:
    """Deterministic number in [0, 1) from the hash of the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(2**53))
