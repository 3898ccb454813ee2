from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
EXTRA = ["score", "spans", "size", "copy", "_row", "w", "cell", "n", "target", "_b", "label"]
LONG = " ".join(f"w{k % 7919}x{k // 3}" for k in range(60_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows
    and extra columns whose names operators use themselves."""
    rows = [
        (1, None, "a", None), (2, "", "a", 0), (3, " \n\t ", None, 3), (4, LONG, "b", len(LONG)),
        (5, "one two three", "b", 13), (5, "one two three", "b", 13), (6, "One  two\nthree", "b", 14),
        (7, "mail a.b@c.org or a.b@c.org, " * 3, None, None), (None, "no id but six words here", "a", 9),
        (9, "x " * 40, "c", 80), (10, "p q r s t u\np q r s t u\n\nv", "c", 26),
        (11, "p q r s t u\np q r s t u\n\nv", "c", 26),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    from pyspark.sql import functions as F

    return base.withColumns({c: F.lit("clash") for c in EXTRA}).withColumn("lang", F.lit("en"))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small_docs():
    q = f"select doc_id, text, source from read_parquet('{SMALL}/documents.parquet') order by 1"
    return duckdb.sql(q).fetchall()


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
