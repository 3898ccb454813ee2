import datetime as dt

from pyspark.sql import functions as F

from panelops.functions.scalars import clip, month_range, padded_id


def test_clip_range_and_padded_id(spark):
    df = spark.createDataFrame([(-5.0, 7), (50.0, 42), (150.0, 123)], "x double, n int")
    out = df.select(clip(F.col("x"), 0, 100).alias("c"), padded_id("CL-", F.col("n")).alias("id"))
    assert [(r.c, r.id) for r in out.collect()] == [(0.0, "CL-007"), (50.0, "CL-042"),
                                                    (100.0, "CL-123")]
    m = spark.range(1).select(month_range(F.lit(dt.date(2024, 11, 15)), 3).alias("m")).first().m
    assert m == [dt.date(2024, 11, 1), dt.date(2024, 12, 1), dt.date(2025, 1, 1)]
