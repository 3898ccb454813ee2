from pyspark.sql import functions as F

from panelops.functions.reasons import build_reasons, reasons_to_sentence
from panelops.schemas import FALLBACK_SENTENCE


def _z(spark, rows):
    return spark.createDataFrame(
        rows, "z_patients_tested double, z_suppression_pct double, z_drug_stock_level double, "
              "z_reporting_delay_days double, flagged boolean")


def test_reasons_only_for_flagged_rows_over_threshold(spark):
    df = _z(spark, [(0.1, 3.0, 0.0, 0.0, False), (3.0, 0.1, 0.0, 0.0, True)])
    out = [r.r for r in df.select(build_reasons(F.col("flagged")).alias("r")).collect()]
    assert out[0] == []
    assert [x.asDict() for x in out[1]] == [
        {"field": "patients_tested", "z_score": 3.0, "direction": "high"}]


def test_direction_and_rounding(spark):
    df = _z(spark, [(-3.0, 2.0, 2.456, 0.0, True)])
    r = df.select(build_reasons(F.col("flagged")).alias("r")).first().r
    assert [(x.field, x.z_score, x.direction) for x in r] == [
        ("patients_tested", -3.0, "low"), ("drug_stock_level", 2.46, "high")]


def test_sentence(spark):
    df = spark.createDataFrame(
        [([("suppression_pct", 3.1, "high"), ("reporting_delay_days", -2.5, "low")],), ([],)],
        "r array<struct<field:string,z_score:double,direction:string>>")
    s = [x.s for x in df.select(reasons_to_sentence(F.col("r")).alias("s")).collect()]
    assert "viral load suppression rate" in s[0] and "much higher" in s[0]
    assert "reporting delay" in s[0] and "much lower" in s[0] and s[0].endswith(".")
    assert s[1] == FALLBACK_SENTENCE and "Flagged by the model" in s[1]
