import tempfile

from conftest import entry, frame
from panelops.functions.reasons import build_reasons
from panelops.sources import files


def test_csv_roundtrip_reports_and_ledger(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = frame(spark, [entry(), entry("H-02", "2024-02-01", suppression_pct=None)])
    files.write_csv(df, f"{d}/raw")
    back = files.read_reports_csv(spark, f"{d}/raw")
    assert sorted(back.collect()) == sorted(df.collect())
    led = spark.createDataFrame([("H-01", entry()[1], "outlier_spike", True, "field=x")],
                                files.LEDGER)
    files.write_csv(led, f"{d}/led")
    assert files.read_ledger_csv(spark, f"{d}/led").collect() == led.collect()


def test_nested_reasons_serialised_as_json(spark):
    from pyspark.sql import functions as F

    d = tempfile.mkdtemp(dir="/tmp")
    z = spark.createDataFrame([(3.0, 0.0, 0.0, 0.0)], "z_patients_tested double, "
                              "z_suppression_pct double, z_drug_stock_level double, "
                              "z_reporting_delay_days double")
    out = z.select(build_reasons(F.lit(True)).alias("reasons"))
    files.write_csv(out, f"{d}/scored")
    text = spark.read.option("header", True).csv(f"{d}/scored").first().reasons
    assert text == '[{"field":"patients_tested","z_score":3.0,"direction":"high"}]'
    files.write_json(out, f"{d}/json")
    assert spark.read.json(f"{d}/json").count() == 1
