"""File sources and sinks.

Readers always take an explicit schema (no inference pass over the data);
dates are parsed by the CSV reader itself. Sinks write one directory per
output; nested reason arrays are serialised with ``to_json`` only here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.schemas import FACILITIES, LEDGER, RAW_REPORT


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_facilities_csv(spark: SparkSession, path: str) -> DataFrame:
    """Facilities roster with ``opened_date`` parsed to a date."""
    return _csv(spark, path, FACILITIES)


def read_reports_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw monthly reports with ``report_month`` parsed to a date."""
    return _csv(spark, path, RAW_REPORT)


def read_ledger_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: ground-truth ledger."""
    return _csv(spark, path, LEDGER)


def _flatten_for_csv(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns as JSON text."""
    _flatten_for_csv(df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines (reports, metrics, run summaries)."""
    df.write.mode("overwrite").json(path)
