"""The reporting panel and roster derived from the driver's tables.

One panel row per (supplier, ship month):

* ``facility_id``          'S-' || l_suppkey
* ``report_month``         first day of the ship month
* ``patients_tested``      sum(l_quantity) as int
* ``suppression_pct``      100 * share of lines not returned ('R'), 4 dp
* ``drug_stock_level``     100 - 10 * mean discount in whole percent, 4 dp
* ``reporting_delay_days`` days from the last ship date to the month end

Roster (``facilities``): suppliers with a non-negative account balance;
the others only appear as unknown ids in the raw batch.

Scale: lineitem is read with 5 pruned columns and aggregated with a partial
(map-side) aggregate on (suppkey, month), so a supplier holding a third of
all lines still reduces to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.schemas import ENTITY, PERIOD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_id(suppkey_col) -> F.Column:
    return F.concat(F.lit("S-"), suppkey_col.cast("string"))


def supplier_months(lineitem: DataFrame) -> DataFrame:
    """Per (suppkey, month) aggregate, the single pass over lineitem."""
    ship = F.to_date("l_shipdate")
    return (
        lineitem.select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_discount")
        .groupBy(F.col("l_suppkey").alias("suppkey"), F.trunc(ship, "MM").alias(PERIOD))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("l_returnflag") != "R").alias("n_kept"),
            F.sum(F.round(F.col("l_discount") * 100).cast("int")).alias("disc_pct_sum"),
            F.max(ship).alias("last_ship"),
            F.min(ship).alias("first_ship"),
        )
    )


def panel_from_supplier_months(sm: DataFrame) -> DataFrame:
    n = F.col("n_lines").cast("double")
    return sm.select(
        F.col("suppkey"),
        entity_id(F.col("suppkey")).alias(ENTITY),
        F.col(PERIOD),
        F.col("qty").cast("bigint").alias("patients_tested"),
        F.round(F.lit(100.0) * F.col("n_kept") / n, 4).alias("suppression_pct"),
        F.round(F.lit(100.0) - F.lit(10.0) * F.col("disc_pct_sum") / n, 4).alias(
            "drug_stock_level"
        ),
        F.datediff(F.last_day(F.col(PERIOD)), F.col("last_ship")).alias("reporting_delay_days"),
    )


def supplier_panel(lineitem: DataFrame) -> DataFrame:
    """Clean panel before issue injection; keeps ``suppkey`` for bucketing."""
    return panel_from_supplier_months(supplier_months(lineitem))


def facilities(supplier: DataFrame, nation: DataFrame, region: DataFrame, lineitem: DataFrame):
    """Roster: suppliers with s_acctbal >= 0, opened on their first ship date."""
    return facilities_from_months(supplier, nation, region, supplier_months(lineitem))


def facilities_from_months(supplier, nation, region, sm: DataFrame) -> DataFrame:
    """Roster from an already computed (suppkey, month) aggregate."""
    first_ship = sm.groupBy("suppkey").agg(F.min("first_ship").alias("opened_date"))
    dims = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (
        supplier.where(F.col("s_acctbal") >= 0)
        .join(dims, supplier.s_nationkey == dims.n_nationkey)
        .join(first_ship, supplier.s_suppkey == first_ship.suppkey, "left")
        .select(
            entity_id(F.col("s_suppkey")).alias(ENTITY),
            F.col("s_name").alias("facility_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("ownership_type"),
            F.floor(F.abs(F.col("s_acctbal"))).cast("int").alias("baseline_patient_volume"),
            F.col("opened_date"),
        )
    )


def load_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facilities(
        table(spark, sf_dir, "supplier"),
        table(spark, sf_dir, "nation"),
        table(spark, sf_dir, "region"),
        table(spark, sf_dir, "lineitem"),
    )


def load_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_panel(table(spark, sf_dir, "lineitem"))
