"""Lazily built inputs shared by the registered queries.

Everything derives from the driver's tables, so every query's work grows
with them: panel from lineitem, roster from supplier/nation/region, raw batch
and ledger from the panel, clean table from the classified batch.

The (supplier, month) aggregate, the roster and the classified batch are
what the pipeline writes as tables; here they are materialised once per
query as Parquet under the shared ``spark.checkpoint.dir`` (see
``session.cut_lineage``), like the written tables the jobs read. Without
that, each branch of a plan (duplicate counts, medians, MADs, roster size
check, report pieces, ...) prunes different columns and re-derives its
input from lineitem on its own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from panelops.operators import checks, inject
from panelops.schemas import ENTITY, PERIOD
from panelops.session import cut_lineage
from panelops.sources import panel as panel_src

STRICT_THRESHOLD = 3.0

RAW_COLUMNS = [
    ENTITY,
    PERIOD,
    "patients_tested",
    "suppression_pct",
    "drug_stock_level",
    "reporting_delay_days",
]


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return panel_src.table(self.spark, self.sf_dir, name)

    @cached_property
    def supplier_months(self) -> DataFrame:
        """The one pass over lineitem, materialised."""
        return cut_lineage(panel_src.supplier_months(self.table("lineitem")), "supplier_months")

    @cached_property
    def panel(self) -> DataFrame:
        return panel_src.panel_from_supplier_months(self.supplier_months)

    @cached_property
    def facilities(self) -> DataFrame:
        return cut_lineage(
            panel_src.facilities_from_months(
                self.table("supplier"), self.table("nation"), self.table("region"),
                self.supplier_months,
            ),
            "facilities",
        )

    @cached_property
    def raw(self) -> DataFrame:
        """The landed batch: every check reads it, so it is written once."""
        return cut_lineage(inject.inject_raw(self.panel), "raw")

    @cached_property
    def ledger(self) -> DataFrame:
        return inject.inject_ledger(self.panel)

    @cached_property
    def classified(self) -> DataFrame:
        """Materialised like in the validate job: the clean rows, the
        quarantine and the report all read it."""
        return cut_lineage(checks.classify(self.raw, self.facilities), "classified")

    @cached_property
    def classified_strict(self) -> DataFrame:
        """Re-validation of the same batch with a stricter outlier threshold."""
        return cut_lineage(
            checks.classify(self.raw, self.facilities, outlier_threshold=STRICT_THRESHOLD),
            "classified_strict",
        )

    @cached_property
    def quarantined_strict(self) -> DataFrame:
        return checks.split(self.classified_strict, RAW_COLUMNS)[1]

    @cached_property
    def clean(self) -> DataFrame:
        return checks.split(self.classified, RAW_COLUMNS)[0]

    @cached_property
    def quarantined(self) -> DataFrame:
        return checks.split(self.classified, RAW_COLUMNS)[1]

    @cached_property
    def gaps(self) -> DataFrame:
        """The report counts them and takes the first by key."""
        return cut_lineage(checks.completeness_gaps(self.raw, self.facilities), "gaps")

    @cached_property
    def anomaly_features(self) -> DataFrame:
        from panelops.operators.features import anomaly_features

        return anomaly_features(self.clean)

    @cached_property
    def forecast_rows(self) -> DataFrame:
        """Forecast features for every clean row (scoring: no target needed)."""
        from panelops.operators.features import forecast_dataset

        return forecast_dataset(self.clean, self.facilities, require_target=False)

    @cached_property
    def dataset(self) -> DataFrame:
        from panelops.operators.features import forecast_dataset

        return forecast_dataset(self.clean, self.facilities, require_target=True)

    @cached_property
    def candidates(self) -> DataFrame:
        """Distinct keys of injected anomaly candidates."""
        from pyspark.sql import functions as F

        return (
            self.ledger.where(F.col("is_anomaly_candidate"))
            .select(ENTITY, PERIOD)
            .dropDuplicates([ENTITY, PERIOD])
        )
