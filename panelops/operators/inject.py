"""Seeded issue injection (replayable, partition-independent).

Each panel row gets an integer bucket 0..999 from its key; disjoint bucket
ranges give disjoint issue pools, so the raw batch and the ground-truth
ledger are two projections of one DataFrame. No RNG state, no ordering: the
same input gives the same output under any partitioning, and the rule is
plain arithmetic that SQL can replay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.schemas import ENTITY, MEASURES, PERIOD


@dataclass(frozen=True)
class IssueRule:
    lo: int  # inclusive bucket range
    hi: int
    issue_type: str
    candidate: bool
    action: str  # "drop" | "duplicate" | "set"
    field: str | None = None
    detail: str = ""


# --- Fixed values: the injection plan used for the driver's test data -----
# bucket b = (suppkey * 7919 + (year * 12 + month) * 104729) % 1000
BUCKET_ENTITY_MULT = 7919
BUCKET_PERIOD_MULT = 104729
BUCKETS = 1000
DEFAULT_RULES = (
    IssueRule(0, 29, "missing_month", False, "drop", detail="row absent from raw extract"),
    IssueRule(30, 49, "duplicate_facility_id", False, "duplicate", "patients_tested"),
    IssueRule(50, 59, "outlier_spike", True, "set", "patients_tested", "field=patients_tested"),
    IssueRule(60, 64, "outlier_spike", True, "set", "suppression_pct", "field=suppression_pct"),
    IssueRule(65, 69, "outlier_spike", True, "set", "drug_stock_level", "field=drug_stock_level"),
    IssueRule(70, 89, "severe_delay", True, "set", "reporting_delay_days",
              "reporting_delay_days overwritten"),
    IssueRule(90, 94, "range_violation", False, "set", "patients_tested", "field=patients_tested"),
    IssueRule(95, 97, "range_violation", False, "set", "suppression_pct", "field=suppression_pct"),
)
DUPLICATE_DETAIL_ORIGINAL = "original of a conflicting duplicate pair"
DUPLICATE_DETAIL_COPY = "conflicting duplicate submission"
# ---------------------------------------------------------------------------


def _set_value(rule: IssueRule, b: Column) -> Column:
    """New value of ``rule.field`` for a row in the rule's bucket range."""
    if rule.issue_type == "outlier_spike":
        return {
            "patients_tested": F.col("patients_tested").cast("bigint") * 8,
            "suppression_pct": F.lit(1.5),
            "drug_stock_level": F.lit(0.0),
        }[rule.field]
    if rule.issue_type == "severe_delay":
        return (F.lit(45) + b - F.lit(70)).cast("int")
    if rule.issue_type == "range_violation":
        return {
            "patients_tested": -F.col("patients_tested"),
            "suppression_pct": F.lit(150.0),
        }[rule.field]
    raise ValueError(f"no value rule for {rule}")


def bucket(entity_num: Column, period: Column) -> Column:
    month_index = (F.year(period) * 12 + F.month(period)).cast("bigint")
    return (
        (entity_num.cast("bigint") * BUCKET_ENTITY_MULT + month_index * BUCKET_PERIOD_MULT)
        % BUCKETS
    ).cast("int")


def _in(rule: IssueRule, b: Column) -> Column:
    return b.between(rule.lo, rule.hi)


def tag_buckets(panel: DataFrame, entity_num: str = "suppkey", period: str = PERIOD) -> DataFrame:
    return panel.withColumn("_b", bucket(F.col(entity_num), F.col(period)))


def inject_raw(
    panel: DataFrame,
    entity_num: str = "suppkey",
    rules=DEFAULT_RULES,
    measures=MEASURES,
) -> DataFrame:
    """Raw batch: drops, overwrites and appended conflicting copies."""
    t = tag_buckets(panel, entity_num)
    b = F.col("_b")
    cols = {m: F.col(m) for m in measures}
    keep = F.lit(True)
    copies = []
    for rule in rules:
        if rule.action == "drop":
            keep = keep & ~_in(rule, b)
        elif rule.action == "set":
            cols[rule.field] = F.when(_in(rule, b), _set_value(rule, b)).otherwise(cols[rule.field])
        elif rule.action == "duplicate":
            copies.append(rule)
    base = t.where(keep).select(
        F.col(ENTITY), F.col(PERIOD), *[cols[m].alias(m) for m in measures]
    )
    out = base
    for rule in copies:
        dup_cols = {m: F.col(m) for m in measures}
        dup_cols[rule.field] = (F.col(rule.field) + F.lit(10)).cast(
            panel.schema[rule.field].dataType
        )
        out = out.unionByName(
            t.where(_in(rule, b)).select(
                F.col(ENTITY), F.col(PERIOD), *[dup_cols[m].alias(m) for m in measures]
            )
        )
    return out


def inject_ledger(panel: DataFrame, entity_num: str = "suppkey", rules=DEFAULT_RULES) -> DataFrame:
    """Ground-truth ledger: one row per injected issue, two per duplicate."""
    t = tag_buckets(panel, entity_num)
    b = F.col("_b")
    issue = F.lit(None).cast("string")
    cand = F.lit(None).cast("boolean")
    detail = F.lit(None).cast("string")
    for rule in reversed(rules):
        hit = _in(rule, b)
        d = DUPLICATE_DETAIL_ORIGINAL if rule.action == "duplicate" else rule.detail
        issue = F.when(hit, F.lit(rule.issue_type)).otherwise(issue)
        cand = F.when(hit, F.lit(rule.candidate)).otherwise(cand)
        detail = F.when(hit, F.lit(d)).otherwise(detail)
    first = t.where(issue.isNotNull()).select(
        F.col(ENTITY),
        F.col(PERIOD),
        issue.alias("issue_type"),
        cand.alias("is_anomaly_candidate"),
        detail.alias("detail"),
    )
    out = first
    for rule in rules:
        if rule.action == "duplicate":
            out = out.unionByName(
                t.where(_in(rule, b)).select(
                    F.col(ENTITY),
                    F.col(PERIOD),
                    F.lit(rule.issue_type).alias("issue_type"),
                    F.lit(rule.candidate).alias("is_anomaly_candidate"),
                    F.lit(DUPLICATE_DETAIL_COPY).alias("detail"),
                )
            )
    return out


def inject_issues(panel: DataFrame, entity_num: str = "suppkey", rules=DEFAULT_RULES):
    """(raw, ledger) from one clean panel."""
    return inject_raw(panel, entity_num, rules), inject_ledger(panel, entity_num, rules)


def issue_counts(ledger: DataFrame) -> DataFrame:
    """Ledger rows per issue type."""
    return ledger.groupBy("issue_type").agg(F.count(F.lit(1)).alias("n"))
