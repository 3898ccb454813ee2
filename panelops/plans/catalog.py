"""Registered queries: one per operator of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where SQL can express the
operator, ``ORACLE[name]`` holding equivalent DuckDB SQL over the same
tables. Column names and types match between the two; floats are rounded
to 6 dp on both sides.
"""

from __future__ import annotations

from panelops.plans import (  # noqa: F401  (registration)
    q_features,
    q_models,
    q_monitoring,
    q_rules,
    q_storage,
    q_validation,
)
from panelops.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
