"""The corpus pipeline; its stages are in :mod:`panelops.llm.pipeline`."""

from panelops.llm.pipeline import COLUMNS, ORACLE_SQL, STAGES, run

__all__ = ["COLUMNS", "ORACLE_SQL", "STAGES", "run"]
