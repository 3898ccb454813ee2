"""panelops: Spark-native quality, anomaly and forecast operators for
(entity, period) reporting panels.

Every operator is a ``DataFrame -> DataFrame`` function written with the
DataFrame / SQL API. Writes happen only in :mod:`panelops.sources.tables`
and the jobs in :mod:`panelops.plans.jobs`.
"""

from panelops.session import get_spark

__all__ = ["get_spark"]
