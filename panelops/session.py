"""Session helpers.

Operators never read or change session settings; only the helpers here
(used by tests, bench and the CLI jobs) build a session. On a cluster the
caller's session is used as is.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the engine is designed around. AQE re-plans joins from runtime
# sizes (broadcast below the threshold, skew splitting above it); the rest
# keep local runs quiet and reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "panelops",
    extra_conf: dict | None = None,
) -> SparkSession:
    master = master or os.environ.get("PANELOPS_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("PANELOPS_DRIVER_MEMORY", "16g")
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIR: str | None = None


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Where the setting is missing, a
    single-machine session (tests) gets a scratch folder that is deleted when
    the process ends; on a cluster a missing setting is an error, because a
    folder local to one machine cannot be read by the others.
    """
    global _LOCAL_DIR
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not _is_local(spark):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all "
            "executors share before the session starts"
        )
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="panelops-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, _LOCAL_DIR, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(_LOCAL_DIR)
    return _LOCAL_DIR


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application).

    Arrow and pandas functions are pickled by reference, so every worker
    imports ``panelops``. Needed where the package is only on the driver's
    path; harmless where it is installed everywhere.
    """
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="panelops-zip-"), "panelops.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "panelops")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as Parquet under the shared checkpoint folder and
    return a DataFrame reading it back.

    Like a reliable checkpoint this survives executor loss (the files live
    on the shared file system, not on executors), and unlike RDD checkpoint
    files the result is columnar: later stages get column pruning, predicate
    pushdown and Parquet statistics on it.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/panelops-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


# The innermost open scope of the running thread (or task): a scope opened by
# one thread never sees the cuts of another.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


@contextlib.contextmanager
def lineage_scope(spark: SparkSession):
    """Delete the lineage cuts made inside the block when it exits.

    Jobs wrap their body in it: once the final tables are written, the
    intermediate Parquet folders in the shared checkpoint folder are no
    longer read by anything. DataFrames returned from inside the block must
    not be used after it.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete_paths(spark, paths)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
