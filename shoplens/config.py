"""Session construction and the shared working folder.

Everything that must outlive one task (stream checkpoints, state logs,
lineage cuts) goes under the folder named by ``spark.checkpoint.dir``,
or, where that is unset, under the session's warehouse folder. Both are
shared by driver and executors on a cluster; no machine-local temporary
folder is ever used.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on; sized for a cluster, overridden in tests.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shoplens", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and state; read from the session.

    ``spark.checkpoint.dir`` when set, else a folder inside the session's
    ``spark.sql.warehouse.dir``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared work folder."""
    path = f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes():
        _scopes()[-1].append(path)
    return path


_HELD = threading.local()


def _scopes() -> list[list[str]]:
    """The open scopes of this thread: scratch of another thread is never taken for one's own."""
    if not hasattr(_HELD, "scopes"):
        _HELD.scopes = []
    return _HELD.scopes


@contextmanager
def tracked_scratch():
    """Gathers the scratch folders made inside the block, for ``release``."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield paths
    finally:
        _scopes().pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders whose readers have finished."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def store(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage like a checkpoint, but columnar and compressed: readers
    prune columns, and a lost executor re-reads files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Compute ``df`` once and cut its lineage (a reliable checkpoint).

    For an intermediate that a report reads more than once: the rows are
    written to the shared checkpoint folder, so both readers share one
    computation and a lost executor re-reads files instead of recomputing
    the upstream scan and shuffles.
    """
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)
