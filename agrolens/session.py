"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast only
# when the measured side is small, split skewed partitions, coalesce tiny ones).
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# A table of at most this many narrow rows is sent to all tasks; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "agrolens", extra: dict | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass master=None and let the
    launcher decide; locally ``local[N]`` with shuffle partitions ~ N and a
    driver heap big enough for the single local JVM (it hosts the executors)."""
    b = SparkSession.builder.appName(app_name)
    conf = dict(_BASE_CONF)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            conf["spark.driver.memory"] = driver_memory or os.environ.get("AGROLENS_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system); a
    machine-local folder would lose written tables with the executor that held
    them, so a non-local master without the setting is an error. Only a local
    master (tests) with the setting unset gets a folder of our own.
    """
    global _LOCAL_CKPT
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS / object "
                               "storage) for this cluster; agrolens writes intermediate tables there")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="agrolens-ckpt-")
        d = _LOCAL_CKPT
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, after a step whose result was written. Spark drops them only once
    the garbage collectors have dropped the step's plan, which a driver with free memory puts off to the end of the query."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
