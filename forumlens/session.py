"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a 1000-executor cluster alike: AQE
# re-plans joins and partition counts from real shuffle sizes, and splits
# skewed join partitions at run time.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "forumlens") -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster the launcher decides both.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", "16g")
    for key, value in CLUSTER_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names the folder; only when it is unset in a local session
    (tests) do we pick one ourselves: elsewhere a machine's own folder would
    not be seen by the other machines, so that raises. ``spark.checkpoint.dir`` is a core setting that
    cannot change at run time, so an own folder goes to the SparkContext.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="forumlens-ckpt-"))
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on this machine."""
    return master == "local" or (master.startswith("local[") and master.endswith("]"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/forumlens/{name}-{uuid.uuid4().hex[:12]}"
