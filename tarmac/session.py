"""Session construction and the shared scratch location.

On a cluster the scratch location is whatever the cluster names in
``spark.checkpoint.dir`` (a shared file system).  A directory of our own
is only created when that setting is unset, which is the case in local
tests and benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans shuffles from runtime
# statistics (coalesces small partitions, splits skewed join partitions,
# turns a sort-merge join into a broadcast join when a side turns out small).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tarmac", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one configured for tarmac."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_runtime_conf(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.driver.memory"] = os.environ.get("TARMAC_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL options tarmac relies on (UTC day boundaries, AQE)."""
    for k, v in SCALE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the cluster set them
            if k == "spark.sql.session.timeZone":  # day boundaries depend on it
                raise


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made only on a local master (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tarmac-{purpose}-{uuid.uuid4().hex[:12]}"
