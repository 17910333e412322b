"""Session construction and the shared work folder.

On a cluster the work folder is the shared ``spark.checkpoint.dir`` the
cluster names.  A folder under /tmp is made up only for a local master; any
other session without the setting gets an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets; a cluster launcher may override all of them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints written by row_index / next_in_group are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    try:
        d = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        d = None
    if d:
        return d
    for getter in (lambda: spark.conf.get("spark.checkpoint.dir", None),
                   lambda: sc.getConf().get("spark.checkpoint.dir")):
        try:
            d = getter()
        except Exception:
            d = None
        if d:
            return d
    return None


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh (not yet created) path under the shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; where it is unset and the
    master is local (tests, laptops) a private folder under /tmp is made and
    registered as the checkpoint folder, so ``DataFrame.checkpoint()`` works too.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
        base = _configured_checkpoint_dir(spark) or base
    name = "-".join(parts) if parts else "work"
    # a unique, not yet existing path: writers create it
    return base.rstrip("/") + "/tessera/" + name + "-" + uuid.uuid4().hex[:12]
