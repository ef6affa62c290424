"""Session helpers: the settings every kiln job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # dates are text; day differences are computed on UTC instants
    "spark.sql.session.timeZone": "UTC",
    # keep ANSI on: every dirty-text cast goes through try_cast / regex gates
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: broadcast decisions from measured sizes, partition
# coalescing, skew-join splitting.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "kiln", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with kiln's required settings.

    ``spark.checkpoint.dir`` is left alone when the cluster already names a
    shared folder; only a bare local run gets a private scratch folder.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**REQUIRED_CONF, **ADAPTIVE_CONF, "spark.ui.enabled": "false"}
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("KILN_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in {**REQUIRED_CONF}.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster the folder must be named by ``spark.checkpoint.dir`` (a shared
    file system every executor can reach); only a local-mode session without
    one gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):    # a local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a shared folder (written tables and stream "
                         "checkpoints live there)")
    scratch = tempfile.mkdtemp(prefix="kiln-ckpt-", dir=os.environ.get("KILN_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
