"""Session helpers: a tuned local session for tests/bench and the
checkpoint folder rule (use the cluster's ``spark.checkpoint.dir``; set a
scratch one only when the session has none, as in tests)."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins and
# coalesces/splits skewed shuffle partitions at runtime; UTC keeps ISO-8601
# output stable; Arrow moves batches to and from Python; workers talk to the JVM
# through files, not ports.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "relcheck") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, shared by the driver and
    all executors. Only a local session (driver and executors are one process)
    that has none gets a scratch folder; elsewhere an unset folder is an error,
    as executors would each write to their own disk."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="relcheck-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder, for written intermediate tables
    and streaming checkpoints (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name
