"""Session settings and the shared folder used for checkpoints and hand-over tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "relaydesk", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitter sets these."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RELAYDESK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine, because
    there every task runs on this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir=tempfile.gettempdir()))
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
