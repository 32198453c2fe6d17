"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job of this package expects. AQE does the physical
# tuning: it coalesces small shuffle partitions, splits skewed ones, and turns a
# sort-merge join into a hash join once it has *measured* that a side is small.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # an iterative job has many plans, whose texts the driver keeps
    "spark.sql.maxPlanStringLength": "65536",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def build_session(app: str = "gleanery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SQL_CONF``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SQL_CONF.items():
        builder = builder.config(name, value)
    # checkpoint files go once nothing refers to them, so a long stream does not fill the folder
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the same runtime settings."""
    for name, value in SQL_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the cluster names none (local tests) a temporary folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gleanery-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
