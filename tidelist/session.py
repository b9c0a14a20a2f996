"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings: safe to apply to a session that somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# For joins of listings: logs and manifests of boards grow with the boards, and their files are so
# well packed that a file of some MB makes a broadcast of hundreds, through the driver. From files
# only tiny tables are broadcast at once; others once adaptive execution knows their rows' size.
JOINS = {
    "spark.sql.autoBroadcastJoinThreshold": 64 << 10,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": 256 << 10,
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC above all: days and weeks are UTC days and weeks)."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def bound_broadcasts(spark: SparkSession) -> SparkSession:
    """Runtime settings, and what a join may broadcast bounded, whatever the tables' growth."""
    configure(spark)
    for key, most in JOINS.items():
        if spark.conf.get(key, None) != str(most):
            spark.conf.set(key, str(most))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session on one machine
    (``local[...]``) gets a folder of its own; on a cluster that is an error, as executors would
    write to folders the others don't see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="tidelist-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")

