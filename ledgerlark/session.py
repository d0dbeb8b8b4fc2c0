"""Session helper, shared folder lookup and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerlark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; a cluster's own settings win through `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or one in the session's warehouse where that is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared")
    return context.getCheckpointDir()


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written by one run."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, and still readable after executors are lost."""
    shared_root(df.sparkSession)
    return df.checkpoint()
