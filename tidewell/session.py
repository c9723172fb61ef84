"""Session settings and the durable scratch location shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tidewell", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; any of them can be overridden by keyword.

    Shuffle partitions start from three times the cluster's parallelism and are coalesced by adaptive execution, so the
    same code runs on a laptop and on a thousand executors. Skewed join partitions are split at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in settings:
        spark.conf.set("spark.sql.shuffle.partitions", str(max(200, 3 * spark.sparkContext.defaultParallelism)))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder; on a cluster a machine-local folder would be lost with its executor, so we refuse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        root = configured
    elif spark.sparkContext.master.startswith("local"):
        root = os.path.join(tempfile.gettempdir(), "tidewell-checkpoints")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and continue from there.

    The written table survives lost executors, ends the lineage and is read back column by column.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
