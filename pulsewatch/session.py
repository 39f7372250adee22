"""Session settings, shared intermediates and row-count gates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "pulsewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator assumes (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # dimensions up to this measured size are broadcast, larger ones shuffle
        "spark.sql.autoBroadcastJoinThreshold": "64MB",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset, a local master gets a folder that goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="pulsewatch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that several branches read, so it is computed once.

    A Parquet table in the shared folder survives the loss of executors, unlike a cache,
    and is read by column.
    """
    path = f"{shared_dir(df.sparkSession)}/intermediate-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads at most ``rows + 1``."""
    return df.limit(rows + 1).count() <= rows
