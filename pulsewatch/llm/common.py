"""Helpers that the operators share: shared intermediates, keys, deterministic hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pulsewatch.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no Arrow batch of the session hold more rows than that: texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, keeps column pruning, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (null for null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def unit(*columns: Column, seed: str = "") -> Column:
    """A number in (0, 1) that depends only on the values and the seed."""
    key = F.concat_ws("\u0001", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns])
    high = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double")
    return (high + F.lit(0.5)) / F.lit(float(16**12))


def widened(fields: list[StructField], ddl: str) -> StructType:
    """Fields of an input, whatever their names, and more fields."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])


#: A key that more than one row in so many has is hot; there are at most so many of them.
HEAVY = 500


def spread(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Left join on the text column ``key`` in which no hot key meets in one task.

    ``right`` has each key once, the number ``n`` of left rows that have it, and values whose names
    ``left`` lacks; ``total`` is the number of left rows. Hot keys meet by broadcast (at most HEAVY
    rows), all others by a plain join. A key that ``right`` lacks gives null values.
    """
    values = [c for c in right.columns if c not in (key, "n")]
    hot = right.where(F.col("n") * HEAVY > total)
    hot = hot.select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_{c}") for c in values])
    out = left.join(F.broadcast(hot), key, "left")
    # a row that has met its partner has a key of its own, so that these do not meet in one task
    own = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    cold = right.where(F.col("n") * HEAVY <= total).select(F.col(key).alias("_key"), *values)
    out = out.withColumn("_key", F.when(F.col("_hot"), own).otherwise(F.col(key))).join(cold, "_key", "left")
    found = {c: F.when(F.col("_hot"), F.col(f"_{c}")).otherwise(F.col(c)) for c in values}
    return out.withColumns(found).drop("_key", "_hot", *[f"_{c}" for c in values])
