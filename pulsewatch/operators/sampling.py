"""Repeatable samples and splits by a hash of the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.session import materialize


RANGES = 3  # hexadecimal digits of the hash that name a range: 4096 of them


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", digest)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows with the smallest hashes of key and seed, whatever the partitioning.

    Each task hands on its first ``n`` rows only.
    """
    return _hashed(df, key, seed).orderBy("_h", key).limit(n).drop("_h")


def stratified_split(
    df: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Mark the first ``share`` of each class, in order of a hash of the key.

    A histogram of the hashes gives the range in which each class reaches its share; only the
    rows of that range are ranked, to find the last hash that is in. All rows are then marked by
    comparison with it, so none of them moves. Rows that share a key are in together or out.
    """
    hashed = _hashed(df, key, seed)
    part = F.substring("_h", 1, RANGES)
    sizes = hashed.groupBy(label, part.alias("_part")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(label)
    up_to = whole.orderBy("_part")
    ranges = sizes.withColumns(
        {"_upto": F.sum("_n").over(up_to), "_limit": F.floor(F.sum("_n").over(whole) * F.lit(share))}
    )
    # the range in which the limit falls, and how many of its rows are in
    reached = ranges.where((F.col("_upto") >= F.col("_limit")) & (F.col("_upto") - F.col("_n") < F.col("_limit")))
    reached = materialize(
        reached.select(F.col(label).alias("_c"), "_part", (F.col("_limit") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    inside = hashed.select(F.col(label).alias("_class"), part.alias("_here"), "_h", F.col(key).alias("_k")).join(
        reached, F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_here") == F.col("_part"))
    )
    order = Window.partitionBy("_c").orderBy("_h", "_k")
    placed = inside.select("_c", "_h", "_k", "_rest", F.row_number().over(order).alias("_place"))
    last = materialize(placed.where("_place = _rest").select("_c", F.struct("_h", "_k").alias("_last")))
    marked = hashed.join(last, F.col(label).eqNullSafe(F.col("_c")), "left")
    is_train = F.struct(F.col("_h"), F.col(key).alias("_k")) <= F.col("_last")
    return marked.withColumn("is_train", F.coalesce(is_train, F.lit(False))).drop("_h", "_c", "_last")
