"""Key summaries of a partitioned Parquet table: which partitions may hold a key, without reading them.

Beside the table lie, for each partition, the signature of its files, the smallest and largest key
and a Bloom filter: one 64-bit word for some two keys, in which a key sets eight bits. A
partition without a summary, or whose files have changed since, may hold any key, so a summary that
is missing or late costs reads, never results. About one key in a hundred thousand is taken to be in
a partition that lacks it; the caller looks into that partition and finds nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch.session import materialize

FOLDER = "_key_summary"  # a leading underscore keeps it out of the table
KEYS_PER_WORD = 2
BITS_PER_KEY = 8


def partition_id(partition_by: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*partition_by)))


def _files(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame:
    """(pid, signature, partition columns) of each stored partition, from a listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    name = F.substring_index("path", "/", -1)
    return listed.groupBy(partition_id(partition_by).alias("pid")).agg(
        F.concat_ws("-", F.count("*"), F.sum(F.xxhash64(name, "length").cast("decimal(38)"))).alias("signature"),
        *[F.any_value(c).alias(c) for c in partition_by],
    )


def _slot(key: str, level: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("slot"), key), F.call_function("shiftleft", F.lit(1).cast("long"), level))


def _mask(key: str) -> Column:
    mask = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(F.xxhash64(key), 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def _stored(spark: SparkSession, path: str, part: str, fields: str, key_type: T.DataType | None = None) -> DataFrame:
    schema = T.StructType.fromDDL(fields)
    if key_type is not None:
        schema = schema.add("least", key_type).add("greatest", key_type)
    try:
        return spark.read.schema(schema).parquet(f"{path}/{FOLDER}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def summarise_keys(
    spark: SparkSession, path: str, key: str, partition_by: list[str], inside: Column | None = None
) -> None:
    """Write the summaries of the partitions ``inside`` (all by default) from their key column."""
    files = _files(spark, path, partition_by)  # listed first: what lands later changes the signature
    base = spark.read.parquet(path)
    if inside is not None:
        base, files = base.where(inside), files.where(inside)
    keys = base.where(F.col(key).isNotNull()).select(partition_id(partition_by).alias("pid"), F.col(key).alias("_key"))
    sizes = keys.groupBy("pid").agg(
        F.count("*").alias("n"), F.min("_key").alias("least"), F.max("_key").alias("greatest")
    )
    words = F.greatest(F.lit(1.0), F.col("n") / KEYS_PER_WORD)
    parts = files.select("pid", "signature").join(sizes, "pid", "left").select(
        "pid", "signature", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce(F.ceil(F.log2(words)), F.lit(0)).cast("int").alias("level"), "least", "greatest",
    )
    parts = materialize(parts)
    options = {"partitionOverwriteMode": "dynamic"}
    # broadcast, one row a partition: a shuffle by pid would bring all keys of a partition to one task
    bits = keys.join(F.broadcast(parts.select("pid", "level")), "pid")
    bits = bits.groupBy("pid", "level", _slot("_key", F.col("level")).alias("slot")).agg(F.bit_or(_mask("_key")).alias("bits"))
    for name, frame in (("bits", bits), ("parts", parts)):
        writer = frame.hint("rebalance", "pid").write.mode("overwrite").options(**options)
        writer.partitionBy("pid").parquet(f"{path}/{FOLDER}/{name}")


def may_hold(path: str, keys: DataFrame, key: str, partition_by: list[str]) -> DataFrame:
    """Values of the partition columns of each stored partition that may hold one of ``keys``.

    Each key asks one word of a partition's filter; only filters of partitions whose range of keys
    meets that of ``keys`` are read.
    """
    spark = keys.sparkSession
    files = _files(spark, path, partition_by)
    parts = _stored(spark, path, "parts", "pid string, signature string, n long, level int", keys.schema[key].dataType)
    known = files.select("pid", "signature").join(parts, ["pid", "signature"])
    asked = keys.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    reach = asked.agg(F.min("_key").alias("low"), F.max("_key").alias("high"))
    near = known.where("n > 0").join(F.broadcast(reach), (F.col("greatest") >= F.col("low")) & (F.col("least") <= F.col("high")))
    levels = near.agg(F.collect_set("level")).scalar()
    probes = asked.select("_key", F.explode(levels).alias("level")).select(
        "level", _slot("_key", F.col("level")).alias("slot"), _mask("_key").alias("mask")
    )
    bits = _stored(spark, path, "bits", "pid string, level int, slot long, bits long")
    words = bits.join(F.broadcast(near.select("pid")), "pid", "left_semi")
    hits = words.join(probes, ["level", "slot"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    closed = known.select("pid").join(hits.select("pid").distinct(), "pid", "left_anti")
    return files.join(closed, "pid", "left_anti").select(*partition_by)
