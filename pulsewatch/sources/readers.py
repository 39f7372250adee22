"""Table sources. Every text source is read with a declared schema, never inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import schemas


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, or CSV with header when the path ends in .csv."""
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        return spark.read.schema(schema).option("header", True).csv(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """Raw calls with normalised headers."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(schemas.RAW_CALLS).option("header", True).csv(path)
    return schemas.normalize_names(spark.read.parquet(path))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw permits; headers of both known exports map to one set of names."""
    if path.rstrip("/").endswith(".csv"):
        raw = spark.read.schema(schemas.RAW_EVENTS).option("header", True).csv(path)
    else:
        raw = schemas.normalize_names(spark.read.parquet(path))
    return schemas.apply_aliases(raw, schemas.EVENT_ALIASES)


def read_geo_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Geography dimension from CSV; the id stays text so leading zeros survive."""
    return read_table(spark, path, schemas.DIM_GEO)


def read_block_groups(spark: SparkSession, path: str) -> DataFrame:
    """Attribute table exported from the block-group shapes."""
    return schemas.normalize_names(read_table(spark, path, schemas.RAW_BLOCK_GROUPS))


def read_chunks(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One frame over several Parquet chunks, for instance one per year."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_chunks(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column that a chunk lacks is NULL there."""
    head, *rest = frames
    for frame in rest:
        head = head.unionByName(frame, allowMissingColumns=True)
    return head


def first_available(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """The first Parquet source that exists."""
    tried = []
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            tried.append(path)
    raise FileNotFoundError(f"none of the sources exists: {tried}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Warehouse table read in parallel slices of ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def weather_rows(documents: DataFrame) -> DataFrame:
    """Hourly rows from documents whose ``hourly`` struct holds parallel arrays."""
    zipped = F.arrays_zip(
        *[F.col(f"hourly.{f.name}") for f in schemas.WEATHER_JSON["hourly"].dataType.fields]
    )
    rows = documents.select(F.explode(zipped).alias("h"))
    return rows.select(
        F.col("h.time").try_cast("timestamp_ntz").alias("datetime"),
        F.col("h.temperature_2m").alias("temperature_c"),
        F.col("h.relative_humidity_2m").alias("humidity_pct"),
        F.col("h.precipitation").alias("precipitation_mm"),
        F.col("h.rain").alias("rain_mm"),
        F.col("h.weather_code").alias("weather_code"),
        F.col("h.wind_speed_10m").alias("wind_speed_kmh"),
        F.col("h.wind_gusts_10m").alias("wind_gusts_kmh"),
    )


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    documents = spark.read.schema(schemas.WEATHER_JSON).option("multiLine", True).json(path)
    return weather_rows(documents)


def parse_documents(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column and lift its fields to columns."""
    return df.select(F.from_json(F.col(column), schema).alias("doc")).select("doc.*")


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RESULTS_JSON).option("multiLine", True).json(path)


def match_results(documents: DataFrame) -> DataFrame:
    """One row per match of a results document."""
    rows = documents.select(F.explode("matches").alias("m")).select("m.*")
    kickoff = F.try_to_timestamp(F.concat_ws(" ", "date", "time"), F.lit("dd/MM/yyyy HH:mm"))
    return rows.withColumn("kickoff", kickoff.cast("timestamp_ntz"))


def stored_standings(documents: DataFrame) -> DataFrame:
    """One row per group and team from the document's map of tables."""
    groups = documents.select(F.explode("standings").alias("group_name", "table"))
    return groups.select("group_name", F.inline("table"))


def call_date_range(
    calls: DataFrame, default: tuple[str, str], last_year: int | None = None
) -> DataFrame:
    """First and last call time, or ``default`` when there are no calls.

    ``last_year`` caps the end year, for weather archives that stop early.
    """
    span = calls.agg(
        F.min("response_datetime").alias("lo"), F.max("response_datetime").alias("hi")
    ).select(
        F.coalesce("lo", F.lit(default[0]).cast("timestamp_ntz")).alias("min_date"),
        F.coalesce("hi", F.lit(default[1]).cast("timestamp_ntz")).alias("max_date"),
    )
    end = F.year("max_date")
    return span.withColumns(
        {
            "start_year": F.year("min_date"),
            "end_year": end if last_year is None else F.least(end, F.lit(last_year)),
        }
    )
