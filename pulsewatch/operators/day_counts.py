"""Counts a day and place beside a table of calls, from which heatmaps and counters are merged.

A row has a day, a place, its number of calls, and number and sum of their priorities. Sums of
these over days equal the aggregates over the calls, so a rolling window reads its days' rows
and never a call. The counts lie in the partitions of the calls. A load recounts the partitions
it has touched, whole, so late rows, moved places and a repeated batch leave the right numbers.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.operators.analysis import one_row

PLACE = ["latitude_centroid", "longitude_centroid"]


def count_days(calls: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Calls, and count and sum of their priorities, for each day and place.

    Calls without a time or a place are counted under a null day or place.
    """
    day = F.to_date("response_datetime").alias("day")
    return calls.groupBy(*(partition_by or []), day, *PLACE).agg(
        F.count("*").alias("n_calls"),
        F.count("priority_numeric").alias("n_priority"),
        F.sum("priority_numeric").cast("long").alias("priority_sum"),
    )


def recount(
    spark: SparkSession, calls: str, counts: str, partition_by: list[str], touched: Column | None
) -> None:
    """Bring the counts beside ``calls`` up to date in the partitions that ``touched`` selects.

    Without counts so far, all partitions are counted.
    """
    table = spark.read.parquet(calls)
    try:
        spark.read.parquet(counts)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        touched = None
    if touched is not None:
        table = table.where(touched)
    (
        count_days(table, partition_by)
        .hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(counts)
    )


def _places(counts: DataFrame) -> DataFrame:
    mean = F.sum("priority_sum") / F.nullif(F.sum("n_priority"), F.lit(0))
    return counts.groupBy(*PLACE).agg(F.sum("n_calls").alias("incident_count"), mean.alias("avg_priority"))


def rolling_heatmap(
    counts: DataFrame, days: int = 30, high: int = 100, medium: int = 50, as_of=None,
    month: str | None = None,
) -> DataFrame:
    """Places by incidents in the ``days`` before ``as_of`` (default: the last day counted).

    ``month`` names a partition column with the month of the day as text; with it, only the
    months of the window are opened. Leave it out if loads may change the day of a stored call,
    which stays in its partition.
    """
    last = counts.agg(F.max("day")).scalar() if as_of is None else F.lit(as_of)
    start = F.date_sub(last.cast("date"), days)
    inside = counts.where(F.col("day") >= start)
    if month is not None:
        inside = inside.where(F.col(month) >= F.substring(start.cast("string"), 1, 7))
    level = V.three_levels(F.col("incident_count"), high, medium, strict=True)
    return (
        _places(inside)
        .withColumn("risk_level", level)
        .withColumnsRenamed({"latitude_centroid": "lat", "longitude_centroid": "lon"})
    )


def zone_heatmap(
    counts: DataFrame,
    high: int = 50,
    medium: int = 20,
    labels: tuple[str, str, str] = ("HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"),
) -> DataFrame:
    """Incident count and class of each known place, over all time."""
    places = _places(counts.where(F.col("latitude_centroid").isNotNull()))
    zone = V.three_levels(F.col("incident_count"), high, medium, labels, strict=True)
    return places.select(
        F.col("latitude_centroid").alias("latitude"),
        F.col("longitude_centroid").alias("longitude"),
        "incident_count",
        zone.alias("risk_zone"),
    )


def db_stats(counts: DataFrame, events: DataFrame, risk: DataFrame, as_of=None) -> DataFrame:
    """Warehouse counters; 'today' is ``as_of``, or the last day counted."""
    today = counts.agg(F.max("day")).scalar() if as_of is None else F.lit(as_of).cast("date")
    total = F.coalesce(F.sum("n_calls"), F.lit(0))
    return one_row(
        counts.sparkSession,
        {
            "total_911_calls": counts.agg(total),
            "total_events": events.agg(F.count("*")),
            "total_risk_scores": risk.agg(F.count("*")),
            "today_calls": counts.where(F.col("day") == today).agg(total),
        },
    )
