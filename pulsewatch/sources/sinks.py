"""Table sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch import schemas


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write Parquet, CSV with header, or JSON lines."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_by_suffix(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Choose the format from the path: .csv, .json, else Parquet."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1]
    write_table(df, path, suffix if suffix in ("csv", "json") else "parquet", mode)


def write_calls(df: DataFrame, path: str) -> None:
    """Cleaned or enriched calls, partitioned by year and month.

    The rebalance hint gathers a month into few files and lets adaptive execution
    split a heavy month into tasks of the advisory size.
    """
    (
        df.hint("rebalance", "response_year", "response_month")
        .write.mode("overwrite")
        .partitionBy("response_year", "response_month")
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, run_date: str, partition: str = "run_date") -> None:
    """One dated snapshot per run; a rerun of the same day replaces only that day."""
    (
        df.withColumn(partition, F.lit(run_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """One nested report row as a JSON document."""
    report.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Fitted pipeline (scaler and model together) in Spark's own format."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def append_run_log(
    spark: SparkSession, path: str, dag_id: str, status: str, records: int, run_date
) -> None:
    row = spark.createDataFrame([(run_date, dag_id, status, records)], schemas.PIPELINE_RUNS)
    row.write.mode("append").parquet(path)
