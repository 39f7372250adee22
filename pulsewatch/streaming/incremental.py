"""The daily load as an incremental stream over a landing folder.

The stream's checkpoint remembers which files were loaded, so a run picks up only
what is new. The upsert is idempotent, so a batch that is repeated after a failure
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsewatch import schemas
from pulsewatch.plans.pipeline import load_calls


def landed_calls(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Stream of raw calls from CSV files with the declared schema."""
    return (
        spark.readStream.schema(schemas.RAW_CALLS)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(landing)
    )


def load_stream(
    raw: DataFrame, geo: DataFrame, table: str, checkpoint: str, counts: str | None = None
) -> StreamingQuery:
    """Load everything that has landed since the last run, then stop.

    With ``counts``, the counts a day and place there follow each batch.
    """

    def load(batch: DataFrame, _: int) -> None:
        load_calls(batch, geo, table, counts)

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
