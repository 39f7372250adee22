"""Nested daily report, pipeline alerts and model summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.operators.analysis import one_row


def db_stats(calls: DataFrame, events: DataFrame, risk: DataFrame, as_of=None) -> DataFrame:
    """Warehouse counters; 'today' is ``as_of``, or the day of the newest call."""
    day = F.to_date("response_datetime")
    today = calls.agg(F.max(day)).scalar() if as_of is None else F.lit(as_of).cast("date")
    return one_row(
        calls.sparkSession,
        {
            "total_911_calls": calls.agg(F.count("*")),
            "total_events": events.agg(F.count("*")),
            "total_risk_scores": risk.agg(F.count("*")),
            "today_calls": calls.where(day == today).agg(F.count("*")),
        },
    )


def daily_report(
    stats: DataFrame,
    risk: DataFrame,
    run_id: str,
    generated_at: str,
    extracted: dict[str, int] | None = None,
    rules: int | None = None,
    zones: int | None = None,
    forecast_avg: float | None = None,
) -> DataFrame:
    """One nested report row, ready for the JSON sink.

    A model whose result is None did not run: its status is SKIPPED and its number null.
    """
    extracted = extracted or {}
    counts = risk.groupBy("risk_category").agg(F.count("*").alias("n"))
    distribution = counts.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("risk_category", "n"))))
    ).scalar()

    def model(value: Column, name: str) -> Column:
        status = F.when(value.isNull(), "SKIPPED").otherwise("COMPLETED")
        return F.struct(status.alias("status"), value.alias(name))

    mean_calls = F.bround(F.lit(forecast_avg).cast("double"), 1)
    when = F.lit(generated_at).cast("timestamp_ntz")
    return stats.select(
        F.struct(
            F.lit("pulsewatch_daily").alias("pipeline_name"),
            F.lit(run_id).alias("run_id"),
            when.alias("generated_at"),
            F.to_date(when).alias("report_date"),
            F.lit("SUCCESS").alias("status"),
        ).alias("report_metadata"),
        F.struct(
            F.lit(extracted.get("calls", 0)).cast("long").alias("call_records"),
            F.lit(extracted.get("events", 0)).cast("long").alias("event_records"),
            F.coalesce(
                F.nullif(F.lit(extracted.get("calls", 0)).cast("long"), F.lit(0)),
                F.col("total_911_calls"),
            ).alias("call_records_processed"),
        ).alias("data_processing"),
        F.struct(*stats.columns).alias("database_stats"),
        F.struct(
            model(F.lit(rules).cast("int"), "rules_discovered").alias("association_rules"),
            model(F.lit(zones).cast("int"), "zones_clustered").alias("clustering"),
            model(mean_calls, "avg_predicted_calls").alias("forecasting"),
            model(distribution, "distribution").alias("risk_scoring"),
        ).alias("ml_models"),
    )


def rule_alerts(metrics: DataFrame, rules: list[tuple[Column, dict[str, Column | str]]]) -> DataFrame:
    """Rows of a metrics frame through (predicate, alert fields) rules; one row per hit."""
    alerts = [
        F.when(
            predicate,
            F.struct(
                *[
                    (value if isinstance(value, Column) else F.lit(value)).alias(name)
                    for name, value in fields.items()
                ]
            ),
        )
        for predicate, fields in rules
    ]
    return metrics.select(F.inline(F.array_compact(F.array(*alerts))))


def pipeline_alerts(metrics: DataFrame) -> DataFrame:
    """Alerts of one run from (records_processed, high_risk, rules, clusters)."""
    records, high = F.col("records_processed"), F.col("high_risk")
    return rule_alerts(
        metrics,
        [
            (
                records == 0,
                {
                    "severity": "WARNING",
                    "type": "DATA_VOLUME",
                    "message": "No 911 records were processed in this run",
                    "action_required": "Check the raw-data folder for source files",
                },
            ),
            (
                (records > 0) & (records < 100),
                {
                    "severity": "INFO",
                    "type": "LOW_VOLUME",
                    "message": F.format_string(
                        "Only %d records processed (below normal)", records
                    ),
                    "action_required": "Review data source for completeness",
                },
            ),
            (
                high > 10,
                {
                    "severity": "CRITICAL",
                    "type": "HIGH_RISK_SPIKE",
                    "message": F.format_string("%d events classified as HIGH risk", high),
                    "action_required": "Review high-risk events and allocate resources",
                },
            ),
            (
                (F.col("rules") == 0) & (F.col("clusters") == 0),
                {
                    "severity": "WARNING",
                    "type": "ML_MODEL_FAILURE",
                    "message": "No ML model produced results",
                    "action_required": "Check the stored models",
                },
            ),
        ],
    )


def run_log_row(calls: DataFrame, dag_id: str, status: str, run_date: str) -> DataFrame:
    """Log row of a run that processed ``calls``."""
    return calls.agg(F.count("*").alias("records_processed")).select(
        F.lit(run_date).cast("timestamp_ntz").alias("run_date"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(status).alias("status"),
        "records_processed",
    )


def run_models(
    spark: SparkSession, runs: dict[str, Callable[[], dict[str, float]]]
) -> DataFrame:
    """Run each model, and record its status and measures; one failure stops no other."""
    rows = []
    for name, run in runs.items():
        try:
            measures = run()
            rows += [(name, "SUCCESS", m, float(v), None) for m, v in measures.items()]
        except Exception as error:
            rows.append((name, "FAILED", None, None, str(error)))
    return spark.createDataFrame(
        rows, "model string, status string, measure string, value double, error string"
    )


def early_warning(df: DataFrame) -> DataFrame:
    """Weighted sum of five normalised factors."""
    score = (
        F.col("volume") * 0.30
        + F.col("zone") * 0.25
        + F.col("alcohol") * 0.20
        + F.col("weather") * 0.15
        + F.col("hour_factor") * 0.10
    )
    return df.withColumn("warning_score", score)
