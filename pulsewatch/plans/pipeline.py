"""The daily run: raw exports to dimensions, fact tables, scores and a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch import schemas
from pulsewatch.operators import (
    clean,
    day_counts,
    forecast,
    joins,
    mining,
    reports,
    risk,
    series,
    warehouse,
    zones,
)
from pulsewatch.session import materialize
from pulsewatch.sources import readers, sinks

PARTITIONS = ["response_year", "response_month"]


@dataclass
class Gates:
    """What a model needs at least to run: calls for rules, calls with an hour for zones, days for the forecast."""

    rule_calls: int = 1000
    zone_calls: int = 100
    forecast_days: int = 30


@dataclass
class Paths:
    """Where the raw exports are and where the tables go; weather and venues may be missing."""

    calls: str
    events: str
    block_groups: str
    warehouse: str
    weather: str | None = None
    venues: str | None = None

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def partitioned(calls: DataFrame) -> DataFrame:
    """Add the year and month the fact of calls is partitioned by."""
    when = F.col("response_datetime")
    return calls.withColumns(
        {"response_year": F.year(when), "response_month": F.substring(F.to_date(when).cast("string"), 1, 7)}
    )


def enriched_calls(raw: DataFrame, geo: DataFrame) -> DataFrame:
    """Raw calls cleaned, placed and cut to the warehouse columns plus response time."""
    calls = joins.enrich_geo(clean.clean_calls(raw), geo)
    return partitioned(warehouse.load_fact_calls(calls, geo, ("response_time",)))


def load_calls(raw: DataFrame, geo: DataFrame, path: str, counts: str | None = None) -> None:
    """Upsert calls: unknown incidents are added, known ones take new coordinates.

    With ``counts``, the counts a day and place there follow. A load that is repeated after a
    failure touches the same partitions, so counts that a lost run left behind are mended.
    """

    def recount(touched: Column | None) -> None:
        day_counts.recount(raw.sparkSession, path, counts, PARTITIONS, touched)

    warehouse.upsert_partitions(
        path,
        enriched_calls(raw, geo),
        "incident_number",
        PARTITIONS,
        ["latitude_centroid", "longitude_centroid"],
        after=recount if counts else None,
    )


def load_weather(spark: SparkSession, paths: Paths) -> DataFrame | None:
    """Hourly and daily weather from landed JSON; the daily table, None without an export."""
    if not paths.weather:
        return None
    hourly = clean.build_dim_weather(readers.read_weather_json(spark, paths.weather))
    sinks.write_table(clean.keep_first(hourly, "datetime", ["temperature_c", "weather_code"]), paths.table("dim_weather"))
    sinks.write_table(clean.weather_daily(spark.read.parquet(paths.table("dim_weather"))), paths.table("dim_weather_daily"))
    return spark.read.parquet(paths.table("dim_weather_daily"))


def load_venues(spark: SparkSession, paths: Paths) -> None:
    if paths.venues:
        raw = readers.read_table(spark, paths.venues, schemas.RAW_VENUES)
        sinks.write_table(clean.build_dim_venue(raw), paths.table("dim_venue"))


def run_daily(spark: SparkSession, paths: Paths, run_date: str, gates: Gates | None = None) -> None:
    """Load the dimensions and calls, rebuild fact, scores and heatmaps, write the report.

    The run log says SUCCESS, or WARNING if an alert of that severity or a worse one was raised.
    """
    weather = load_weather(spark, paths)
    load_venues(spark, paths)
    geo = clean.build_dim_geo(readers.read_block_groups(spark, paths.block_groups))
    sinks.write_table(geo, paths.table("dim_geo"))
    raw_events = readers.read_events(spark, paths.events)
    events = clean.clean_events(raw_events)
    sinks.write_table(events, paths.table("dim_event"))
    dim_geo = spark.read.parquet(paths.table("dim_geo"))
    dim_event = spark.read.parquet(paths.table("dim_event"))

    raw_calls = readers.read_calls(spark, paths.calls)
    load_calls(raw_calls, dim_geo, paths.table("fact_calls"), paths.table("day_counts"))
    calls = spark.read.parquet(paths.table("fact_calls"))
    counts = spark.read.parquet(paths.table("day_counts"))

    sinks.write_table(
        joins.festival_incidents(calls, dim_event), paths.table("fact_festival_incidents")
    )
    fact = spark.read.parquet(paths.table("fact_festival_incidents"))
    sinks.write_snapshot(
        risk.risk_scores_sql(dim_event, fact, calls), paths.table("risk_scores"), run_date
    )
    scores = spark.read.parquet(paths.table("risk_scores")).where(
        F.col("run_date") == F.lit(run_date).cast("date")
    )
    sinks.write_table(day_counts.zone_heatmap(counts), paths.table("zone_clusters"))
    rolling = day_counts.rolling_heatmap(counts, month="response_month")
    sinks.write_table(rolling, paths.table("risk_heatmap"))
    rules, zone_count, forecast_avg = run_models(calls, paths, gates, weather)

    stats = day_counts.db_stats(counts, dim_event, scores)
    extracted = {"calls": raw_calls.count(), "events": raw_events.count()}
    report = reports.daily_report(
        stats, scores, f"daily-{run_date}", f"{run_date} 00:00:00", extracted, rules, zone_count, forecast_avg
    )
    sinks.write_report(report, paths.table(f"reports/{run_date}"))
    metrics = calls.sparkSession.createDataFrame(
        [(extracted["calls"], rules or 0, zone_count or 0)], "records_processed long, rules long, clusters long"
    ).withColumn("high_risk", scores.where(F.col("risk_category") == "HIGH").agg(F.count("*")).scalar())
    sinks.write_table(reports.pipeline_alerts(metrics), paths.table(f"alerts/{run_date}"))
    raised = spark.read.parquet(paths.table(f"alerts/{run_date}")).where("severity <> 'INFO'")
    log = reports.run_log_row(calls, "daily", "SUCCESS" if raised.isEmpty() else "WARNING", run_date)
    sinks.write_table(log, paths.table("pipeline_runs"), mode="append")


def run_models(
    calls: DataFrame, paths: Paths, gates: Gates | None = None, weather: DataFrame | None = None
) -> tuple[int | None, int | None, float | None]:
    """Rules, risk levels of places and the outlook for a week, each if there are data for it.

    Writes a table for each model that runs and returns its number for the report. With hourly
    weather the rules have weather items; the outlook takes the better of two models.
    """
    gates = gates or Gates()
    rule_count = zone_count = forecast_avg = None
    if zones.enough_rows(calls, gates.rule_calls):
        if weather is None:
            baskets = mining.count_baskets(calls, "slots")
        else:
            hourly = calls.sparkSession.read.parquet(paths.table("dim_weather"))
            baskets = mining.count_baskets(joins.join_weather(calls, hourly))
        itemsets = materialize(mining.frequent_itemsets(baskets, 0.01, None if weather is None else 0.005))
        rules = mining.rules_as_text(mining.association_rules(itemsets, "lift", 1.2))
        sinks.write_table(rules, paths.table("association_rules"))
        rule_count = calls.sparkSession.read.parquet(paths.table("association_rules")).count()
    places = materialize(risk.location_features(calls, with_response=False))
    timed = calls.where(F.col("response_hour").isNotNull())
    if zones.has_places(calls) and zones.enough_rows(timed, gates.zone_calls) and zones.enough_rows(places, 3):
        sinks.write_table(zones.cluster_levels(places), paths.table("zone_levels"))
        zone_count = calls.sparkSession.read.parquet(paths.table("zone_levels")).count()
    daily = materialize(series.daily_calls(calls))
    if zones.enough_rows(daily, gates.forecast_days):
        features = series.daily_features(daily)
        best = forecast.best_model(forecast.fit_models(features, columns=forecast.FEATURES))
        sinks.write_table(series.outlook_7d(daily, best.model), paths.table("forecast_7d"))
        week = calls.sparkSession.read.parquet(paths.table("forecast_7d"))
        forecast_avg = week.agg(F.avg("predicted_calls")).first()[0]
    return rule_count, zone_count, forecast_avg
