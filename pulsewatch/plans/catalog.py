"""Every registered query: a name, and a function from the tables to a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import schemas
from pulsewatch.functions import geo as G
from pulsewatch.functions import values as V
from pulsewatch.operators import (
    analysis,
    clean,
    day_counts,
    evaluation,
    forecast,
    joins,
    knn,
    matches,
    mining,
    planned,
    priority,
    quality,
    reports,
    risk,
    sampling,
    series,
    stats,
    warehouse,
    zones,
)
from pulsewatch.plans import pipeline
from pulsewatch.plans.fixtures import Tables
from pulsewatch.session import materialize, shared_dir
from pulsewatch.sources import readers

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
RENDERED: set[str] = set()


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def rendered(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """A query that gives its columns their comparable form itself, before rows multiply."""
    RENDERED.add(fn.__name__)
    return query(fn)


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six digits, whole numbers to long, dates and times to text.

    Both engines then print equal values the same way. The nudge of 1e-9 sends exact
    decimal ties (0.0000005) upwards whatever the last bit of the double is.
    """
    columns = []
    for f in df.schema:
        c, kind = F.col(f.name), f.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(1e-9), 6)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, "|")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        found = QUERIES[name](Tables(spark, sf_dir))
        return found if name in RENDERED else comparable(found)

    return run


# ---- sources ---------------------------------------------------------------------------------


@query
def scan_parquet(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", "event_type", "value")


@query
def date_range_of_calls(t: Tables) -> DataFrame:
    return readers.call_date_range(t.calls, ("2023-01-01", "2025-12-31"))


@query
def weather_from_json(t: Tables) -> DataFrame:
    documents = readers.parse_documents(t.weather_documents, "body", schemas.WEATHER_JSON)
    return readers.weather_rows(documents)


@query
def match_results(t: Tables) -> DataFrame:
    documents = readers.parse_documents(t.result_documents, "body", schemas.RESULTS_JSON)
    return readers.match_results(documents)


@query
def stored_standings(t: Tables) -> DataFrame:
    documents = readers.parse_documents(t.result_documents, "body", schemas.RESULTS_JSON)
    return readers.stored_standings(documents)


@query
def union_chunks(t: Tables) -> DataFrame:
    early = t.calls.where(F.col("response_hour") < 12).select("incident_number", "response_hour")
    late = t.calls.where(F.col("response_hour") >= 12).select(
        "response_hour", "incident_number", "geo_id"
    )
    return readers.union_chunks([early, late])


# ---- cleaning ----------------------------------------------------------------------------------


@query
def format_geo_id(t: Tables) -> DataFrame:
    raw = schemas.normalize_names(t.raw_calls)
    return raw.select(
        "incident_number", "call_closed_datetime", V.format_geo_id(F.col("geo_id")).alias("geo_id")
    )


@query
def parse_dates(t: Tables) -> DataFrame:
    raw = schemas.normalize_names(t.raw_events)
    return raw.select(
        F.col("folderrsn").alias("event_id"),
        V.permit_date(F.col("start_date")).alias("start_date"),
        V.permit_date(F.col("end_date")).alias("end_date"),
    )


@query
def clean_calls(t: Tables) -> DataFrame:
    order = [F.col("response_datetime").asc_nulls_last(), "response_time"]
    return clean.clean_calls(t.raw_calls, tiebreak=order)


@query
def clean_events(t: Tables) -> DataFrame:
    return clean.clean_events(t.raw_events)


@query
def event_flags(t: Tables) -> DataFrame:
    flags = ["has_alcohol", "has_amplified_sound", "has_road_closure"]
    flagged = clean.event_flags(schemas.normalize_names(t.raw_events))
    return flagged.select(F.col("folderrsn").alias("event_id"), *flags)


@query
def event_coords(t: Tables) -> DataFrame:
    placed = clean.event_coordinates(schemas.normalize_names(t.raw_events))
    return placed.select(F.col("folderrsn").alias("event_id"), "event_lat", "event_lon", "in_area")


@query
def dim_geo_lookup(t: Tables) -> DataFrame:
    return clean.build_dim_geo(t.raw_block_groups)


@query
def dim_venue(t: Tables) -> DataFrame:
    return clean.build_dim_venue(t.raw_venues)


@query
def dedupe_first(t: Tables) -> DataFrame:
    calls = t.calls.select("geo_id", "incident_number", "response_datetime", "response_time")
    return clean.keep_first(calls, "geo_id", ["response_datetime", "incident_number"])


@query
def weather_features(t: Tables) -> DataFrame:
    return t.weather


@query
def weather_daily(t: Tables) -> DataFrame:
    return clean.weather_daily(t.weather)


@query
def cyclic_features(t: Tables) -> DataFrame:
    featured = series.calendar_features(t.long_daily.select("date"))
    hours = t.calls.select("response_hour").distinct().select(
        F.col("response_hour").alias("hour"),
        V.cycle_sin(F.col("response_hour"), 24).alias("hour_sin"),
        V.cycle_cos(F.col("response_hour"), 24).alias("hour_cos"),
    )
    return featured.withColumn("hour", F.dayofmonth("date") % 24).join(hours, "hour")


@query
def sample_n(t: Tables) -> DataFrame:
    sampled = t.calls.select("incident_number", "response_time")
    return sampling.sample_rows(sampled, 500, "incident_number")


@query
def haversine(t: Tables) -> DataFrame:
    distance = G.haversine_km(
        F.col("latitude_centroid"), F.col("longitude_centroid"), F.lit(30.27), F.lit(-97.74)
    )
    return t.geo.select("geo_id", distance.alias("distance_km"))


# ---- joins ------------------------------------------------------------------------------------


@query
def enrich_geo(t: Tables) -> DataFrame:
    return t.enriched.select(
        "incident_number", "geo_id", "latitude_centroid", "longitude_centroid", "area_sq_km"
    )


@query
def unmatched_geo(t: Tables) -> DataFrame:
    return joins.unmatched_geo(t.calls, t.geo)


@query
def geo_match_rate(t: Tables) -> DataFrame:
    return joins.match_rate(t.enriched)


@rendered
def festival_incidents(t: Tables) -> DataFrame:
    return joins.festival_incidents(t.enriched, t.festivals, render=comparable)


@rendered
def festival_incidents_shuffled(t: Tables) -> DataFrame:
    """The same join with the events too many to broadcast: salted shuffle on both sides."""
    fact = joins.festival_incidents(t.enriched, t.festivals, broadcast_rows=0, render=comparable)
    return fact.select("incident_number", "event_id", "distance_km")


@rendered
def festival_incidents_day(t: Tables) -> DataFrame:
    fact = joins.festival_incidents(
        t.enriched, t.festivals, radius_km=0.5, end_inclusive_day=True, render=comparable
    )
    return fact.select(
        "incident_number", "event_id", "distance_km", "event_name", "event_has_alcohol"
    )


@query
def events_in_range(t: Tables) -> DataFrame:
    return joins.events_in_range(t.festivals, t.calls).select("event_id", "start_date", "end_date")


@query
def calls_weather(t: Tables) -> DataFrame:
    return t.calls_weather.select(
        "incident_number", "join_hour", "temperature_f", "precipitation_mm", "humidity_pct",
        "weather_category", "is_raining", "temp_category",
    )


@query
def calls_festival_flag(t: Tables) -> DataFrame:
    return t.flagged.select("incident_number", "is_festival_related")


@query
def distinct_ids(t: Tables) -> DataFrame:
    return t.fact.select("incident_number").distinct()


@query
def nearby_incidents(t: Tables) -> DataFrame:
    return joins.nearby_incidents(t.enriched, 30.27, -97.74, 5.0)


@query
def nearby_batch(t: Tables) -> DataFrame:
    points = t.geo.select(
        F.col("geo_id").alias("point_id"),
        (F.col("latitude_centroid") + 0.001).alias("lat"),
        F.col("longitude_centroid").alias("lon"),
    )
    found = joins.nearby_batch(t.enriched, points, 2.5)
    return found.select("point_id", "incident_number", "distance_m")


@query
def fk_nullify(t: Tables) -> DataFrame:
    calls = t.calls.select("incident_number", "geo_id")
    return joins.nullify_missing_fk(calls, t.geo, "geo_id")


# ---- aggregations ---------------------------------------------------------------------------------


@query
def events_summary(t: Tables) -> DataFrame:
    return risk.events_summary(t.fact)


@query
def priority_pivot(t: Tables) -> DataFrame:
    return risk.priority_pivot(t.fact)


@query
def top_incident_type(t: Tables) -> DataFrame:
    return risk.top_incident_type(t.fact)


@query
def festival_risk(t: Tables) -> DataFrame:
    return risk.festival_risk(t.counted_fact)


@query
def risk_filtered(t: Tables) -> DataFrame:
    scored = risk.festival_risk(t.counted_fact)
    return risk.filter_risk(scored, ["HIGH", "MEDIUM"], alcohol=True).select(
        "event_id", "event_name", "incident_count", "risk_score", "risk_category"
    )


@query
def top_festivals(t: Tables) -> DataFrame:
    top = risk.top_rows(risk.festival_risk(t.counted_fact), "incident_count", 10, "event_id")
    return top.select("event_id", "event_name", "incident_count", "risk_category")


@query
def risk_distribution(t: Tables) -> DataFrame:
    return analysis.risk_distribution(risk.festival_risk(t.counted_fact))


@query
def weather_rates(t: Tables) -> DataFrame:
    return analysis.weather_rates(t.calls_weather, t.weather)


@query
def temp_incidents(t: Tables) -> DataFrame:
    return analysis.temperature_incidents(t.calls_weather)


@query
def rain_comparison(t: Tables) -> DataFrame:
    return analysis.rain_comparison(t.calls_weather)


@query
def hourly_weather(t: Tables) -> DataFrame:
    return analysis.hourly_weather(t.calls_weather)


@query
def weather_correlation(t: Tables) -> DataFrame:
    return analysis.weather_correlation(t.calls_weather)


@query
def alcohol_summary(t: Tables) -> DataFrame:
    return analysis.alcohol_summary(risk.events_summary(t.fact))


@query
def alcohol_types(t: Tables) -> DataFrame:
    return analysis.alcohol_types(t.fact)


@query
def alcohol_priority(t: Tables) -> DataFrame:
    return analysis.alcohol_priority(t.fact)


@query
def alcohol_avg_diff(t: Tables) -> DataFrame:
    return analysis.alcohol_average_gap(risk.events_summary(t.fact))


@query
def response_summary(t: Tables) -> DataFrame:
    return analysis.response_summary(t.flagged)


@query
def response_by_priority(t: Tables) -> DataFrame:
    return analysis.response_by_priority(t.flagged)


@query
def response_by_hour(t: Tables) -> DataFrame:
    return analysis.response_by_hour(t.flagged)


@query
def location_features(t: Tables) -> DataFrame:
    return risk.location_features(t.enriched)


@query
def daily_calls(t: Tables) -> DataFrame:
    return t.long_daily


@query
def monthly_calls(t: Tables) -> DataFrame:
    return analysis.monthly_calls(t.long_calls)


@query
def zone_heatmap(t: Tables) -> DataFrame:
    return risk.zone_heatmap(t.enriched)


@query
def risk_heatmap_30d(t: Tables) -> DataFrame:
    return risk.risk_heatmap(t.enriched, days=30)


def _counted(t: Tables) -> DataFrame:
    """Counts a day and place after three loads whose days overlap, the last one repeated."""
    folder = f"{shared_dir(t.spark)}/counted-{uuid.uuid4().hex}"
    calls, counts = f"{folder}/calls", f"{folder}/counts"
    rows = materialize(pipeline.partitioned(t.enriched))
    load = F.pmod(F.crc32("incident_number"), F.lit(3))
    for part in (0, 1, 2, 2):
        warehouse.upsert_partitions(
            calls, rows.where(load == part), "incident_number", pipeline.PARTITIONS,
            after=lambda touched: day_counts.recount(t.spark, calls, counts, pipeline.PARTITIONS, touched),
        )
    return t.spark.read.parquet(counts)


@query
def risk_heatmap_merged(t: Tables) -> DataFrame:
    """The 30-day heatmap from counts that loads have kept up to date."""
    return day_counts.rolling_heatmap(_counted(t), days=30, month="response_month")


@query
def zone_heatmap_merged(t: Tables) -> DataFrame:
    return day_counts.zone_heatmap(day_counts.count_days(t.enriched))


@query
def db_stats_merged(t: Tables) -> DataFrame:
    counts = materialize(day_counts.count_days(t.enriched))
    scores = risk.risk_scores_sql(t.festivals, t.summed_fact, t.calls, variant=1)
    return day_counts.db_stats(counts, t.festivals, scores)


@query
def festival_summary(t: Tables) -> DataFrame:
    return risk.festival_summary(t.festivals, t.summed_fact, t.calls)


@query
def risk_scores_sql_v1(t: Tables) -> DataFrame:
    return risk.risk_scores_sql(t.festivals, t.summed_fact, t.calls, variant=1)


@query
def risk_scores_sql_v2(t: Tables) -> DataFrame:
    return risk.risk_scores_sql(t.festivals, t.summed_fact, t.calls, variant=2)


@query
def db_stats(t: Tables) -> DataFrame:
    scores = risk.risk_scores_sql(t.festivals, t.summed_fact, t.calls)
    return reports.db_stats(t.calls, t.festivals, scores)


@query
def overview_kpis(t: Tables) -> DataFrame:
    fact = materialize(t.counted_fact)
    linked = joins.linked_calls(t.enriched, fact)
    return analysis.overview_kpis(t.calls, fact, risk.festival_risk(fact), linked)


@query
def value_counts(t: Tables) -> DataFrame:
    return analysis.value_counts(t.calls, "priority_level")


@query
def alcohol_by_year(t: Tables) -> DataFrame:
    return analysis.alcohol_by_year(clean.clean_events(t.raw_events))


@query
def distance_stats(t: Tables) -> DataFrame:
    return analysis.distance_stats(t.fact)


@query
def describe_geo(t: Tables) -> DataFrame:
    return stats.describe(
        t.geo, ["latitude_centroid", "longitude_centroid", "area_sq_km"]
    )


@query
def describe_calls(t: Tables) -> DataFrame:
    return stats.describe(t.calls, ["response_time", "response_hour"])


@query
def null_profile(t: Tables) -> DataFrame:
    return analysis.null_profile(schemas.normalize_names(t.raw_calls))


@query
def schedule_stats(t: Tables) -> DataFrame:
    return matches.schedule_stats(t.match_rows)


@query
def head_n(t: Tables) -> DataFrame:
    first = quality.sample_head(t.fact, 1000, "incident_number", "event_id")
    return first.select("incident_number", "event_id", "priority_level")


# ---- windows and series -----------------------------------------------------------------------------


@query
def daily_features(t: Tables) -> DataFrame:
    return series.daily_features(t.long_daily, t.long_weather)


@query
def daily_features_filled(t: Tables) -> DataFrame:
    """Options: calendar filled, current day outside its own rolling window."""
    return series.daily_features(
        t.long_daily, lags=(1, 7), windows=(7,), exclude_current=True, fill_calendar=True,
        complete_only=False,
    ).select("date", "call_count", "call_count_lag_1", "call_count_lag_7",
             "call_count_rolling_mean_7", "call_count_rolling_std_7")


@query
def forecast_split(t: Tables) -> DataFrame:
    return series.time_split(t.long_daily).select("date", "call_count", "is_train")


@query
def forecast_inputs_7d(t: Tables) -> DataFrame:
    return series.next_week(t.long_daily)


@query
def forecast_7d_mean(t: Tables) -> DataFrame:
    return series.outlook_7d(t.long_daily)


# ---- statistics -------------------------------------------------------------------------------------


@query
def ttest_alcohol(t: Tables) -> DataFrame:
    return stats.t_test(risk.events_summary(t.fact), "has_alcohol", "incident_count")


@query
def ttest_response(t: Tables) -> DataFrame:
    kept = t.flagged.where(F.col("response_time") < 7200)
    return stats.t_test(kept, "is_festival_related", "response_time", min_rows=10)


@query
def mannwhitney(t: Tables) -> DataFrame:
    return stats.mann_whitney(risk.events_summary(t.fact), "has_alcohol", "incident_count")


@query
def mannwhitney_response(t: Tables) -> DataFrame:
    """U over a continuous measure of all calls: many distinct values."""
    calls = t.calls.withColumn("is_urgent", F.col("priority_numeric") <= 1)
    return stats.mann_whitney(calls, "is_urgent", "response_time")


@query
def significance(t: Tables) -> DataFrame:
    """p-values and stars of all tests."""
    summary = materialize(risk.events_summary(t.fact))
    picks = [F.col("p_value"), F.col("stars")]
    tests = {
        "ttest_alcohol": stats.t_test(summary, "has_alcohol", "incident_count"),
        "mannwhitney_alcohol": stats.mann_whitney(summary, "has_alcohol", "incident_count"),
    }
    frames = [df.select(F.lit(name).alias("test"), *picks) for name, df in tests.items()]
    frames.append(
        analysis.weather_correlation(t.calls_weather).select(F.col("variable").alias("test"), *picks)
    )
    return readers.union_chunks(frames)


# ---- mining -----------------------------------------------------------------------------------------


def _rules_input(t: Tables) -> DataFrame:
    return mining.count_baskets(t.calls_weather)


@query
def baskets(t: Tables) -> DataFrame:
    return mining.make_baskets(t.calls_weather)


@query
def baskets_festival(t: Tables) -> DataFrame:
    """Baskets with the items of the event context as well."""
    return mining.make_baskets(joins.flag_event_context(t.calls_weather, t.fact))


@query
def baskets_dag(t: Tables) -> DataFrame:
    return mining.make_baskets(t.calls, variant="slots")


@query
def frequent_itemsets(t: Tables) -> DataFrame:
    return mining.frequent_itemsets(_rules_input(t), 0.01)


@query
def rules(t: Tables) -> DataFrame:
    itemsets = materialize(mining.frequent_itemsets(_rules_input(t), 0.01))
    return mining.association_rules(itemsets, "confidence", 0.3)


@query
def rules_dag(t: Tables) -> DataFrame:
    found = materialize(mining.frequent_itemsets(mining.count_baskets(t.calls, "slots"), 0.01, None))
    return mining.rules_as_text(mining.association_rules(found, "lift", 1.2))


@query
def rules_retry(t: Tables) -> DataFrame:
    """No item is in nine baskets of ten, so the lower support applies."""
    found = materialize(mining.frequent_itemsets(mining.count_baskets(t.calls, "slots"), 0.9, 0.005))
    rules = mining.association_rules(found, "lift", 1.2)
    return rules.select("antecedents", "consequents", "support", "confidence", "lift")


@query
def rules_incident(t: Tables) -> DataFrame:
    itemsets = materialize(mining.frequent_itemsets(_rules_input(t), 0.01))
    found = mining.association_rules(itemsets, "confidence", 0.1)
    return mining.rules_with(found, "consequents", "Incident_").select(
        "antecedents", "consequents", "support", "confidence", "lift"
    )


@query
def rules_filtered(t: Tables) -> DataFrame:
    itemsets = materialize(mining.frequent_itemsets(_rules_input(t), 0.01))
    found = mining.filter_rules(mining.association_rules(itemsets), 0.4, 1.0)
    weather = mining.rules_with(found, "antecedents", "Weather_")
    return weather.select("antecedents", "consequents", "support", "confidence", "lift")


@query
def top_rules(t: Tables) -> DataFrame:
    itemsets = materialize(mining.frequent_itemsets(mining.count_baskets(t.calls), 0.01))
    top = mining.top_rules(mining.association_rules(itemsets), 15)
    return top.select("rule", "support", "confidence", "lift")


# ---- models -------------------------------------------------------------------------------------------


@query
def zone_clusters(t: Tables) -> DataFrame:
    places = risk.location_features(t.enriched)
    clustered = zones.cluster_zones(places, ks=range(3, 10), restarts=10)
    return clustered.select(
        "latitude", "longitude", "incident_count", "location_risk", "cluster", "risk_zone"
    )


@query
def zone_levels(t: Tables) -> DataFrame:
    places = risk.location_features(t.enriched, with_response=False)
    return zones.cluster_levels(places, restarts=10).select(
        "latitude", "longitude", "incident_count", "location_risk", "cluster", "risk_level"
    )


@query
def hour_clusters(t: Tables) -> DataFrame:
    return zones.cluster_hours(t.calls, restarts=10)


@query
def cluster_stats(t: Tables) -> DataFrame:
    return zones.cluster_stats(t.given_clusters())


@query
def zone_labels(t: Tables) -> DataFrame:
    clustered = materialize(t.given_clusters())
    labels = zones.label_zones(zones.cluster_stats(clustered))
    return zones.with_zone(clustered, labels).select("latitude", "longitude", "cluster", "risk_zone")


@query
def top_categories(t: Tables) -> DataFrame:
    named = knn.top_categories(t.calls, "initial_problem_category", 4, "incident_category")
    return named.select("incident_number", "incident_category")


@query
def knn_features(t: Tables) -> DataFrame:
    return knn.knn_features(t.calls_weather)[0]


def _knn_split(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    rows, columns = knn.knn_features(t.calls_weather)
    split = materialize(sampling.stratified_split(rows, "incident_category", "incident_number"))
    return split.where("is_train"), split.where("NOT is_train"), columns


@query
def knn_classify(t: Tables) -> DataFrame:
    train, test, columns = _knn_split(t)
    return knn.knn_classify(train, test, columns)[0]


@query
def knn_accuracy(t: Tables) -> DataFrame:
    train, test, columns = _knn_split(t)
    return knn.knn_classify(train, test, columns)[1]


@query
def stratified_split(t: Tables) -> DataFrame:
    rows = t.calls.select("incident_number", "final_problem_category")
    return sampling.stratified_split(rows, "final_problem_category", "incident_number")


@query
def classification_report(t: Tables) -> DataFrame:
    """Report over a rule-based guess of the priority, so that SQL can follow it."""
    guess = (F.col("response_hour") % 5).cast("int")
    rows = t.calls.select(F.col("priority_numeric").alias("label"), guess.alias("prediction"))
    return evaluation.classification_report(rows)


@query
def priority_features(t: Tables) -> DataFrame:
    return priority.priority_features(t.calls_weather)[0]


def _priority_split(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    rows, columns = priority.priority_features(t.calls_weather)
    split = materialize(sampling.stratified_split(rows, "priority_class", "incident_number"))
    return split.where("is_train"), split.where("NOT is_train"), columns


@query
def rf_priority(t: Tables) -> DataFrame:
    train, test, columns = _priority_split(t)
    model = priority.train_priority(train, columns, trees=100, depth=15)
    return priority.predict(model, test, "incident_number", "priority_class")


@query
def rf_importance(t: Tables) -> DataFrame:
    train, _, columns = _priority_split(t)
    model = priority.train_priority(train, columns, trees=100, depth=15)
    return priority.feature_importance(t.spark, model, columns)


@query
def rf_cv(t: Tables) -> DataFrame:
    train, _, columns = _priority_split(t)
    accuracy = priority.cross_validate(train, columns, trees=100, depth=15)
    return train.agg(F.count("*").alias("rows")).withColumn("cv_accuracy", F.lit(accuracy))


@query
def rf_small(t: Tables) -> DataFrame:
    return priority.small_forest(t.calls)


def _long_features(t: Tables) -> DataFrame:
    return series.daily_features(t.long_daily, t.long_weather)


@query
def forecast_ridge(t: Tables) -> DataFrame:
    return forecast.forecast(_long_features(t), which=("ridge",))


@query
def forecast_gbt(t: Tables) -> DataFrame:
    return forecast.forecast(_long_features(t), which=("gbt",), trees=100)


@query
def forecast_best(t: Tables) -> DataFrame:
    return forecast.forecast(_long_features(t), trees=100)


@query
def forecast_7d(t: Tables) -> DataFrame:
    features = series.daily_features(t.long_daily)
    fitted = forecast.fit_models(features, which=("ridge",), columns=forecast.FEATURES)
    return series.outlook_7d(t.long_daily, fitted[0].model)


def _naive_forecast(t: Tables) -> DataFrame:
    """Yesterday's count as the forecast: deterministic input for the error reports."""
    lagged = series.add_lags(t.long_daily, "call_count", (1,))
    return lagged.where(F.col("call_count_lag_1").isNotNull()).select(
        "date",
        F.col("call_count").cast("double").alias("actual"),
        F.col("call_count_lag_1").cast("double").alias("predicted"),
    )


@query
def forecast_metrics(t: Tables) -> DataFrame:
    return analysis.forecast_metrics(_naive_forecast(t))


@query
def residual_histogram(t: Tables) -> DataFrame:
    return analysis.residual_histogram(_naive_forecast(t))


@query
def model_summary(t: Tables) -> DataFrame:
    """Status and measures of each model run."""

    def rules_run() -> dict[str, float]:
        itemsets = materialize(mining.frequent_itemsets(mining.count_baskets(t.calls), 0.01))
        return {"rules_count": mining.association_rules(itemsets).count()}

    def zones_run() -> dict[str, float]:
        places = zones.cluster_levels(risk.location_features(t.enriched, False), restarts=10)
        row = places.agg(F.countDistinct("cluster"), F.count("*")).first()
        return {"clusters": row[0], "locations": row[1]}

    def knn_run() -> dict[str, float]:
        train, test, columns = _knn_split(t)
        accuracy = knn.knn_classify(train, test, columns)[1]
        return {"accuracy": accuracy.agg(F.max("accuracy")).first()[0]}

    def forecast_run() -> dict[str, float]:
        best = forecast.best_model(forecast.fit_models(_long_features(t)))
        return {m: best.metrics[m] for m in ("r2", "mae")}

    def forest_run() -> dict[str, float]:
        train, test, columns = _priority_split(t)
        model = priority.train_priority(train, columns, trees=100, depth=15)
        scored = priority.predict(model, test, "incident_number", "priority_class")
        hit = F.avg((F.col("label") == F.col("prediction")).cast("int"))
        return {"accuracy": scored.agg(hit).first()[0]}

    return reports.run_models(
        t.spark,
        {
            "association_rules": rules_run,
            "kmeans": zones_run,
            "knn": knn_run,
            "timeseries": forecast_run,
            "random_forest": forest_run,
        },
    )


# ---- planned events and matches ------------------------------------------------------------------------


@query
def planned_event_risk(t: Tables) -> DataFrame:
    return t.scored_events.select(
        "event_id", "start_hour", "is_weekend", "zone_category", "zone_lat", "zone_lon",
        "predicted_incidents", "risk_score", "risk_category",
    )


@query
def planned_priority_mix(t: Tables) -> DataFrame:
    return planned.planned_priority_mix(t.scored_events)


@query
def planned_incident_mix(t: Tables) -> DataFrame:
    return planned.planned_incident_mix(t.scored_events)


@query
def planned_alerts(t: Tables) -> DataFrame:
    return planned.planned_alerts(t.scored_events)


@query
def planned_staffing(t: Tables) -> DataFrame:
    return planned.planned_staffing(t.scored_events).select(
        "event_id", "medical_staff", "security_staff", "doctors", "nurses", "first_aiders",
        "police", "fixed_posts", "ambulances", "first_aid_points", "radios",
    )


@query
def match_risk(t: Tables) -> DataFrame:
    return t.scored_matches.select(
        "match_id", "city", "capacity", "fill_rate", "stadium_factor", "phase_factor",
        "time_factor", "rivalry_factor", "host_factor", "weekend_factor", "weather_factor",
        "alcohol_factor", "total_factor", "predicted_incidents", "risk_score", "risk_category",
    )


@query
def match_staffing(t: Tables) -> DataFrame:
    return matches.match_staffing(t.scored_matches).select(
        "match_id", "security_staff", "medical_staff", "ambulances", "private_agents", "police",
        "special_forces", "checkpoints", "doctors", "nurses", "first_aiders", "gates", "cameras",
        "drones",
    )


@query
def match_incident_mix(t: Tables) -> DataFrame:
    return matches.match_incident_mix(t.scored_matches)


@query
def match_alerts(t: Tables) -> DataFrame:
    return matches.match_alerts(t.scored_matches)


@query
def schedule(t: Tables) -> DataFrame:
    view = matches.schedule(t.match_rows, phases=["Groupe A", "Quarts"], cities=["Rabat", "Fez"])
    return view.select("match_id", "icon", "kickoff", "label", "stadium", "city", "phase")


@query
def standings(t: Tables) -> DataFrame:
    return matches.standings(t.match_rows, matches.group_frame(t.spark))


@query
def early_warning(t: Tables) -> DataFrame:
    return reports.early_warning(t.early_inputs).select("event_id", "warning_score")


# ---- warehouse -----------------------------------------------------------------------------------------


def _geo_update(t: Tables) -> DataFrame:
    """Some block groups with a new area, and some the warehouse lacks."""
    n = F.col("n_nationkey")
    return t.table("nation").where(n % 2 == 0).select(
        F.lpad((F.lit(484530001000) + n * 2).cast("string"), 12, "0").alias("geo_id"),
        (F.lit(31.0) + n).alias("latitude_centroid"),
        (F.lit(-97.0) - n).alias("longitude_centroid"),
        (n * 2.5).alias("area_sq_km"),
    )


@query
def upsert_geo(t: Tables) -> DataFrame:
    return warehouse.upsert(t.geo, _geo_update(t), "geo_id")


@query
def upsert_partial(t: Tables) -> DataFrame:
    """Fact rows: known incidents take only new coordinates."""
    columns = ["incident_number", "latitude_centroid", "longitude_centroid", "priority_level"]
    base = t.enriched.where(F.col("response_hour") < 16).select(*columns)
    new = t.enriched.where(F.col("response_hour") >= 8).select(
        "incident_number",
        (F.col("latitude_centroid") + 1).alias("latitude_centroid"),
        (F.col("longitude_centroid") - 1).alias("longitude_centroid"),
        F.lit("changed").alias("priority_level"),
    )
    return warehouse.upsert(
        base, new, "incident_number", ["latitude_centroid", "longitude_centroid"]
    )


@query
def insert_new(t: Tables) -> DataFrame:
    return warehouse.insert_new(t.geo, _geo_update(t), "geo_id")


@query
def load_fact_calls(t: Tables) -> DataFrame:
    return warehouse.load_fact_calls(t.enriched, t.geo)


@query
def load_dim_event(t: Tables) -> DataFrame:
    return warehouse.load_dim_event(t.festivals)


@query
def freshness(t: Tables) -> DataFrame:
    return warehouse.freshness(t.calls, "response_datetime")


@query
def rebuild_plan(t: Tables) -> DataFrame:
    return warehouse.rebuild_plan(t.file_inventory, t.calls.agg(F.count("*")))


@query
def incremental_new(t: Tables) -> DataFrame:
    loaded = t.calls.where(F.col("response_date") < F.lit("2024-01-25").cast("date"))
    return warehouse.incremental_rows(t.calls, loaded).select(
        "incident_number", "response_datetime"
    )


@query
def table_counts(t: Tables) -> DataFrame:
    tables = {"dim_geo": t.geo, "dim_event": t.festivals, "fact_calls": t.calls}
    return warehouse.table_counts(tables)


@query
def pipeline_runs(t: Tables) -> DataFrame:
    return reports.run_log_row(t.calls, "daily", "SUCCESS", "2024-02-01")


# ---- quality and reports ---------------------------------------------------------------------------------


@query
def quality_checks(t: Tables) -> DataFrame:
    checks = quality.Checks(
        unique=["incident_number", "geo_id"],
        ranges={"latitude_centroid": (25.0, 37.0), "longitude_centroid": (-107.0, -93.0)},
        positive=["area_sq_km"],
        lengths={"geo_id": 12},
        required=["incident_number", "missing_column"],
        dated=["response_date"],
        min_filled_pct={"latitude_centroid": 50.0},
    )
    return quality.quality_checks(t.enriched, checks)


@query
def profile(t: Tables) -> DataFrame:
    return quality.profile(t.calls, "incident_number")


@query
def daily_report(t: Tables) -> DataFrame:
    scores = materialize(risk.risk_scores_sql(t.festivals, t.summed_fact, t.calls))
    counters = reports.db_stats(t.calls, t.festivals, scores)
    report = reports.daily_report(counters, scores, "run-1", "2024-02-01 06:00:00", rules=24)
    return report.select(*[F.to_json(c).alias(c) for c in report.columns])


@query
def pipeline_alerts(t: Tables) -> DataFrame:
    """Alerts per day of the calls: days play the role of runs."""
    runs = t.calls.groupBy("response_date").agg(
        F.count("*").alias("records_processed"),
        (F.count_if(F.col("priority_numeric") == 0)).alias("high_risk"),
        F.count_if(F.col("final_problem_category") == "signup").alias("rules"),
        F.lit(0).alias("clusters"),
    )
    return reports.pipeline_alerts(runs)
