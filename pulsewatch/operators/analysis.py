"""Weather, alcohol and response-time analyses, and generic distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewatch.operators.stats import distribution, pearson


def _activity(df: DataFrame, key: str) -> DataFrame:
    """Incident count, mean priority and mean response time; NULL keys form no group."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("incident_number").alias("incident_count"),
            F.avg("priority_numeric").alias("avg_priority"),
            F.avg("response_time").alias("avg_response_time"),
        )
    )


def weather_rates(joined: DataFrame, weather: DataFrame) -> DataFrame:
    """Incidents by weather class, also per hour of such weather."""
    hours = (
        weather.where(F.col("weather_category").isNotNull())
        .groupBy("weather_category")
        .agg(F.count("*").alias("total_hours"))
    )
    rated = _activity(joined, "weather_category").join(hours, "weather_category")
    return rated.withColumn(
        "incidents_per_hour", F.col("incident_count") / F.col("total_hours")
    ).orderBy(F.desc("incidents_per_hour"), "weather_category")


def temperature_incidents(joined: DataFrame) -> DataFrame:
    return _activity(joined, "temp_category")


def rain_comparison(joined: DataFrame) -> DataFrame:
    return _activity(joined, "is_raining")


def hourly_weather(joined: DataFrame) -> DataFrame:
    """Incidents per hour beside the weather of that hour."""
    return joined.groupBy("join_hour").agg(
        F.count("incident_number").alias("incident_count"),
        F.max("temperature_f").alias("temperature_f"),
        F.max("precipitation_mm").alias("precipitation_mm"),
        F.max("humidity_pct").alias("humidity_pct"),
    )


def weather_correlation(joined: DataFrame) -> DataFrame:
    """Pearson r of each weather measure with the hourly incident count."""
    hourly = hourly_weather(joined)
    return pearson(
        hourly,
        {
            "temperature": ("temperature_f", "incident_count"),
            "precipitation": ("precipitation_mm", "incident_count"),
            "humidity": ("humidity_pct", "incident_count"),
        },
    )


def _rows(entries: list[tuple[str, Column, Column]], left: str, right: str) -> Column:
    """Turn named (left, right) measures of one wide row into rows."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(name).alias("metric"),
                    a.cast("double").alias(left),
                    b.cast("double").alias(right),
                )
                for i, (name, a, b) in enumerate(entries, 1)
            ]
        )
    )


def alcohol_summary(summary: DataFrame) -> DataFrame:
    """Events with and without alcohol side by side.

    The median of the incident counts uses the built-in percentile: its buffer
    holds one entry per distinct count, and distinct counts grow at most with the
    square root of the number of incidents.
    """
    yes, no = F.col("has_alcohol"), ~F.col("has_alcohol")

    def both(fn, column: str) -> tuple[Column, Column]:
        return fn(F.when(yes, F.col(column))), fn(F.when(no, F.col(column)))

    def median(c: Column) -> Column:
        return F.percentile(c, 0.5)

    entries = [
        ("Event Count", *both(F.count, "event_id")),
        ("Total Incidents", *both(F.sum, "incident_count")),
        ("Avg Incidents per Event", *both(F.avg, "incident_count")),
        ("Median Incidents", *both(median, "incident_count")),
        ("Max Incidents", *both(F.max, "incident_count")),
        ("Avg Priority (lower=urgent)", *both(F.avg, "avg_priority")),
        ("Avg Distance (km)", *both(F.avg, "avg_distance_km")),
    ]
    wide = summary.agg(
        *[a.alias(f"a{i}") for i, (_, a, _) in enumerate(entries)],
        *[b.alias(f"b{i}") for i, (_, _, b) in enumerate(entries)],
    )
    named = [(name, F.col(f"a{i}"), F.col(f"b{i}")) for i, (name, _, _) in enumerate(entries)]
    table = wide.select(_rows(named, "with_alcohol", "without_alcohol"))
    gap = F.col("with_alcohol") - F.col("without_alcohol")
    share = F.bround(gap / F.nullif("without_alcohol", F.lit(0.0)) * 100, 1)
    return table.withColumns({"difference": gap, "pct_difference": share})


def alcohol_types(fact: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent categories with and without alcohol, aligned by category."""
    counts = (
        fact.na.drop(subset=["final_problem_category", "event_has_alcohol"])
        .groupBy("event_has_alcohol", "final_problem_category")
        .agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("event_has_alcohol").orderBy(F.desc("n"), "final_problem_category")
    best = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top)

    def side(flag: bool, name: str) -> DataFrame:
        return best.where(F.col("event_has_alcohol") == F.lit(flag)).select(
            F.col("final_problem_category").alias("category"), F.col("n").alias(name)
        )

    return side(True, "alcohol_count").join(side(False, "no_alcohol_count"), "category", "full")


def alcohol_priority(fact: DataFrame) -> DataFrame:
    return (
        fact.na.drop(subset=["priority_level", "event_has_alcohol"])
        .groupBy("event_has_alcohol", "priority_level")
        .agg(F.count("*").alias("incident_count"))
        .orderBy("event_has_alcohol", "priority_level")
    )


def alcohol_average_gap(summary: DataFrame) -> DataFrame:
    with_, without = (
        F.avg(F.when(F.col("has_alcohol") == F.lit(flag), F.col("incident_count")))
        for flag in (True, False)
    )
    return summary.agg((with_ - without).alias("avg_diff"))


def response_summary(flagged: DataFrame, max_seconds: float = 7200.0) -> DataFrame:
    """Response times of event-related and other calls side by side, outliers cut."""
    kept = flagged.where(F.col("response_time") < max_seconds)
    joined = distribution(
        kept, ["is_festival_related"], "response_time", {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    )
    names = ["n_values", "mean", "std", "min", "max", "p25", "p50", "p75"]
    flag = F.col("is_festival_related")
    wide = joined.agg(
        *[F.max(F.when(flag, F.col(c))).alias(f"f_{c}") for c in names],
        *[F.max(F.when(~flag, F.col(c))).alias(f"o_{c}") for c in names],
    )

    def pair(c: str, scale: float = 1.0) -> tuple[Column, Column]:
        return F.col(f"f_{c}") / scale, F.col(f"o_{c}") / scale

    entries = [
        ("Count", *pair("n_values")),
        ("Mean (sec)", *pair("mean")),
        ("Mean (min)", *pair("mean", 60.0)),
        ("Median (sec)", *pair("p50")),
        ("Median (min)", *pair("p50", 60.0)),
        ("Std Dev", *pair("std")),
        ("25th Percentile", *pair("p25")),
        ("75th Percentile", *pair("p75")),
        ("Min (sec)", *pair("min")),
        ("Max (sec)", *pair("max")),
    ]
    return wide.select(_rows(entries, "festival", "non_festival"))


def response_by_priority(flagged: DataFrame) -> DataFrame:
    """Mean, median and count of response times by flag and priority level."""
    keys = ["is_festival_related", "priority_level"]
    table = distribution(flagged, keys, "response_time", {"median_time": 0.5})
    return table.select(
        *keys, F.col("mean").alias("mean_time"), "median_time", F.col("n_values").alias("count")
    )


def response_by_hour(flagged: DataFrame) -> DataFrame:
    return (
        flagged.na.drop(subset=["response_hour"])
        .groupBy("is_festival_related", "response_hour")
        .agg(F.avg("response_time").alias("mean_response_time"))
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequencies of a column's values without NULLs, most frequent first."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value")
    )
    return counts.limit(top) if top else counts


def alcohol_by_year(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("has_alcohol") & F.col("event_year").isNotNull())
        .groupBy("event_year")
        .agg(F.count("*").alias("event_count"))
    )


def monthly_calls(calls: DataFrame) -> DataFrame:
    first = F.trunc("response_datetime", "month").alias("first")
    present = calls.where(F.col("response_datetime").isNotNull())
    months = present.groupBy(first).agg(F.count("*").alias("call_count"))
    # the label is made from the few months, not from every call
    return months.select(F.date_format("first", "yyyy-MM").alias("month"), "call_count").orderBy(
        "month"
    )


def risk_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_category").agg(F.count("*").alias("event_count"))


def one_row(spark: SparkSession, measures: dict[str, DataFrame]) -> DataFrame:
    """One row of scalar subqueries, each a one-row one-column frame."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in measures.items()])


def overview_kpis(calls: DataFrame, fact: DataFrame, risk: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """Dashboard totals. Distinct counts read their column alone, since two of them in
    one aggregate would multiply every row. A fact that counts its incidents in ``rows`` comes
    with the calls ``linked`` to an event."""

    def distinct(frame: DataFrame, column: str) -> DataFrame:
        values = frame.select(column).where(F.col(column).isNotNull()).distinct()
        return values.agg(F.count("*"))

    scored = risk.agg(
        F.count("*").alias("festivals"),
        F.count_if(F.col("risk_category") == "HIGH").alias("high"),
    )
    return one_row(
        calls.sparkSession,
        {
            "total_calls": calls.agg(F.count("*")),
            "festival_incidents": fact.agg(F.count("*") if linked is None else F.coalesce(F.sum("rows"), F.lit(0))),
            "unique_incidents": distinct(fact if linked is None else linked, "incident_number"),
            "unique_events": distinct(fact, "event_id"),
            "analyzed_festivals": scored.select("festivals"),
            "high_risk_festivals": scored.select("high"),
        },
    )


def distance_stats(fact: DataFrame) -> DataFrame:
    table = distribution(fact, [], "distance_km", {"median_km": 0.5})
    return table.select(
        F.col("min").alias("min_km"), F.col("max").alias("max_km"),
        F.col("mean").alias("mean_km"), "median_km",
    )


def forecast_metrics(forecast: DataFrame) -> DataFrame:
    residual = F.col("actual") - F.col("predicted")
    return forecast.agg(
        F.avg(F.abs(residual)).alias("mae"),
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        F.avg("actual").alias("avg_daily_calls"),
    )


def residual_histogram(forecast: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width counts of actual minus predicted; the top edge is in the last bin."""
    residuals = forecast.select((F.col("actual") - F.col("predicted")).alias("residual"))
    edges = residuals.agg(F.min("residual").alias("lo"), F.max("residual").alias("hi"))
    low, high = edges.select("lo").scalar(), edges.select("hi").scalar()
    width = (high - low) / bins
    place = F.floor((F.col("residual") - low) / F.nullif(width, F.lit(0.0)))
    binned = residuals.select(
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    return binned.groupBy("bin").agg(F.count("*").alias("days"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column and their percentage, in one pass."""
    total = F.count("*").alias("_total")
    wide = df.agg(total, *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
          for c in df.columns]
    )
    long = wide.select("_total", F.inline(cells))
    return long.select(
        "column_name",
        "null_count",
        (F.col("null_count") / F.nullif("_total", F.lit(0)) * 100).alias("null_pct"),
    )
