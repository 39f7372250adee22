"""Risk scores per event, heatmaps per place, and warehouse summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.session import materialize

PRIORITY_LEVELS = list(V.PRIORITY_RANK)


def level_column(level: str) -> str:
    """'Priority 1' -> 'count_priority_1'."""
    return "count_" + level.replace(" ", "_").lower()


def events_summary(fact: DataFrame) -> DataFrame:
    """Incidents, mean priority and mean distance per event, busiest first."""
    return (
        fact.na.drop(subset=["event_id", "event_name"])
        .groupBy("event_id", "event_name")
        .agg(
            F.count("incident_number").alias("incident_count"),
            F.avg("priority_numeric").alias("avg_priority"),
            F.avg("distance_km").alias("avg_distance_km"),
            F.bool_or("event_has_alcohol").alias("has_alcohol"),
            F.bool_or("event_has_amplified_sound").alias("has_amplified_sound"),
        )
        .orderBy(F.desc("incident_count"), "event_id")
    )


def priority_pivot(fact: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Count per event and priority level; the level list is fixed, so one pass suffices."""
    levels = levels or PRIORITY_LEVELS
    counts = [F.count_if(F.col("priority_level") == p).alias(level_column(p)) for p in levels]
    return fact.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(*counts)


def _most_frequent(category: Column, n: Column) -> Column:
    """Category with the highest count, first by name on a tie; NULLs do not compete."""
    rank = F.when(category.isNotNull(), F.struct((-n).alias("n"), category.alias("name")))
    return F.coalesce(F.min_by(category, rank), F.lit("Unknown"))


def top_incident_type(fact: DataFrame) -> DataFrame:
    counts = (
        fact.where(F.col("event_id").isNotNull())
        .groupBy("event_id", "final_problem_category")
        .agg(F.count("*").alias("n"))
    )
    top = _most_frequent(F.col("final_problem_category"), F.col("n"))
    return counts.groupBy("event_id").agg(top.alias("top_incident_type"))


def incident_measures() -> dict[str, Column]:
    """What the measures of an event are made of, over any set of its calls."""
    return {
        "rows": F.count("*"),
        "incidents": F.count("incident_number"),
        "priority_sum": F.sum("priority_numeric"),
        "priority_n": F.count("priority_numeric"),
        "priority_min": F.min("priority_numeric"),
        "response_sum": F.sum("response_time"),
        "response_n": F.count("response_time"),
        **{level_column(p): F.count_if(F.col("priority_level") == p) for p in PRIORITY_LEVELS},
    }


def festival_metrics(fact: DataFrame) -> DataFrame:
    """All per-event measures from one pass over the fact.

    The first aggregation is by event and category, the second by event. A heavy
    event reaches the second one as a handful of rows. A fact whose calls are counted already
    (``joins.festival_incident_counts`` with ``incident_measures`` by category) gives the same.
    """
    keys = ["event_id", "event_name"]
    levels = [level_column(p) for p in PRIORITY_LEVELS]
    measures = incident_measures()
    distance = {"distance_sum": F.sum("distance_km"), "distance_n": F.count("distance_km")}
    if set(measures) <= set(fact.columns):
        measures = {m: F.min(m) if m == "priority_min" else F.sum(m) for m in measures}
        known = F.when(F.col("distance_km").isNotNull(), F.col("rows"))
        distance = {"distance_sum": F.sum(F.col("distance_km") * F.col("rows")), "distance_n": F.coalesce(F.sum(known), F.lit(0))}
    partial = (
        fact.na.drop(subset=keys)
        .groupBy(*keys, "final_problem_category")
        .agg(
            *[m.alias(name) for name, m in (measures | distance).items()],
            F.bool_or("event_has_alcohol").alias("alcohol"),
            F.bool_or("event_has_amplified_sound").alias("sound"),
        )
    )

    def mean(name: str) -> Column:
        return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))

    return partial.groupBy(*keys).agg(
        F.sum("incidents").alias("incident_count"),
        mean("priority").alias("avg_priority"),
        F.min("priority_min").alias("min_priority"),
        mean("distance").alias("avg_distance"),
        mean("response").alias("avg_response_time"),
        F.coalesce(F.bool_or("alcohol"), F.lit(False)).alias("has_alcohol"),
        F.coalesce(F.bool_or("sound"), F.lit(False)).alias("has_amplified_sound"),
        *[F.sum(c).alias(c) for c in levels],
        _most_frequent(F.col("final_problem_category"), F.col("rows")).alias("top_incident_type"),
    )


def share_of(value: Column, maximum: Column) -> Column:
    """Percent of a maximum; 0 where the maximum is not positive."""
    return F.when(maximum > 0, value / maximum * 100).otherwise(F.lit(0.0))


def festival_risk(fact: DataFrame, radius_km: float = 1.5) -> DataFrame:
    """Weighted risk score and class per event, highest first.

    0.4 incidents + 0.35 priority points + 0.15 closeness, each on 0..100, and ten
    points for alcohol. The measures are written once, since the maxima need them
    before any score is known.
    """
    zero, one, two, three = (F.col(level_column(p)) for p in PRIORITY_LEVELS)
    points = zero * 4 + one * 3 + two * 2 + three
    metrics = materialize(festival_metrics(fact).withColumn("_points", points))
    top = metrics.agg(
        F.max("incident_count").alias("incidents"),
        F.max("_points").alias("points"),
        F.max(level_column(PRIORITY_LEVELS[0])).alias("urgent"),
    )
    most = top.select("incidents").scalar()
    most_points = top.select("points").scalar()
    any_urgent = top.select("urgent").scalar() > 0

    scored = metrics.withColumns(
        {
            "incident_score": share_of(F.col("incident_count"), most),
            # without a single Priority 0 call nobody gets priority points
            "priority_score": F.when(any_urgent, F.col("_points")).otherwise(F.lit(0)),
            "distance_score": V.clip((1 - F.col("avg_distance") / radius_km) * 100, 0.0, 100.0),
        }
    )
    scored = scored.withColumn(
        "priority_score_norm",
        F.when(any_urgent, share_of(F.col("priority_score"), most_points)).otherwise(F.lit(0.0)),
    )
    score = (
        F.col("incident_score") * 0.4
        + F.col("priority_score_norm") * 0.35
        + F.col("distance_score") * 0.15
        + F.col("has_alcohol").cast("int") * 10
    )
    return (
        scored.drop("_points")
        .withColumn("risk_score", score)
        .withColumn("risk_category", V.three_levels(F.col("risk_score"), 70, 40))
        .orderBy(F.desc("risk_score"), "event_id")
    )


def with_stored_priorities(linked: DataFrame, calls: DataFrame) -> DataFrame:
    """Each row of ``linked`` with the number, sum and known values of the priorities ``calls`` has for its incident.

    An incident that ``calls`` lacks counts once, without a priority, as in a left join.
    """
    stored = calls.where(F.col("incident_number").isNotNull()).groupBy("incident_number").agg(
        F.count("*").alias("stored_n"),
        F.sum("priority_numeric").alias("stored_sum"),
        F.count("priority_numeric").alias("stored_known"),
    )
    return linked.join(stored, "incident_number", "left").na.fill(1, ["stored_n"])


def summary_measures() -> dict[str, Column]:
    """Measures over ``with_stored_priorities`` that ``festival_summary`` adds up."""
    return {
        "incidents": F.sum(F.when(F.col("incident_number").isNotNull(), F.col("stored_n")).otherwise(0)),
        "priority_sum": F.sum("stored_sum"),
        "priority_n": F.sum("stored_known"),
    }


def festival_summary(events: DataFrame, fact: DataFrame, calls: DataFrame) -> DataFrame:
    """Incident count and mean priority of every event; events without incidents stay.

    The fact is reduced to one row per event before it meets the event table. It is a list of
    incidents, or counts them with ``summary_measures``, in which the priorities of calls are.
    """
    if set(summary_measures()) <= set(fact.columns):
        per_event = fact.groupBy("event_id").agg(
            F.sum("incidents").alias("incident_count"),
            (F.sum("priority_sum") / F.nullif(F.sum("priority_n"), F.lit(0))).alias("avg_priority"),
        )
    else:
        priorities = calls.select("incident_number", "priority_numeric")
        per_event = (
            fact.select("event_id", "incident_number")
            .join(priorities, "incident_number", "left")
            .groupBy("event_id")
            .agg(
                F.count("incident_number").alias("incident_count"),
                F.avg("priority_numeric").alias("avg_priority"),
            )
        )
    return (
        events.select("event_id", "event_name", "has_alcohol")
        .join(per_event, "event_id", "left")
        .na.fill(0, ["incident_count"])
    )


def risk_scores_sql(
    events: DataFrame, fact: DataFrame, calls: DataFrame, variant: int = 1
) -> DataFrame:
    """Warehouse risk scores.

    Variant 1 adds ten points for alcohol but classes by the score without them;
    variant 2 has no alcohol term and classes by the incident count.
    """
    summary = festival_summary(events, fact, calls)
    base = F.col("incident_count") * 0.5 + (4 - F.coalesce("avg_priority", F.lit(2.0))) * 10
    if variant == 1:
        bonus = F.when(F.col("has_alcohol"), 10.0).otherwise(0.0)
        score, category = base + bonus, V.three_levels(base, 50, 25, strict=True)
    else:
        score = base
        category = V.three_levels(F.col("incident_count"), 50, 20, strict=True)
    return summary.select(
        "event_id", "event_name", "incident_count", "avg_priority",
        score.alias("risk_score"), category.alias("risk_category"), "has_alcohol",
    )


def zone_heatmap(
    calls: DataFrame,
    high: int = 50,
    medium: int = 20,
    labels: tuple[str, str, str] = ("HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"),
) -> DataFrame:
    """Incident count and class per place, over all time."""
    counts = (
        calls.where(F.col("latitude_centroid").isNotNull())
        .groupBy(
            F.col("latitude_centroid").alias("latitude"),
            F.col("longitude_centroid").alias("longitude"),
        )
        .agg(F.count("*").alias("incident_count"))
    )
    zone = V.three_levels(F.col("incident_count"), high, medium, labels, strict=True)
    return counts.withColumn("risk_zone", zone)


def risk_heatmap(
    calls: DataFrame, days: int = 30, high: int = 100, medium: int = 50, as_of=None
) -> DataFrame:
    """Places by incidents in the days before ``as_of`` (default: day of the last call).

    Calls without a place form their own group, as in the warehouse view.
    """
    when = F.col("response_datetime")
    last = calls.agg(F.max(F.to_date(when))).scalar() if as_of is None else F.lit(as_of)
    start = F.date_sub(last.cast("date"), days).cast("timestamp_ntz")
    counts = (
        calls.where(when >= start)
        .groupBy(
            F.col("latitude_centroid").alias("lat"), F.col("longitude_centroid").alias("lon")
        )
        .agg(
            F.count("*").alias("incident_count"),
            F.avg("priority_numeric").alias("avg_priority"),
        )
    )
    level = V.three_levels(F.col("incident_count"), high, medium, strict=True)
    return counts.withColumn("risk_level", level)


def location_features(calls: DataFrame, with_response: bool = True) -> DataFrame:
    """Per place: counts, means, log count and a combined location risk."""
    located = calls.na.drop(subset=["latitude_centroid", "longitude_centroid"])
    grouped = located.groupBy(
        F.col("latitude_centroid").alias("latitude"),
        F.col("longitude_centroid").alias("longitude"),
    ).agg(
        F.count("incident_number").alias("incident_count"),
        F.avg("priority_numeric").alias("avg_priority"),
        F.avg("response_time").alias("avg_response_time"),
        F.avg("response_hour").alias("avg_hour"),
    )
    risk = F.log1p("incident_count") * 0.5 + (4 - F.col("avg_priority")) * 0.3
    if with_response:
        risk = risk + F.col("avg_response_time") / 600 * 0.2
    featured = grouped.withColumns(
        {"log_incidents": F.log1p("incident_count"), "location_risk": risk}
    )
    return featured if with_response else featured.drop("avg_response_time", "avg_hour")


def filter_risk(
    risk: DataFrame, categories: list[str], alcohol: bool | None = None
) -> DataFrame:
    """Dashboard filter: listed classes, and with, without or regardless of alcohol."""
    kept = risk.where(F.col("risk_category").isin(categories))
    return kept if alcohol is None else kept.where(F.col("has_alcohol") == F.lit(alcohol))


def top_rows(df: DataFrame, measure: str, n: int, tiebreak: str) -> DataFrame:
    """Largest ``n`` rows by a measure; a report with a bounded size."""
    return df.orderBy(F.desc(measure), tiebreak).limit(n)


def rank_desc(df: DataFrame, measure: str, tiebreak: str) -> DataFrame:
    """Rank rows of a small table by a measure, 1 = highest."""
    order = Window.orderBy(F.desc(measure), tiebreak)
    return df.withColumn("rank", F.row_number().over(order))
