"""Cleaning of calls, events, block groups, venues and weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pulsewatch import schemas
from pulsewatch.functions import values as V


def keep_first(df: DataFrame, key: str | list[str], order_by: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order_by``.

    The rank-one filter is applied before the shuffle as well (window group
    limit), so a key with very many copies sends one row per input partition.
    """
    keys = [key] if isinstance(key, str) else key
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def clean_calls(
    raw: DataFrame, dedupe: bool = True, tiebreak: list[Column | str] | None = None
) -> DataFrame:
    """Typed, filled and dated calls; columns the source lacks are left out."""
    df = schemas.normalize_names(raw)
    present = set(df.columns)
    updates: dict[str, Column] = {}
    if "geo_id" in present:
        updates["geo_id"] = V.format_geo_id(F.col("geo_id"))
    for name in ("response_datetime", "first_unit_arrived_datetime", "call_closed_datetime"):
        if name in present:
            updates[name] = V.lenient_timestamp(F.col(name))
    if "priority_level" in present:
        updates["priority_numeric"] = V.priority_numeric(F.col("priority_level"))
    df = df.withColumns(updates)

    if "response_datetime" in present:
        when = F.col("response_datetime")
        dated = {
            "response_date": F.to_date(when),
            "response_month": F.substring(F.to_date(when).cast("string"), 1, 7),
            "response_year": F.year(when),
        }
        if "response_hour" not in present:
            dated["response_hour"] = F.hour(when)
        if "response_day_of_week" not in present:
            dated["response_day_of_week"] = F.dayname(when)
        df = df.withColumns(dated)

    df = df.na.fill("Unknown", [c for c in schemas.UNKNOWN_FILLED if c in df.columns])
    if dedupe:
        order = tiebreak or [F.col("response_datetime").asc_nulls_last()]
        df = keep_first(df, "incident_number", order)
    return schemas.select_existing(df, schemas.CLEAN_CALL_COLUMNS)


def event_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_alcohol": V.to_flag(F.col("alcohol_served")),
            "has_amplified_sound": V.to_flag(F.col("amplified_sound")),
            "has_road_closure": V.is_filled(F.col("road_closure")),
        }
    )


def event_coordinates(
    df: DataFrame,
    lat_range: tuple[float, float] = (29.0, 32.0),
    lon_range: tuple[float, float] = (-99.0, -96.0),
    only_valid: bool = False,
) -> DataFrame:
    """Numeric coordinates plus a flag for the expected area; filtering is optional."""
    df = df.withColumns(
        {
            "event_lat": V.lenient_number(F.col("gpslatitude")),
            "event_lon": V.lenient_number(F.col("gpslongitude")),
        }
    )
    inside = F.col("event_lat").between(*lat_range) & F.col("event_lon").between(*lon_range)
    df = df.withColumn("in_area", F.coalesce(inside, F.lit(False)))
    return df.where("in_area") if only_valid else df


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed events with flags, coordinates and length in days."""
    df = schemas.apply_aliases(schemas.normalize_names(raw), schemas.EVENT_ALIASES)
    df = schemas.with_missing(
        df, schemas.struct("alcohol_served string, amplified_sound string, road_closure string, "
                           "gpslatitude string, gpslongitude string")
    )
    df = df.withColumns(
        {
            "start_date": V.permit_date(F.col("start_date")),
            "end_date": V.permit_date(F.col("end_date")),
            "event_name": F.trim("event_name"),
        }
    )
    df = event_coordinates(event_flags(df)).withColumns(
        {
            "event_length_days": F.datediff("end_date", "start_date") + 1,
            "event_year": F.year("start_date"),
            "event_month": F.month("start_date"),
        }
    )
    return schemas.select_existing(df, schemas.CLEAN_EVENT_COLUMNS)


def build_dim_geo(attributes: DataFrame, county: str = "453") -> DataFrame:
    """Block groups of one county with centroid and land area in square kilometres."""
    df = schemas.normalize_names(attributes)
    return df.where(F.col("countyfp") == county).select(
        V.format_geo_id(F.col("geoid")).alias("geo_id"),
        V.lenient_number(F.col("intptlat")).alias("latitude_centroid"),
        V.lenient_number(F.col("intptlon")).alias("longitude_centroid"),
        (F.col("aland") / F.lit(1e6)).alias("area_sq_km"),
    )


def build_dim_venue(raw: DataFrame) -> DataFrame:
    """Venues with coordinates, defaults for missing text and a primary category."""
    df = raw.withColumnsRenamed(
        {"id": "venue_id", "categories": "category", "point_of_interest": "poi_id"}
    )
    df = df.na.fill({"address": "", "city": "", "state": "", "category": "Unknown"})
    df = df.na.drop(subset=["latitude", "longitude"])
    primary = V.text_or_null(F.split("category", ",")[0])
    df = df.withColumn("primary_category", F.coalesce(primary, F.lit("Unknown")))
    return keep_first(df, "venue_id", ["name", "latitude", "longitude"])


def build_dim_weather(raw: DataFrame) -> DataFrame:
    """Hourly weather with calendar parts and classes."""
    when = F.col("datetime")
    df = raw.withColumns(
        {
            "date": F.to_date(when),
            "hour": F.hour(when),
            "day_of_week": F.date_format(when, "EEEE"),
            "month": F.month(when),
            "year": F.year(when),
            "temperature_f": V.fahrenheit(F.col("temperature_c")),
            "weather_category": V.weather_category(F.col("weather_code")),
            "is_raining": V.is_raining(F.col("precipitation_mm")),
        }
    )
    return df.withColumn("temp_category", V.temperature_category(F.col("temperature_f")))


def weather_daily(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("date").agg(
        F.min("temperature_f").alias("temp_min_f"),
        F.max("temperature_f").alias("temp_max_f"),
        F.avg("temperature_f").alias("temp_avg_f"),
        F.sum("precipitation_mm").alias("precipitation_total_mm"),
        F.avg("humidity_pct").alias("humidity_avg_pct"),
        F.max("wind_speed_kmh").alias("wind_max_kmh"),
        F.bool_or("is_raining").alias("had_rain"),
    )
