"""Declared schemas, header aliases and output column lists of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def struct(spec: str) -> T.StructType:
    """StructType from a DDL string, parsed without a running session."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

# Raw inputs are landed as text so that bad values can be told from missing ones.
RAW_CALLS = struct(
    "incident_number string, incident_type string, mental_health_flag string, "
    "priority_level string, response_datetime string, response_day_of_week string, "
    "response_hour int, response_time double, first_unit_arrived_datetime string, "
    "call_closed_datetime string, sector string, geo_id string, census_block_group string, "
    "council_district string, initial_problem_description string, "
    "initial_problem_category string, final_problem_description string, "
    "final_problem_category string, number_of_units_arrived int, unit_time_on_scene double, "
    "call_disposition_description string, report_written_flag string, "
    "officer_injured_killed_count int, subject_injured_killed_count int, "
    "other_injured_killed_count int"
)

RAW_EVENTS = struct(
    "folderrsn long, foldername string, foldertype string, status string, tier_type string, "
    "start_date string, end_date string, event_length string, gpslatitude string, "
    "gpslongitude string, alcohol_served string, amplified_sound string, road_closure string, "
    "type_of_road_closure string, event_applicant_organization string"
)

RAW_BLOCK_GROUPS = struct(
    "geoid string, countyfp string, intptlat string, intptlon string, aland long"
)

RAW_VENUES = struct(
    "id string, name string, latitude double, longitude double, address string, city string, "
    "state string, country string, categories string, point_of_interest string"
)

DIM_GEO = struct(
    "geo_id string, latitude_centroid double, longitude_centroid double, area_sq_km double"
)

FACT_CALLS = struct(
    "incident_number string, response_datetime timestamp, response_date date, "
    "response_hour int, response_day_of_week string, priority_level string, "
    "priority_numeric int, initial_problem_category string, final_problem_category string, "
    "geo_id string, latitude_centroid double, longitude_centroid double"
)

PIPELINE_RUNS = struct("run_date timestamp, dag_id string, status string, records_processed long")

WEATHER_JSON = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                    T.StructField("relative_humidity_2m", T.ArrayType(T.DoubleType())),
                    T.StructField("precipitation", T.ArrayType(T.DoubleType())),
                    T.StructField("rain", T.ArrayType(T.DoubleType())),
                    T.StructField("weather_code", T.ArrayType(T.IntegerType())),
                    T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
                    T.StructField("wind_gusts_10m", T.ArrayType(T.DoubleType())),
                ]
            ),
        )
    ]
)

_MATCH = T.StructType(
    [
        T.StructField("match_id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("team1", T.StringType()),
        T.StructField("team2", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("scorers", T.ArrayType(T.StringType())),
        T.StructField("stadium", T.StringType()),
        T.StructField("attendance", T.LongType()),
    ]
)

_STANDING = struct(
    "team string, played int, won int, drawn int, lost int, gf int, ga int, gd int, points int"
)

RESULTS_JSON = T.StructType(
    [
        T.StructField("last_updated", T.StringType()),
        T.StructField("tournament", T.StringType()),
        T.StructField("matches", T.ArrayType(_MATCH)),
        T.StructField("standings", T.MapType(T.StringType(), T.ArrayType(_STANDING))),
    ]
)

# Columns kept after cleaning, in output order.
CLEAN_CALL_COLUMNS = [
    "incident_number", "incident_type", "priority_level", "priority_numeric",
    "response_datetime", "response_date", "response_month", "response_year",
    "response_day_of_week", "response_hour", "response_time",
    "first_unit_arrived_datetime", "call_closed_datetime",
    "sector", "geo_id", "census_block_group", "council_district",
    "initial_problem_description", "initial_problem_category",
    "final_problem_description", "final_problem_category",
    "number_of_units_arrived", "unit_time_on_scene",
    "mental_health_flag", "call_disposition_description", "report_written_flag",
    "officer_injured_killed_count", "subject_injured_killed_count",
    "other_injured_killed_count",
]

# Call columns where a missing entry reads 'Unknown'.
UNKNOWN_FILLED = [
    "incident_type", "mental_health_flag", "sector",
    "initial_problem_description", "initial_problem_category",
    "final_problem_description", "final_problem_category",
    "call_disposition_description",
]

# Event columns kept after cleaning, in output order.
CLEAN_EVENT_COLUMNS = [
    "event_id", "event_name", "event_type", "status", "tier_type",
    "start_date", "end_date", "event_length", "event_length_days",
    "event_year", "event_month", "event_lat", "event_lon",
    "has_alcohol", "has_amplified_sound", "has_road_closure",
    "organizer", "road_closure", "type_of_road_closure",
]

# Headers of the two event exports and the name each one gets.
EVENT_ALIASES = {
    "folderrsn": "event_id",
    "foldername": "event_name",
    "event_name": "event_name",
    "foldertype": "event_type",
    "event_applicant_organization": "organizer",
    "event_start_date": "start_date",
    "event_end_date": "end_date",
    "alcohol": "alcohol_served",
}

# Columns of the fact of event-linked incidents, in output order.
FESTIVAL_FACT_COLUMNS = [
    "incident_number", "event_id", "event_name", "distance_km",
    "response_datetime", "priority_level", "priority_numeric",
    "latitude_centroid", "longitude_centroid", "geo_id",
    "event_start_date", "event_end_date",
    "event_has_alcohol", "event_has_amplified_sound",
    "final_problem_category", "response_time",
]


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip and lower headers; spaces and slashes become underscores."""
    names = [c.strip().lower().replace(" ", "_").replace("/", "_") for c in df.columns]
    return df.toDF(*names)


def apply_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Rename the listed headers that exist and whose target is still free."""
    present = set(df.columns)
    wanted = {
        old: new
        for old, new in aliases.items()
        if old in present and old != new and new not in present
    }
    return df.withColumnsRenamed(wanted) if wanted else df


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wish-list projection: keep the listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def with_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent columns of ``schema`` as typed NULLs."""
    present = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in present}
    return df.withColumns(missing) if missing else df
