import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsewatch import schemas
from pulsewatch.functions import values as V
from pulsewatch.operators import clean, sampling


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, fn, values, kind="string"):
    out = column(spark, values, kind).select("i", fn(F.col("v")).alias("o"))
    return [r["o"] for r in out.orderBy("i").collect()]


def test_geo_id_is_stripped_then_padded(spark):
    got = apply(
        spark,
        V.format_geo_id,
        ["48453001012.0", "484530010121", "484530010121.0", None, " 7 ", "4845300.05", "1234567890123"],
    )
    assert got == [
        "048453001012", "484530010121", "484530010121", None, "000000000007", "004845300.05",
        "1234567890123",
    ]


def test_permit_dates_try_named_month_then_other_forms(spark):
    got = apply(
        spark, V.permit_date, ["Aug 02, 2019", "2019-08-03", "08/04/2019", "soon", "", None]
    )
    assert got == [dt.date(2019, 8, 2), dt.date(2019, 8, 3), dt.date(2019, 8, 4), None, None, None]


def test_lenient_parsers_give_null(spark):
    assert apply(spark, V.lenient_number, ["1.5", " 2 ", "n/a", None]) == [1.5, 2.0, None, None]
    got = apply(spark, V.lenient_timestamp, ["2024-01-02 03:04:05", "bad", None])
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_flags(spark):
    got = apply(spark, V.to_flag, ["Yes", " y ", "TRUE", "1", "no", "", None, "oui"])
    assert got == [True, True, True, True, False, False, False, False]
    assert apply(spark, V.is_filled, ["Full", " ", "", None]) == [True, False, False, False]


def test_priority_maps(spark):
    levels = ["Priority 0", "Priority 3", "Priority 7", None]
    assert apply(spark, V.priority_numeric, levels) == [0, 3, 9, 9]
    assert apply(spark, V.priority_class, levels) == [0, 3, None, None]


@pytest.mark.parametrize(
    ("code", "label"),
    [(0, "Clear"), (3, "Partly Cloudy"), (48, "Fog"), (57, "Drizzle"), (67, "Rain"), (77, "Snow"),
     (82, "Rain Showers"), (86, "Snow Showers"), (99, "Thunderstorm"), (4, "Other"),
     (None, "Unknown")],
)
def test_weather_classes(spark, code, label):
    assert apply(spark, V.weather_category, [code], "int") == [label]


def test_temperature_classes_and_rain(spark):
    got = apply(spark, V.temperature_category, [31.9, 32.0, 50.0, 70.0, 85.0, None], "double")
    assert got == ["Freezing", "Cold", "Mild", "Warm", "Hot", "Unknown"]
    assert apply(spark, V.is_raining, [0.1, 0.2, None], "double") == [False, True, False]


def test_day_parts_differ_at_their_edges(spark):
    hours = [0, 5, 6, 12, 18, 23, None]
    assert apply(spark, V.part_of_day, hours, "int") == [
        "Night", "Night", "Morning", "Afternoon", "Evening", "Evening", None,
    ]
    assert apply(spark, V.time_slot, hours, "int") == [
        None, "Night", "Night", "Morning", "Afternoon", "Evening", None,
    ]


def test_header_normalisation_and_aliases(spark):
    df = spark.createDataFrame([(1, "x", "Yes")], ["Event ID/No", " Event Name ", "Alcohol"])
    names = schemas.normalize_names(df).columns
    assert names == ["event_id_no", "event_name", "alcohol"]
    aliased = schemas.apply_aliases(schemas.normalize_names(df), schemas.EVENT_ALIASES)
    assert aliased.columns == ["event_id_no", "event_name", "alcohol_served"]
    assert schemas.select_existing(aliased, ["alcohol_served", "zzz"]).columns == ["alcohol_served"]


def test_clean_calls_fills_dates_and_dedupes(spark):
    raw = spark.createDataFrame(
        [
            ("a", "Priority 1", "2024-03-04 23:59:00", "48453001012.0", None),
            ("a", "Priority 1", "2024-03-03 00:00:00", "48453001012.0", "Theft"),
            ("b", None, "never", None, "Noise"),
        ],
        "`Incident Number` string, `Priority Level` string, `Response Datetime` string, "
        "`Geo ID` string, `Final Problem Category` string",
    )
    got = {r["incident_number"]: r for r in clean.clean_calls(raw).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert a["response_date"] == dt.date(2024, 3, 3)
    assert (a["response_month"], a["response_year"], a["response_hour"]) == ("2024-03", 2024, 0)
    assert a["response_day_of_week"] == "Sun"
    assert a["final_problem_category"] == "Theft"
    assert (b["priority_numeric"], b["response_date"], b["geo_id"]) == (9, None, None)
    assert clean.clean_calls(raw, dedupe=False).count() == 3


def test_clean_events_and_area_filter(spark):
    raw = spark.createDataFrame(
        [
            (1, " Fair ", "Aug 02, 2019", "Aug 02, 2019", "30.2", "-97.7", "Yes", None, "Full"),
            (2, "Run", "soon", "Aug 03, 2019", "0", "x", None, "y", " "),
        ],
        "FOLDERRSN long, FOLDERNAME string, START_DATE string, END_DATE string, "
        "GPSLATITUDE string, GPSLONGITUDE string, ALCOHOL_SERVED string, "
        "AMPLIFIED_SOUND string, ROAD_CLOSURE string",
    )
    one, two = clean.clean_events(raw).orderBy("event_id").collect()
    assert one["event_name"] == "Fair"
    assert one["event_length_days"] == 1
    assert (one["has_alcohol"], one["has_amplified_sound"], one["has_road_closure"]) == (
        True, False, True,
    )
    assert two["start_date"] is None
    assert two["event_length_days"] is None
    assert (two["event_lat"], two["event_lon"], two["has_road_closure"]) == (0.0, None, False)
    placed = clean.event_coordinates(schemas.normalize_names(raw), only_valid=True)
    assert [r["folderrsn"] for r in placed.collect()] == [1]


def test_events_from_the_other_export(spark):
    raw = spark.createDataFrame(
        [("Fair", "2024-05-01", "2024-05-02", "yes", "no")],
        ["Event Name", "Event Start Date", "Event End Date", "Alcohol", "Amplified Sound"],
    )
    row = clean.clean_events(raw).first()
    assert (row["event_name"], row["event_length_days"], row["has_alcohol"]) == ("Fair", 2, True)


def test_venues(spark):
    raw = spark.createDataFrame(
        [
            ("1", "B", 30.0, -97.0, None, None, None, "US", "Bar, Pub", "p"),
            ("1", "A", 30.0, -97.0, "x", "y", "z", "US", None, "p"),
            ("2", "C", None, -97.0, None, None, None, "US", " ", "p"),
            ("3", "D", 30.0, -97.0, None, None, None, "US", ",x", "p"),
        ],
        schemas.RAW_VENUES,
    )
    got = {r["venue_id"]: r for r in clean.build_dim_venue(raw).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"]["name"], got["1"]["category"]) == ("A", "Unknown")
    assert got["3"]["primary_category"] == "Unknown"
    assert got["3"]["address"] == ""


def test_sample_is_repeatable_and_whole_when_small(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    one = {r["k"] for r in sampling.sample_rows(df, 10, "k").collect()}
    two = {r["k"] for r in sampling.sample_rows(df.repartition(7), 10, "k").collect()}
    assert one == two and len(one) == 10
    assert sampling.sample_rows(df, 500, "k").count() == 100
