"""Parsing, categories and calendar features as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Call priority labels and their rank; any other label ranks 9.
PRIORITY_RANK = {"Priority 0": 0, "Priority 1": 1, "Priority 2": 2, "Priority 3": 3}
UNKNOWN_PRIORITY = 9

# WMO weather codes by class.
WEATHER_CLASSES = {
    "Clear": [0],
    "Partly Cloudy": [1, 2, 3],
    "Fog": [45, 48],
    "Drizzle": [51, 53, 55, 56, 57],
    "Rain": [61, 63, 65, 66, 67],
    "Snow": [71, 73, 75, 77],
    "Rain Showers": [80, 81, 82],
    "Snow Showers": [85, 86],
    "Thunderstorm": [95, 96, 99],
}

# Upper limits of the temperature classes in Fahrenheit.
TEMPERATURE_CLASSES = [(32, "Freezing"), (50, "Cold"), (70, "Mild"), (85, "Warm")]

TRUE_WORDS = ["yes", "y", "true", "1"]


def text_or_null(c: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def format_geo_id(c: Column) -> Column:
    """Twelve-digit block-group id: drop a trailing '.0', then pad; NULL stays NULL."""
    digits = F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "")
    return F.when(F.length(digits) >= 12, digits).otherwise(F.lpad(digits, 12, "0"))


def lenient_timestamp(c: Column) -> Column:
    """Timestamp without zone; what cannot be read becomes NULL."""
    text = c.cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        F.try_to_timestamp(text, F.lit("MM/dd/yyyy HH:mm:ss")).cast("timestamp_ntz"),
        F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).cast("timestamp_ntz"),
    )


def permit_date(c: Column) -> Column:
    """Dates such as 'Aug 02, 2019' first, then the lenient forms, else NULL."""
    named = F.try_to_timestamp(c.cast("string"), F.lit("MMM d, yyyy")).cast("timestamp_ntz")
    return F.coalesce(named, lenient_timestamp(c)).cast("date")


def lenient_number(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def to_flag(c: Column) -> Column:
    """Yes-like words are true; anything else, NULL included, is false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(TRUE_WORDS), F.lit(False))


def is_filled(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def _from_dict(c: Column, values: dict) -> Column:
    expr = None
    for key, value in values.items():
        expr = F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value))
    return expr


def priority_class(level: Column) -> Column:
    """0..3 for a known label, NULL otherwise."""
    return _from_dict(level, PRIORITY_RANK)


def priority_numeric(level: Column) -> Column:
    """0..3 for a known label, 9 otherwise."""
    return F.coalesce(priority_class(level), F.lit(UNKNOWN_PRIORITY))


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def weather_category(code: Column) -> Column:
    whole = code.cast("int")
    expr = F.when(whole.isNull(), "Unknown")
    for label, codes in WEATHER_CLASSES.items():
        expr = expr.when(whole.isin(codes), label)
    return expr.otherwise("Other")


def temperature_category(temp_f: Column) -> Column:
    expr = F.when(temp_f.isNull(), "Unknown")
    for limit, label in TEMPERATURE_CLASSES:
        expr = expr.when(temp_f < limit, label)
    return expr.otherwise("Hot")


def is_raining(precipitation: Column) -> Column:
    return F.coalesce(precipitation > 0.1, F.lit(False))


def three_levels(
    score: Column,
    high: float,
    medium: float,
    labels: tuple[str, str, str] = ("HIGH", "MEDIUM", "LOW"),
    strict: bool = False,
) -> Column:
    """Class by two thresholds; ``strict`` means the threshold itself does not count."""
    top = score > high if strict else score >= high
    mid = score > medium if strict else score >= medium
    return F.when(top, labels[0]).when(mid, labels[1]).otherwise(labels[2])


def part_of_day(hour: Column) -> Column:
    """Left-closed six-hour parts; NULL hour gives NULL."""
    return (
        F.when(hour < 6, "Night")
        .when(hour < 12, "Morning")
        .when(hour < 18, "Afternoon")
        .when(hour.isNotNull(), "Evening")
    )


def time_slot(hour: Column) -> Column:
    """Right-closed six-hour parts of (0, 24]; hour 0 falls outside and gives NULL."""
    return (
        F.when(hour <= 0, None)
        .when(hour <= 6, "Night")
        .when(hour <= 12, "Morning")
        .when(hour <= 18, "Afternoon")
        .when(hour <= 24, "Evening")
    )


def cycle_sin(c: Column, period: int) -> Column:
    return F.sin(c * F.lit(2 * math.pi) / F.lit(float(period)))


def cycle_cos(c: Column, period: int) -> Column:
    return F.cos(c * F.lit(2 * math.pi) / F.lit(float(period)))


def day_number(short_name: Column) -> Column:
    """Mon = 0 … Sun = 6 from a three-letter name."""
    names = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    return _from_dict(short_name, {name: i for i, name in enumerate(names)})


def first_word(c: Column) -> Column:
    return F.split(F.trim(c), r"\s+")[0]


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def significance(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
