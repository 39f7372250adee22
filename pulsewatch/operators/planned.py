"""Scoring of planned events: expected incidents, risk, staffing and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.operators.reports import rule_alerts

# Event zones with risk class and centre.
ZONES = {
    "Downtown/6th Street (HIGH RISK)": ("HIGH", 30.27, -97.74),
    "East Austin (MEDIUM RISK)": ("MEDIUM", 30.26, -97.71),
    "North Austin (LOW RISK)": ("LOW", 30.35, -97.75),
    "South Austin (MEDIUM RISK)": ("MEDIUM", 30.22, -97.77),
    "University Area (MEDIUM RISK)": ("MEDIUM", 30.28, -97.73),
    "Autre": ("LOW", 30.30, -97.75),
}
DEFAULT_ZONE = ("LOW", 30.30, -97.75)

# Incident factor by forecast weather.
WEATHER_FACTORS = {
    "Clear (Clair)": 1.2,
    "Partly Cloudy": 1.0,
    "Cloudy": 0.9,
    "Rain": 0.7,
    "Thunderstorm": 0.5,
}

# Percentages of priorities 0..3 by (alcohol, weekend).
PRIORITY_MIX = {
    "alcohol_weekend": {"Priority 0": 5, "Priority 1": 25, "Priority 2": 45, "Priority 3": 25},
    "alcohol": {"Priority 0": 3, "Priority 1": 20, "Priority 2": 50, "Priority 3": 27},
    "none": {"Priority 0": 2, "Priority 1": 15, "Priority 2": 48, "Priority 3": 35},
}

# Percentages of incident types with and without alcohol.
INCIDENT_MIX = {
    "alcohol": {
        "Intoxication/Ivresse": 35,
        "Troubles/Disturbances": 25,
        "Assistance Médicale": 20,
        "Agressions": 12,
        "Autres": 8,
    },
    "none": {
        "Assistance Médicale": 30,
        "Troubles/Disturbances": 25,
        "Malaises (Chaleur)": 20,
        "Objets Perdus/Trouvés": 15,
        "Autres": 10,
    },
}

# Alert titles, levels and the recommendations that go with them.
ALERT_TEXTS = {
    "alcohol": (
        "🍺 ALCOOL", "warning",
        ["✅ Déployer des équipes anti-intoxication dédiées",
         "✅ Installer des points d'eau et zones de repos"],
    ),
    "zone": (
        "📍 ZONE HIGH-RISK", "error",
        ["✅ Présence policière renforcée dès l'ouverture",
         "✅ Plan d'évacuation testé et communiqué"],
    ),
    "heat": (
        "🌡️ CANICULE", "warning",
        ["✅ Doubler les équipes médicales pour insolation",
         "✅ Points de brumisation et distribution d'eau"],
    ),
    "night": (
        "🌙 WEEKEND SOIR", "info",
        ["✅ Équipes de nuit complètes (pas de roulement pendant pic)"],
    ),
    "weather": (
        "⛈️ MÉTÉO", "warning",
        ["✅ Préparer zones abritées et annonces évacuation"],
    ),
    "crowd": (
        "👥 GRANDE AFFLUENCE", "info",
        ["✅ Points d'accès multiples pour éviter engorgement"],
    ),
}


def lookup(key: Column, table: dict, default) -> Column:
    """Value of a small fixed table, ``default`` for other keys and NULL."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def percent_rows(mix: Column, key: str, label: str) -> list[Column]:
    return [F.col(key), F.explode(mix).alias(label, "percentage")]


def int_map(table: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for item in table.items() for x in item])


def share(value: Column, ratio: float, at_least: int = 0) -> Column:
    """Whole part of ``value * ratio``, but no less than ``at_least``."""
    return F.greatest(F.lit(at_least).cast("long"), F.floor(value * F.lit(ratio)).cast("long"))


def planned_features(events: DataFrame) -> DataFrame:
    """Start hour, weekend, zone class with centre and weather factor of each event."""
    zone = {name: z[0] for name, z in ZONES.items()}
    lat = {name: z[1] for name, z in ZONES.items()}
    lon = {name: z[2] for name, z in ZONES.items()}
    place = F.col("location")
    return events.withColumns(
        {
            "start_hour": F.split("start_time", ":")[0].cast("int"),
            "is_weekend": F.weekday("event_date") >= 5,
            "zone_category": lookup(place, zone, DEFAULT_ZONE[0]),
            "zone_lat": lookup(place, lat, DEFAULT_ZONE[1]),
            "zone_lon": lookup(place, lon, DEFAULT_ZONE[2]),
            "weather_factor": lookup(F.col("weather_condition"), WEATHER_FACTORS, 1.0),
        }
    )


def score_planned_events(events: DataFrame) -> DataFrame:
    """Expected incidents, risk score and class of each planned event."""
    df = planned_features(events)
    hour, zone = F.col("start_hour"), F.col("zone_category")
    factors = [
        F.when(F.col("has_alcohol"), 1.315),
        F.when(F.col("is_weekend"), 1.15),
        F.when((hour >= 20) | (hour <= 4), 1.25),
        F.when(zone == "HIGH", 1.4).when(zone == "MEDIUM", 1.15),
    ]
    expected = F.col("expected_attendance") * F.lit(0.002)
    for factor in factors:
        expected = expected * F.coalesce(factor, F.lit(1.0))
    expected = expected * F.col("weather_factor")
    df = df.withColumn("predicted_incidents", F.floor(expected).cast("long"))

    def points(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    score = (
        F.col("predicted_incidents") / 50 * 0.4
        + points(F.col("has_alcohol"), 20)
        + F.when(zone == "HIGH", 20).when(zone == "MEDIUM", 10).otherwise(0)
        + points(F.col("is_weekend"), 10)
        + points(hour >= 20, 10)
    )
    return df.withColumn("risk_score", F.least(F.lit(100.0), score)).withColumn(
        "risk_category", V.three_levels(F.col("risk_score"), 60, 30)
    )


def planned_priority_mix(scored: DataFrame, key: str = "event_id") -> DataFrame:
    mix = (
        F.when(F.col("has_alcohol") & F.col("is_weekend"), int_map(PRIORITY_MIX["alcohol_weekend"]))
        .when(F.col("has_alcohol"), int_map(PRIORITY_MIX["alcohol"]))
        .otherwise(int_map(PRIORITY_MIX["none"]))
    )
    return scored.select(*percent_rows(mix, key, "priority_level"))


def planned_incident_mix(scored: DataFrame, key: str = "event_id") -> DataFrame:
    mix = F.when(F.col("has_alcohol"), int_map(INCIDENT_MIX["alcohol"])).otherwise(
        int_map(INCIDENT_MIX["none"])
    )
    return scored.select(*percent_rows(mix, key, "incident_type"))


def planned_staffing(scored: DataFrame) -> DataFrame:
    """Medical, security and equipment numbers with their minimums."""
    incidents, people = F.col("predicted_incidents"), F.col("expected_attendance")
    staffed = scored.withColumns(
        {
            "medical_staff": share(incidents, 0.3, 2),
            "security_staff": share(incidents, 0.5, 4),
        }
    )
    medical, security = F.col("medical_staff"), F.col("security_staff")
    return staffed.withColumns(
        {
            "doctors": share(medical, 0.3, 1),
            "nurses": share(medical, 0.5, 2),
            "first_aiders": share(medical, 0.2, 2),
            "police": share(security, 0.3, 2),
            "fixed_posts": F.greatest(F.lit(2), F.floor(people / 3000)).cast("long"),
            "ambulances": share(incidents, 0.1, 1),
            "first_aid_points": F.greatest(F.lit(1), F.floor(people / 5000)).cast("long"),
            "radios": medical + security,
        }
    )


def alert(texts: dict, name: str, message: Column | str) -> dict[str, Column | str]:
    title, level, advice = texts[name]
    return {
        "alert": title,
        "level": level,
        "message": message,
        "recommendations": F.array(*[F.lit(a) for a in advice]),
    }


def planned_alerts(scored: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event and alert that applies, with recommendations."""
    people, heat = F.col("expected_attendance"), F.col("temperature")
    sky = F.col("weather_condition")
    rules = [
        (F.col("has_alcohol"), "alcohol", "Événement avec alcool - Risque +31.5% incidents"),
        (
            F.col("zone_category") == "HIGH",
            "zone",
            "Localisation Downtown - Zone historiquement à haut risque",
        ),
        (
            heat > 90,
            "heat",
            F.format_string("Température élevée (%d°F) - Risque de malaises", heat.cast("int")),
        ),
        (
            F.col("is_weekend") & (F.col("start_hour") >= 20),
            "night",
            "Horaire à risque élevé (weekend + soirée)",
        ),
        (
            sky.isin("Thunderstorm", "Rain"),
            "weather",
            F.concat(F.lit("Prévision: "), sky, F.lit(" - Plan intempéries")),
        ),
        (
            people > 20000,
            "crowd",
            F.concat(F.format_number(people, 0), F.lit(" personnes attendues")),
        ),
    ]
    built = [
        (condition, {key: F.col(key), **alert(ALERT_TEXTS, name, message)})
        for condition, name, message in rules
    ]
    return rule_alerts(scored, built)
