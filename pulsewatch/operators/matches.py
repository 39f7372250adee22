"""Tournament matches: risk scoring, staffing, alerts, schedule and standings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.operators.planned import alert, int_map, lookup, percent_rows, share
from pulsewatch.operators.reports import rule_alerts

# Stadium name -> city, capacity, latitude, longitude, base risk.
STADIUMS = {
    "Grand Stade de Tanger": ("Tangier", 75000, 35.7595, -5.8340, 0.8),
    "Prince Moulay Abdellah Stadium": ("Rabat", 68700, 34.0209, -6.8416, 0.9),
    "Stade Mohammed V": ("Casablanca", 45000, 33.5731, -7.6180, 0.85),
    "Grand Stade de Marrakech": ("Marrakech", 45240, 31.6295, -8.0087, 0.7),
    "Stade Adrar": ("Agadir", 45000, 30.4278, -9.5981, 0.6),
    "Complexe Sportif de Fès": ("Fez", 45000, 34.0181, -5.0078, 0.7),
}

# Groups of the tournament.
GROUPS = {
    "Groupe A": ["Morocco", "Comoros", "Mali", "Zambia"],
    "Groupe B": ["Egypt", "South Africa", "Angola", "Zimbabwe"],
    "Groupe C": ["Nigeria", "Tunisia", "Uganda", "Tanzania"],
    "Groupe D": ["Senegal", "DR Congo", "Benin", "Botswana"],
    "Groupe E": ["Algeria", "Burkina Faso", "Equatorial Guinea", "Sudan"],
    "Groupe F": ["Ivory Coast", "Cameroon", "Gabon", "Mozambique"],
}

# Factor by phase.
PHASES = {
    "Phase de Groupes": 1.0,
    "Huitièmes de Finale": 1.3,
    "Quarts de Finale": 1.5,
    "Demi-Finale": 1.8,
    "Match pour 3ème Place": 1.4,
    "Finale": 2.0,
}

# Factor by pair of teams, in either order.
RIVALRIES = [
    ("Morocco", "Algeria", 2.5),
    ("Egypt", "Algeria", 2.3),
    ("Nigeria", "Cameroon", 2.0),
    ("Senegal", "Egypt", 1.8),
    ("Morocco", "Egypt", 1.7),
    ("Ivory Coast", "Cameroon", 1.6),
]

# Factor by weather.
WEATHER = {
    "Ensoleillé ☀️": 1.1,
    "Nuageux ⛅": 1.0,
    "Pluvieux 🌧️": 0.8,
    "Venteux 💨": 0.9,
}

# Percentages of incident types by tension between the teams.
MATCH_INCIDENTS = {
    "tense": {
        "Troubles supporters": 30,
        "Altercations": 25,
        "Malaises médicaux": 20,
        "Mouvements de foule": 15,
        "Autres": 10,
    },
    "calm": {
        "Malaises médicaux": 35,
        "Affluence/Bousculade": 25,
        "Troubles mineurs": 20,
        "Perte d'objets": 12,
        "Autres": 8,
    },
}

# Alert titles, levels and the recommendations that go with them.
MATCH_ALERTS = {
    "rivalry": (
        "🔥 RIVALITÉ INTENSE", "error",
        ["✅ Séparation stricte des supporters avec zones tampons",
         "✅ Escorte policière pour les autocars de supporters"],
    ),
    "critical": (
        "🚨 RISQUE CRITIQUE", "error",
        ["✅ Déploiement des forces anti-émeute en standby",
         "✅ Hélicoptère médical en alerte"],
    ),
    "host": (
        "🇲🇦 MATCH DU MAROC", "warning",
        ["✅ Renforcement des entrées - Ouverture 3h avant"],
    ),
    "alcohol": (
        "🍺 ZONES ALCOOL", "warning",
        ["✅ Équipes anti-ivresse dédiées"],
    ),
    "decisive": (
        "🏆 MATCH DÉCISIF", "info",
        ["✅ Coordination avec les forces spéciales"],
    ),
    "heat": (
        "🌡️ ALERTE CANICULE", "warning",
        ["✅ Distribution d'eau gratuite",
         "✅ Points de brumisation dans le stade"],
    ),
}

# Icon by match status; anything else gets the last one.
STATUS_ICONS = {"Terminé": "✅", "En cours": "🔴 LIVE", "À venir": "⏰"}
OTHER_ICON = "🔮"


def _first_word(team: Column) -> Column:
    return F.split(team, " ")[0]


def rivalry_factor(team1: Column, team2: Column) -> Column:
    """Factor of a pair by the teams' first words, in either order; 1.0 otherwise."""
    table = {}
    for one, two, factor in RIVALRIES:
        pair = sorted([one.split()[0], two.split()[0]])
        table["|".join(pair)] = factor
    a, b = _first_word(team1), _first_word(team2)
    return lookup(F.concat_ws("|", F.least(a, b), F.greatest(a, b)), table, 1.0)


def stadium_frame(spark: SparkSession) -> DataFrame:
    rows = [(name, *info) for name, info in STADIUMS.items()]
    return spark.createDataFrame(
        rows, "stadium string, city string, capacity int, lat double, lon double, risk_base double"
    )


def group_frame(spark: SparkSession) -> DataFrame:
    rows = [(group, team) for group, teams in GROUPS.items() for team in teams]
    return spark.createDataFrame(rows, "group_name string, team string")


def _stadium(column: Column, position: int) -> Column:
    pairs = [F.lit(x) for name, info in STADIUMS.items() for x in (name, info[position])]
    return F.create_map(*pairs)[column]


def score_matches(matches: DataFrame) -> DataFrame:
    """Nine factors, expected incidents, risk score and class of each match."""
    where, people = F.col("stadium"), F.col("expected_attendance")
    hour = F.split("match_time", ":")[0].cast("int")
    home = F.col("team1").contains("Morocco") | F.col("team2").contains("Morocco")
    df = matches.withColumns(
        {
            "city": _stadium(where, 0),
            "capacity": _stadium(where, 1),
            "stadium_factor": _stadium(where, 4),
            "phase_factor": lookup(F.col("match_type"), PHASES, 1.0),
            "time_factor": F.when(hour >= 20, 1.3).when(hour >= 17, 1.1).otherwise(1.0),
            "rivalry_factor": rivalry_factor(F.col("team1"), F.col("team2")),
            "host_factor": F.when(home, 1.5).otherwise(1.0),
            "weekend_factor": F.when(F.weekday("match_date") >= 5, 1.2).otherwise(1.0),
            "weather_factor": lookup(F.col("weather_condition"), WEATHER, 1.0),
            "alcohol_factor": F.when(F.col("alcohol_zones"), 1.4).otherwise(1.0),
        }
    )
    df = df.withColumn("fill_rate", people / F.col("capacity") * 100)
    total = F.col("stadium_factor")
    for name in ("phase", "time", "rivalry", "host", "weekend", "weather", "alcohol"):
        total = total * F.col(f"{name}_factor")
    df = df.withColumn("total_factor", total * (F.col("fill_rate") / 100))
    incidents = F.lit(15) * (people / 10000) * F.col("total_factor")
    score = F.least(F.lit(100.0), F.col("total_factor") * 30)
    category = (
        F.when(F.col("risk_score") >= 70, "CRITIQUE")
        .when(F.col("risk_score") >= 50, "ÉLEVÉ")
        .when(F.col("risk_score") >= 30, "MODÉRÉ")
        .otherwise("FAIBLE")
    )
    return (
        df.withColumn("predicted_incidents", F.floor(incidents).cast("long"))
        .withColumn("risk_score", score)
        .withColumn("risk_category", category)
    )


def match_staffing(scored: DataFrame) -> DataFrame:
    """Security, medical and logistics numbers by risk class and attendance."""
    people = F.col("expected_attendance")
    risky = F.col("risk_category").isin("CRITIQUE", "ÉLEVÉ")
    thousands = people / 1000
    staffed = scored.withColumns(
        {
            "security_staff": F.floor(thousands * F.when(risky, 8).otherwise(5)).cast("long"),
            "medical_staff": F.floor(thousands * F.when(risky, 3).otherwise(2)).cast("long"),
            "ambulances": share(F.col("predicted_incidents"), 0.15, 3),
        }
    )
    security, medical = F.col("security_staff"), F.col("medical_staff")

    def per(people_per_unit: int, at_least: int) -> Column:
        return F.greatest(F.lit(at_least), F.floor(people / people_per_unit)).cast("long")

    return staffed.withColumns(
        {
            "private_agents": share(security, 0.6),
            "police": share(security, 0.3),
            "special_forces": share(security, 0.1),
            "checkpoints": per(5000, 8),
            "doctors": share(medical, 0.2, 4),
            "nurses": share(medical, 0.4, 8),
            "first_aiders": share(medical, 0.4),
            "gates": per(3000, 10),
            "cameras": per(2000, 20),
            "drones": F.when(F.col("risk_score") >= 50, 3).otherwise(1),
        }
    )


def match_incident_mix(scored: DataFrame, key: str = "match_id") -> DataFrame:
    mix = F.when(F.col("rivalry_factor") >= 1.5, int_map(MATCH_INCIDENTS["tense"])).otherwise(
        int_map(MATCH_INCIDENTS["calm"])
    )
    return scored.select(*percent_rows(mix, key, "incident_type"))


def match_alerts(scored: DataFrame, key: str = "match_id") -> DataFrame:
    """One row per match and alert that applies, with recommendations."""
    heat, phase = F.col("temperature"), F.col("match_type")
    rules = [
        (
            F.col("rivalry_factor") >= 2.0,
            "rivalry",
            F.concat(F.lit("Match à haute tension: "), "team1", F.lit(" vs "), "team2"),
        ),
        (
            F.col("risk_category") == "CRITIQUE",
            "critical",
            F.format_string("Score de risque: %.0f/100", F.bround("risk_score", 0)),
        ),
        (
            F.col("host_factor") > 1.0,
            "host",
            "Affluence maximale et ferveur nationale attendues",
        ),
        (F.col("alcohol_zones"), "alcohol", "Fan zones avec vente d'alcool actives"),
        (
            phase.isin("Finale", "Demi-Finale"),
            "decisive",
            F.concat(phase, F.lit(" - Enjeux maximaux")),
        ),
        (
            heat >= 35,
            "heat",
            F.format_string("Température prévue: %d°C", heat.cast("int")),
        ),
    ]
    built = [
        (condition, {key: F.col(key), **alert(MATCH_ALERTS, name, message)})
        for condition, name, message in rules
    ]
    return rule_alerts(scored, built)


def kickoff(date: str = "date", time: str = "time") -> Column:
    """Timestamp of 'dd/MM/yyyy' and 'HH:mm' texts."""
    text = F.concat_ws(" ", F.col(date), F.col(time))
    return F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm")).cast("timestamp_ntz")


def schedule(
    matches: DataFrame,
    phases: list[str] | None = None,
    cities: list[str] | None = None,
    statuses: list[str] | None = None,
    day: str | None = None,
) -> DataFrame:
    """Schedule with icon and label, filtered, in order of kick-off.

    Order follows the parsed time, so a January match comes after a December one.
    """
    status, score = F.col("status"), F.nullif("score", F.lit(""))
    running = F.concat(
        F.lit("🔴 "), "team1", F.lit(" **"), F.coalesce(score, F.lit("0-0")), F.lit("** "), "team2"
    )
    label = (
        F.when(
            (status == "Terminé") & score.isNotNull(),
            F.concat("team1", F.lit(" **"), score, F.lit("** "), "team2"),
        )
        .when(status == "En cours", running)
        .otherwise(F.concat("team1", F.lit(" vs "), "team2"))
    )
    view = matches.withColumns(
        {
            "icon": lookup(status, STATUS_ICONS, OTHER_ICON),
            "label": label,
            "kickoff": kickoff(),
        }
    )
    for column, wanted in (("phase", phases), ("city", cities), ("status", statuses)):
        if wanted is not None:
            view = view.where(F.col(column).isin(wanted))
    if day is not None:
        view = view.where(F.col("date") == day)
    return view.orderBy("kickoff", "match_id")


def schedule_stats(matches: DataFrame) -> DataFrame:
    status = F.col("status")
    return matches.agg(
        F.count("*").alias("total_matches"),
        F.count_if(status == "Terminé").alias("finished"),
        F.count_if(status == "En cours").alias("live"),
        F.count_if(status == "À venir").alias("upcoming"),
        F.count_if(status == "À déterminer").alias("undetermined"),
        F.countDistinct("stadium").alias("stadiums"),
    )


def stadium_totals(spark: SparkSession) -> DataFrame:
    return stadium_frame(spark).agg(
        F.count("*").alias("stadiums"), F.sum("capacity").alias("total_capacity")
    )


def standings(matches: DataFrame, groups: DataFrame) -> DataFrame:
    """Group tables from finished matches; teams without a match stand at zero."""
    goals = F.split("score", "-")
    played = (
        matches.where((F.col("status") == "Terminé") & F.col("score").isNotNull())
        .withColumns(
            {
                "g1": F.trim(goals[0]).try_cast("int"),
                "g2": F.trim(F.get(goals, F.lit(1))).try_cast("int"),
            }
        )
        .where(F.col("g1").isNotNull() & F.col("g2").isNotNull())
    )
    sides = played.select(
        F.inline(
            F.array(
                F.struct(F.col("team1").alias("team"), F.col("g1").alias("f"), F.col("g2").alias("a")),
                F.struct(F.col("team2").alias("team"), F.col("g2").alias("f"), F.col("g1").alias("a")),
            )
        )
    )
    table = sides.groupBy("team").agg(
        F.count("*").alias("played"),
        F.count_if(F.col("f") > F.col("a")).alias("won"),
        F.count_if(F.col("f") == F.col("a")).alias("drawn"),
        F.count_if(F.col("f") < F.col("a")).alias("lost"),
        F.sum("f").alias("gf"),
        F.sum("a").alias("ga"),
    )
    # a team that no group names keeps its matches, without a group
    full = groups.join(table, "team", "full").na.fill(0)
    return full.select(
        "group_name", "team", "played", "won", "drawn", "lost", "gf", "ga",
        (F.col("gf") - F.col("ga")).alias("gd"),
        (F.col("won") * 3 + F.col("drawn")).alias("points"),
    )
