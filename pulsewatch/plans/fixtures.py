"""Adapters that give the generated test tables the shape of the domain tables.

Each adapter is a plain projection of one given table (or of the distinct hours or
days in it), so every frame grows with its source.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.operators import clean, joins, matches, planned, risk, series

TEAMS = [team for teams in matches.GROUPS.values() for team in teams]


def pick(values: list, index: Column) -> Column:
    """Element of a literal list by a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pad12(number: Column) -> Column:
    return F.lpad(number.cast("string"), 12, "0")


class Tables:
    """Lazy frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ---- geography, calls, festivals -------------------------------------------------

    @cached_property
    def geo(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            pad12(F.lit(484530001000) + n).alias("geo_id"),
            (F.lit(30.10) + n * F.lit(0.0168)).alias("latitude_centroid"),
            (F.lit(-97.94) + ((n * 7) % 25) * F.lit(0.0156)).alias("longitude_centroid"),
            (F.lit(1.0) + n * F.lit(0.25)).alias("area_sq_km"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        u, ts = F.col("user_id"), F.col("ts").cast("timestamp_ntz")
        level = F.when(u % 5 < 4, F.concat(F.lit("Priority "), (u % 5).cast("string"))).otherwise(
            "Priority X"
        )
        return self.table("events").select(
            F.col("event_id").cast("string").alias("incident_number"),
            ts.alias("response_datetime"),
            F.to_date(ts).alias("response_date"),
            F.hour(ts).alias("response_hour"),
            F.dayname(ts).alias("response_day_of_week"),
            level.alias("priority_level"),
            F.when(u % 5 < 4, u % 5).otherwise(9).cast("int").alias("priority_numeric"),
            (F.col("value") * 60).alias("response_time"),
            F.when(u % 7 < 6, F.concat(F.lit("Type "), (u % 7).cast("string")))
            .alias("initial_problem_category"),
            F.col("event_type").alias("final_problem_category"),
            F.when(u % 30 < 25, pad12(F.lit(484530001000) + u % 30))
            .otherwise("484539999999").alias("geo_id"),
        )

    @cached_property
    def enriched(self) -> DataFrame:
        return joins.enrich_geo(self.calls, self.geo)

    @cached_property
    def festivals(self) -> DataFrame:
        s, n = F.col("s_suppkey"), F.col("s_nationkey")
        base = F.lit("2024-01-01").cast("date")
        return self.table("supplier").select(
            s.alias("event_id"),
            F.col("s_name").alias("event_name"),
            F.date_add(base, (s % 28).cast("int")).alias("start_date"),
            F.date_add(base, (s % 28 + s % 3).cast("int")).alias("end_date"),
            (F.lit(30.101) + n * F.lit(0.0168)).alias("event_lat"),
            (F.lit(-97.94) + ((n * 7) % 25) * F.lit(0.0156)).alias("event_lon"),
            (s % 2 == 0).alias("has_alcohol"),
            (s % 3 == 0).alias("has_amplified_sound"),
        )

    @cached_property
    def fact(self) -> DataFrame:
        return joins.festival_incidents(self.enriched, self.festivals)

    @cached_property
    def counted_fact(self) -> DataFrame:
        """The fact with calls of one moment and category counted, not listed."""
        return joins.festival_incident_counts(
            self.enriched, self.festivals, risk.incident_measures(), ("final_problem_category",)
        )

    @cached_property
    def summed_fact(self) -> DataFrame:
        """The fact with the incidents and stored priorities of a moment summed."""
        linked = risk.with_stored_priorities(self.enriched, self.calls)
        return joins.festival_incident_counts(linked, self.festivals, risk.summary_measures())

    @cached_property
    def flagged(self) -> DataFrame:
        return joins.flag_festival(self.enriched, self.fact)

    # ---- weather ------------------------------------------------------------------------

    @cached_property
    def weather_raw(self) -> DataFrame:
        hours = self.table("events").select(
            F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).alias("datetime")
        ).distinct()
        h = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("datetime"))
        hours = hours.withColumn("h", h)
        h = F.col("h")
        rain = F.when(h % 13 == 0, None).when(h % 11 == 0, (h % 7) * F.lit(0.3)).otherwise(0.0)
        codes = [0, 1, 2, 3, 45, 51, 61, 71, 80, 95]
        return hours.select(
            "datetime",
            (((h * 37) % 400) / F.lit(10.0) - 5).alias("temperature_c"),
            (30 + (h * 13) % 70).cast("double").alias("humidity_pct"),
            rain.alias("precipitation_mm"),
            rain.alias("rain_mm"),
            F.when(h % 17 > 0, pick(codes, h % 10)).alias("weather_code"),
            ((h * 7) % 50).cast("double").alias("wind_speed_kmh"),
            ((h * 7) % 50 + 10).cast("double").alias("wind_gusts_kmh"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        return clean.build_dim_weather(self.weather_raw)

    @cached_property
    def weather_documents(self) -> DataFrame:
        """One JSON document per day with parallel arrays of its (at most 24) hours."""
        fields = {
            "time": F.date_format("datetime", "yyyy-MM-dd'T'HH:mm"),
            "temperature_2m": F.col("temperature_c"),
            "relative_humidity_2m": F.col("humidity_pct"),
            "precipitation": F.col("precipitation_mm"),
            "rain": F.col("rain_mm"),
            "weather_code": F.col("weather_code"),
            "wind_speed_10m": F.col("wind_speed_kmh"),
            "wind_gusts_10m": F.col("wind_gusts_kmh"),
        }
        row = F.struct(*[c.alias(name) for name, c in fields.items()])
        days = self.weather_raw.groupBy(F.to_date("datetime").alias("date")).agg(
            F.array_sort(F.collect_list(row)).alias("hours")
        )
        hourly = F.struct(*[F.col(f"hours.{name}").alias(name) for name in fields])
        text = F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})
        return days.select(text.alias("body"))

    @cached_property
    def calls_weather(self) -> DataFrame:
        return joins.join_weather(self.enriched, self.weather)

    # ---- long daily series ------------------------------------------------------------------

    @cached_property
    def long_calls(self) -> DataFrame:
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("incident_number"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("response_datetime"),
            F.when(digit < 5, digit - 1).otherwise(9).alias("priority_numeric"),
            (F.col("o_totalprice") / 100).alias("response_time"),
        )

    @cached_property
    def long_daily(self) -> DataFrame:
        return series.daily_calls(self.long_calls)

    @cached_property
    def long_weather(self) -> DataFrame:
        days = self.table("orders").select(F.to_date("o_orderdate").alias("date")).distinct()
        w = F.datediff("date", F.lit("1995-01-01").cast("date"))
        return days.select(
            "date",
            (40 + (w * 13) % 50).cast("double").alias("temp_avg_f"),
            ((w % 9) * F.lit(0.5)).alias("precipitation_total_mm"),
            (30 + (w * 7) % 60).cast("double").alias("humidity_avg_pct"),
        )

    # ---- raw tables for the cleaning operators -------------------------------------------

    @cached_property
    def raw_calls(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        ts = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
        geo = (
            F.when(e % 29 == 0, None)
            .when(e % 31 == 0, F.lit("48453001.0"))
            .when(e % 2 == 0, F.concat((F.lit(484530001000) + u % 30).cast("string"), F.lit(".0")))
            .otherwise((F.lit(484530001000) + u % 30).cast("string"))
        )
        return self.table("events").select(
            (e - F.when(e % 10 == 9, 1).otherwise(0)).cast("string").alias("Incident Number"),
            F.when(e % 4 > 0, F.lit("Call")).alias(" Incident Type"),
            F.when(u % 6 == 5, None).otherwise(F.concat(F.lit("Priority "), (u % 6).cast("string")))
            .alias("Priority Level"),
            F.when(e % 50 == 7, "not a date").otherwise(ts).alias("Response Datetime"),
            ts.alias("Call Closed Datetime"),
            (F.col("value") * 60).alias("Response Time"),
            geo.alias("Geo ID"),
            F.when(u % 3 > 0, F.col("event_type")).alias("Final Problem Category"),
            F.when(u % 4 > 0, F.lit("N")).alias("Mental Health Flag"),
            (u % 9).cast("string").alias("Sector"),
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        s, n = F.col("s_suppkey"), F.col("s_nationkey")
        start = F.date_add(F.lit("2024-01-01").cast("date"), (s % 28).cast("int"))
        end = F.date_add(start, (s % 3).cast("int"))
        lat, lon = F.lit(30.101) + n * F.lit(0.0168), F.lit(-97.94) + n * F.lit(0.05)
        return self.table("supplier").select(
            s.alias("FOLDERRSN"),
            F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("FOLDERNAME"),
            F.lit("ACE").alias("FOLDERTYPE"),
            pick(["Active", "Closed", "Pending"], s % 3).alias("STATUS"),
            F.when(s % 11 == 0, "soon")
            .when(s % 5 == 4, start.cast("string"))
            .otherwise(F.date_format(start, "MMM dd, yyyy")).alias("START_DATE"),
            F.when(s % 13 == 0, None).otherwise(F.date_format(end, "MMM dd, yyyy"))
            .alias("END_DATE"),
            F.when(s % 7 == 0, "n/a").otherwise(lat.cast("string")).alias("GPSLATITUDE"),
            F.when(s % 7 == 1, None).otherwise(lon.cast("string")).alias("GPSLONGITUDE"),
            F.when(s % 3 == 0, "Yes").when(s % 3 == 1, "no").alias("ALCOHOL_SERVED"),
            pick(["Y", " TRUE ", "0", "1", "none"], s % 5).alias("AMPLIFIED_SOUND"),
            F.when(s % 4 == 0, None).when(s % 4 == 1, " ").otherwise("Full").alias("ROAD_CLOSURE"),
            F.lit("Org").alias("EVENT_APPLICANT_ORGANIZATION"),
        )

    @cached_property
    def raw_block_groups(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            (F.lit(484530001000) + n).cast("string").alias("GEOID"),
            F.when(n % 5 < 4, "453").otherwise("491").alias("COUNTYFP"),
            F.concat(F.lit("+"), (F.lit(30.10) + n * F.lit(0.0168)).cast("string"))
            .alias("INTPTLAT"),
            (F.lit(-97.94) + n * F.lit(0.0156)).cast("string").alias("INTPTLON"),
            ((n + 1) * 1250000).cast("long").alias("ALAND"),
        )

    @cached_property
    def raw_venues(self) -> DataFrame:
        p = F.col("p_partkey")
        return self.table("part").select(
            (p - F.when(p % 20 == 19, 1).otherwise(0)).cast("string").alias("id"),
            F.concat_ws(" ", "p_name", p.cast("string")).alias("name"),
            F.when(p % 10 > 0, F.lit(30.0) + F.col("p_size") * F.lit(0.01)).alias("latitude"),
            (F.lit(-97.9) + F.col("p_size") * F.lit(0.01)).alias("longitude"),
            F.when(p % 3 > 0, F.lit("Main St")).alias("address"),
            F.when(p % 4 > 0, F.lit("Austin")).alias("city"),
            F.lit("TX").alias("state"),
            pick(["US", "MX", "CA"], F.col("p_size") % 3).alias("country"),
            F.when(p % 6 == 0, None).when(p % 6 == 1, " ,x")
            .otherwise(F.concat(F.col("p_type"), F.lit(" , "), F.col("p_brand")))
            .alias("categories"),
            p.cast("string").alias("point_of_interest"),
        )

    # ---- planned events and matches ---------------------------------------------------------

    @cached_property
    def planned(self) -> DataFrame:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        hour = F.lpad((k % 24).cast("string"), 2, "0")
        return self.table("orders").select(
            k.alias("event_id"),
            (100 + c * 60).alias("expected_attendance"),
            (k % 2 == 1).alias("has_alcohol"),
            F.to_date("o_orderdate").alias("event_date"),
            F.concat(hour, F.lit(":30")).alias("start_time"),
            pick([*planned.ZONES, "Elsewhere"], c % 7).alias("location"),
            pick([*planned.WEATHER_FACTORS, "Fog"], k % 6).alias("weather_condition"),
            (60 + k % 45).alias("temperature"),
        )

    @cached_property
    def scored_events(self) -> DataFrame:
        return planned.score_planned_events(self.planned)

    @cached_property
    def planned_matches(self) -> DataFrame:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            k.alias("match_id"),
            pick(list(matches.PHASES), k % 6).alias("match_type"),
            pick(list(matches.STADIUMS), c % 6).alias("stadium"),
            pick(TEAMS, k % 24).alias("team1"),
            pick(TEAMS, (k + 1 + c % 23) % 24).alias("team2"),
            F.to_date("o_orderdate").alias("match_date"),
            pick(["14:00", "17:00", "20:00", "21:00"], k % 4).alias("match_time"),
            (10000 + (c * 37) % 35000).alias("expected_attendance"),
            (5 + k % 40).alias("temperature"),
            pick(list(matches.WEATHER), c % 4).alias("weather_condition"),
            (k % 3 == 0).alias("alcohol_zones"),
        )

    @cached_property
    def scored_matches(self) -> DataFrame:
        return matches.score_matches(self.planned_matches)

    @cached_property
    def match_rows(self) -> DataFrame:
        """Matches with status and score, one per order."""
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        score = F.concat_ws("-", (c % 4).cast("string"), (k % 3).cast("string"))
        stadium = pick(list(matches.STADIUMS), c % 6)
        return self.table("orders").select(
            k.alias("match_id"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
            pick(["14:00", "17:00", "20:00", "21:00"], k % 4).alias("time"),
            pick(TEAMS, k % 24).alias("team1"),
            pick(TEAMS, (k + 1 + c % 23) % 24).alias("team2"),
            F.when((k % 5 < 3) & (c % 5 > 0), score).alias("score"),
            pick(["Terminé", "Terminé", "En cours", "À venir", "À déterminer"], k % 5)
            .alias("status"),
            stadium.alias("stadium"),
            F.element_at(F.create_map(*[F.lit(x) for n, i in matches.STADIUMS.items()
                                        for x in (n, i[0])]), stadium).alias("city"),
            pick(["Groupe A", "Huitièmes", "Quarts"], c % 3).alias("phase"),
        )

    @cached_property
    def result_documents(self) -> DataFrame:
        """One JSON results document per order: a match list and a map of tables."""
        match = F.struct(
            "match_id", "date", "time", "team1", "team2", "score", "status",
            F.array(F.concat("team1", F.lit(" 10'"))).alias("scorers"),
            "stadium",
            F.lit(1000).cast("long").alias("attendance"),
        )
        row = F.struct(
            F.col("team1").alias("team"),
            *[F.lit(v).alias(n) for n, v in (("played", 1), ("won", 1), ("drawn", 0), ("lost", 0),
                                             ("gf", 2), ("ga", 0), ("gd", 2), ("points", 3))],
        )
        body = F.to_json(
            F.struct(
                F.lit("2025-12-24T17:18:00").alias("last_updated"),
                F.lit("Cup").alias("tournament"),
                F.array(match).alias("matches"),
                F.create_map(F.col("phase"), F.array(row)).alias("standings"),
            )
        )
        return self.match_rows.select(body.alias("body"))

    @cached_property
    def early_inputs(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").select(
            k.alias("event_id"),
            ((k % 101) / F.lit(100.0)).alias("volume"),
            ((k % 11) / F.lit(10.0)).alias("zone"),
            (k % 2).cast("double").alias("alcohol"),
            ((k % 6) / F.lit(5.0)).alias("weather"),
            ((k % 25) / F.lit(24.0)).alias("hour_factor"),
        )

    @cached_property
    def file_inventory(self) -> DataFrame:
        n = F.col("n_nationkey")
        layer = pick(["raw", "transformed"], n % 2)
        name = F.when(n % 3 == 0, "911/calls").when(n % 4 == 2, "events/permits").otherwise("x/y")
        return self.table("nation").select(
            layer.alias("layer"), F.concat(name, F.lit("_"), n.cast("string")).alias("path")
        )

    def given_clusters(self) -> DataFrame:
        """Location features with a cluster that follows from the place itself."""
        places = risk.location_features(self.enriched)
        step = F.round((F.col("latitude") - F.lit(30.10)) / F.lit(0.0168)).cast("int")
        return places.withColumn("cluster", step % 7)

