import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsewatch.operators import matches, planned, quality, reports, risk

FACT = "incident_number string, event_id long, event_name string, distance_km double, " \
       "priority_level string, priority_numeric int, final_problem_category string, " \
       "response_time double, event_has_alcohol boolean, event_has_amplified_sound boolean"


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def row(n, event, level, category, distance=0.3, response=60.0, alcohol=False):
    number = int(level[-1]) if level and level[-1] in "0123" else 9
    return (n, event, f"E{event}", distance, level, number, category, response, alcohol, False)


def test_festival_risk_formula(spark):
    rows = [row(str(i), 1, "Priority 0", "A", 0.3, 60.0, True) for i in range(4)]
    rows += [row("x", 2, "Priority 3", "B", 1.5)]
    got = {r["event_id"]: r for r in risk.festival_risk(fact(spark, rows)).collect()}
    one, two = got[1], got[2]
    assert one["incident_score"] == 100.0 and two["incident_score"] == 25.0
    assert one["priority_score"] == 16 and two["priority_score"] == 1
    assert two["priority_score_norm"] == 100 / 16
    assert one["distance_score"] == pytest.approx(80.0) and two["distance_score"] == 0.0
    assert one["risk_score"] == pytest.approx(40 + 35 + 12 + 10)
    assert (one["risk_category"], two["risk_category"]) == ("HIGH", "LOW")


def test_no_priority_zero_means_no_priority_points(spark):
    rows = [row("a", 1, "Priority 1", "A"), row("b", 2, "Priority 9", "A")]
    for r in risk.festival_risk(fact(spark, rows)).collect():
        assert r["priority_score"] == 0 and r["priority_score_norm"] == 0.0
        assert r["avg_priority"] == (1.0 if r["event_id"] == 1 else 9.0)


def test_top_type_tie_and_nulls(spark):
    rows = [row("a", 1, "Priority 1", "B"), row("b", 1, "Priority 1", "A"),
            row("c", 1, "Priority 1", None), row("d", 1, "Priority 1", None),
            row("e", 1, "Priority 1", None), row("f", 2, "Priority 1", None)]
    df = fact(spark, rows)
    for frame in (risk.top_incident_type(df), risk.festival_metrics(df)):
        got = {r["event_id"]: r["top_incident_type"] for r in frame.collect()}
        assert got == {1: "A", 2: "Unknown"}


def test_sql_scores_keep_empty_events(spark):
    events = spark.createDataFrame(
        [(1, "E1", True), (2, "E2", False)], "event_id long, event_name string, has_alcohol boolean"
    )
    calls = spark.createDataFrame(
        [(str(i), 0) for i in range(60)], "incident_number string, priority_numeric int"
    )
    linked = fact(spark, [row(str(i), 1, "Priority 0", "A") for i in range(12)])
    one, two = risk.risk_scores_sql(events, linked, calls, 1).orderBy("event_id").collect()
    assert (one["risk_score"], one["risk_category"]) == (12 * 0.5 + 40 + 10, "MEDIUM")
    assert (two["incident_count"], two["avg_priority"], two["risk_score"]) == (0, None, 20.0)
    first = risk.risk_scores_sql(events, linked, calls, 2).orderBy("event_id").first()
    assert (first["risk_score"], first["risk_category"]) == (46.0, "LOW")


def test_heatmap_window_and_unplaced(spark):
    day = dt.datetime(2024, 3, 31, 12)
    rows = [(30.0, -97.0, 1, day), (30.0, -97.0, 3, day - dt.timedelta(days=31)),
            (None, None, 2, day), (30.0, -97.0, 1, dt.datetime(2024, 3, 1))]
    df = spark.createDataFrame(
        rows, "latitude_centroid double, longitude_centroid double, priority_numeric int, "
              "response_datetime timestamp_ntz"
    )
    got = {r["lat"]: r["incident_count"] for r in risk.risk_heatmap(df).collect()}
    assert got == {30.0: 2, None: 1}
    assert risk.risk_heatmap(df, as_of=dt.date(2024, 6, 1)).count() == 0
    assert [r["incident_count"] for r in risk.zone_heatmap(df).collect()] == [3]


def plan(spark, **changes):
    base = dict(event_id=1, expected_attendance=5000, has_alcohol=True,
                event_date=dt.date(2024, 6, 1), start_time="21:00",
                location="Downtown/6th Street (HIGH RISK)", weather_condition="Clear (Clair)",
                temperature=95)
    base.update(changes)
    return spark.createDataFrame(
        [tuple(base.values())],
        "event_id long, expected_attendance long, has_alcohol boolean, event_date date, "
        "start_time string, location string, weather_condition string, temperature int",
    )


def test_planned_event_full_risk(spark):
    scored = planned.score_planned_events(plan(spark))
    r = scored.first()
    value = 5000 * 0.002
    for factor in (1.315, 1.15, 1.25, 1.4, 1.2):
        value *= factor
    assert r["predicted_incidents"] == int(value) == 31
    assert r["risk_score"] == pytest.approx(31 / 50 * 0.4 + 60)
    assert r["risk_category"] == "HIGH"
    alerts = [a["alert"] for a in planned.planned_alerts(scored).collect()]
    assert len(alerts) == 4
    staff = planned.planned_staffing(scored).first()
    assert (staff["medical_staff"], staff["security_staff"], staff["radios"]) == (9, 15, 24)
    assert (staff["doctors"], staff["nurses"], staff["ambulances"]) == (2, 4, 3)
    mix = {m["priority_level"]: m["percentage"] for m in planned.planned_priority_mix(scored).collect()}
    assert mix == planned.PRIORITY_MIX["alcohol_weekend"]


def test_planned_event_defaults_and_floors(spark):
    scored = planned.score_planned_events(
        plan(spark, has_alcohol=False, event_date=dt.date(2024, 6, 3), start_time="10:30",
             location="Nowhere", weather_condition=None, temperature=90, expected_attendance=100)
    )
    r = scored.first()
    assert (r["predicted_incidents"], r["risk_score"], r["risk_category"]) == (0, 0.0, "LOW")
    assert planned.planned_alerts(scored).count() == 0
    staff = planned.planned_staffing(scored).first()
    assert (staff["medical_staff"], staff["security_staff"], staff["fixed_posts"]) == (2, 4, 2)
    for frame in (planned.planned_incident_mix(scored), planned.planned_priority_mix(scored)):
        assert frame.agg(F.sum("percentage")).first()[0] == 100


MATCH = "match_id long, match_type string, stadium string, team1 string, team2 string, " \
        "match_date date, match_time string, expected_attendance long, temperature int, " \
        "weather_condition string, alcohol_zones boolean"


def test_match_scoring(spark):
    rows = [
        (1, "Finale", "Prince Moulay Abdellah Stadium", "Algeria 🇩🇿", "Morocco 🇲🇦",
         dt.date(2026, 1, 18), "20:00", 68700, 36, "Ensoleillé ☀️", True),
        (2, "Phase de Groupes", "Stade Adrar", "Mali", "Zambia", dt.date(2025, 12, 22), "14:00",
         22500, 18, "Nuageux ⛅", False),
    ]
    scored = matches.score_matches(spark.createDataFrame(rows, MATCH)).orderBy("match_id")
    one, two = scored.collect()
    factor = 0.9 * 2.0 * 1.3 * 2.5 * 1.5 * 1.2 * 1.1 * 1.4
    assert one["total_factor"] == pytest.approx(factor)
    assert one["predicted_incidents"] == int(15 * 6.87 * factor)
    assert (one["risk_score"], one["risk_category"]) == (100.0, "CRITIQUE")
    assert two["total_factor"] == pytest.approx(0.6 * 0.5)
    assert (two["risk_category"], two["rivalry_factor"]) == ("FAIBLE", 1.0)
    alerts = matches.match_alerts(scored).collect()
    assert {a["match_id"] for a in alerts} == {1} and len(alerts) == 6
    staff = {r["match_id"]: r for r in matches.match_staffing(scored).collect()}
    assert (staff[1]["security_staff"], staff[1]["medical_staff"]) == (549, 206)
    assert (staff[2]["security_staff"], staff[2]["gates"], staff[2]["drones"]) == (112, 10, 1)
    assert staff[2]["ambulances"] == 3


@pytest.mark.parametrize(
    ("a", "b", "factor"),
    [("Ivory Coast 🇨🇮", "Cameroon", 1.6), ("Cameroon", "Ivory Coast", 1.6), ("Egypt", "Morocco", 1.7),
     ("South Africa", "DR Congo", 1.0)],
)
def test_rivalry_in_either_order(spark, a, b, factor):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(matches.rivalry_factor(F.col("a"), F.col("b"))).first()[0] == factor


def test_schedule_orders_by_time_not_text(spark):
    rows = [
        (1, "03/01/2026", "17:00", "1A", "2B", None, "S", "Rabat", "Huitièmes", "À déterminer"),
        (2, "24/12/2025", "17:00", "Algeria", "Sudan", None, "S", "Fez", "Groupe E", "En cours"),
        (3, "21/12/2025", "21:00", "Morocco", "Comoros", "2-0", "S", "Rabat", "Groupe A", "Terminé"),
        (4, "21/12/2025", "14:00", "Mali", "Zambia", "", "S", "Fez", "Groupe A", "Terminé"),
    ]
    df = spark.createDataFrame(
        rows, "match_id long, date string, time string, team1 string, team2 string, score string, "
              "stadium string, city string, phase string, status string"
    )
    view = matches.schedule(df).collect()
    assert [r["match_id"] for r in view] == [4, 3, 2, 1]
    assert [r["label"] for r in view] == [
        "Mali vs Zambia", "Morocco **2-0** Comoros", "🔴 Algeria **0-0** Sudan", "1A vs 2B",
    ]
    assert [r["match_id"] for r in matches.schedule(df, cities=["Fez"], statuses=["Terminé"]).collect()] == [4]
    assert matches.schedule(df, day="24/12/2025").count() == 1
    stats = matches.schedule_stats(df).first()
    assert (stats["finished"], stats["live"], stats["undetermined"]) == (2, 1, 1)


def test_standings(spark):
    rows = [(1, "Morocco", "Comoros", "2-0", "Terminé"), (2, "Mali", "Zambia", "1-1", "Terminé"),
            (3, "Algeria", "Sudan", "1-0", "En cours"), (4, "Egypt", "Angola", None, "Terminé")]
    df = spark.createDataFrame(
        rows, "match_id long, team1 string, team2 string, score string, status string"
    )
    table = {r["team"]: r for r in matches.standings(df, matches.group_frame(spark)).collect()}
    assert len(table) == 24
    assert (table["Morocco"]["points"], table["Morocco"]["gd"]) == (3, 2)
    assert (table["Comoros"]["lost"], table["Comoros"]["gd"]) == (1, -2)
    assert table["Mali"]["points"] == table["Zambia"]["points"] == 1
    assert table["Algeria"]["played"] == table["Egypt"]["played"] == 0
    guests = df.unionByName(spark.createDataFrame([(5, "Guest", "Mali", "3-0", "Terminé")], df.schema))
    table = {r["team"]: r for r in matches.standings(guests, matches.group_frame(spark)).collect()}
    assert len(table) == 25 and (table["Guest"]["group_name"], table["Guest"]["points"]) == (None, 3)
    assert (table["Mali"]["played"], table["Mali"]["gd"]) == (2, -3)
    totals = matches.stadium_totals(spark).first()
    assert (totals["stadiums"], totals["total_capacity"]) == (6, 323940)


def test_early_warning(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 1.0), (1.0, 0.0, 1.0, 0.0, 0.0)],
                               ["volume", "zone", "alcohol", "weather", "hour_factor"])
    got = [r["warning_score"] for r in reports.early_warning(df).collect()]
    assert got == pytest.approx([1.0, 0.5])


def test_one_failed_model_stops_no_other(spark):
    def broken():
        raise ValueError("no data")

    got = {r["model"]: r for r in reports.run_models(
        spark, {"a": broken, "b": lambda: {"r2": 0.5}}).collect()}
    assert (got["a"]["status"], got["a"]["error"]) == ("FAILED", "no data")
    assert (got["b"]["status"], got["b"]["value"]) == ("SUCCESS", 0.5)


def test_pipeline_alerts(spark):
    rows = [(0, 0, 0, 0), (50, 11, 3, 0), (500, 10, 0, 2)]
    df = spark.createDataFrame(rows, "records_processed long, high_risk long, rules long, clusters long")
    got = sorted(r["type"] for r in reports.pipeline_alerts(df).collect())
    assert got == ["DATA_VOLUME", "HIGH_RISK_SPIKE", "LOW_VOLUME", "ML_MODEL_FAILURE"]


def test_daily_report_is_one_nested_document(spark):
    scores = spark.createDataFrame([(1, "HIGH"), (2, "LOW"), (3, "LOW")],
                                   "event_id long, risk_category string")
    calls = spark.createDataFrame([("a", dt.datetime(2024, 1, 2)), ("b", dt.datetime(2024, 1, 1))],
                                  "incident_number string, response_datetime timestamp_ntz")
    stats = reports.db_stats(calls, scores, scores)
    report = reports.daily_report(stats, scores, "r", "2024-01-02 06:00:00", rules=3, forecast_avg=12.25)
    document = json.loads(report.toJSON().first())
    assert document["database_stats"]["today_calls"] == 1
    assert document["data_processing"]["call_records_processed"] == 2
    models = document["ml_models"]
    assert models["risk_scoring"]["distribution"] == {"HIGH": 1, "LOW": 2}
    assert models["forecasting"]["avg_predicted_calls"] == 12.2
    assert (models["association_rules"]["status"], models["clustering"]["status"]) == ("COMPLETED", "SKIPPED")


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [("1", 30.0, 1.0), ("1", 99.0, 0.0), ("22", None, 2.0)], "id string, lat double, area double"
    )
    checks = quality.Checks(
        unique=["id"], ranges={"lat": (25, 37)}, positive=["area"], lengths={"id": 1},
        required=["id", "zzz"], min_filled_pct={"lat": 60.0},
    )
    got = {r["check"]: (r["value"], r["passed"]) for r in quality.quality_checks(df, checks).collect()}
    assert got["not_empty"] == (3.0, True)
    assert got["unique:id"] == (1.0, False)
    assert got["range:lat"] == (1.0, False)
    assert got["positive:area"] == (1.0, False)
    assert got["length:id"] == (1.0, False)
    assert got["required:id"] == (0.0, True) and got["required:zzz"] == (1.0, False)
    assert got["filled:lat"][1] is True
    empty = {r["check"]: r["passed"] for r in quality.quality_checks(df.limit(0), checks).collect()}
    assert empty["not_empty"] is False
