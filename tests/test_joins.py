import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pulsewatch.functions.geo import Grid, bounding_box
from pulsewatch.operators import analysis, joins, risk
from pulsewatch.plans import catalog
from pulsewatch.session import materialize

CALL = "incident_number string, response_datetime timestamp_ntz, latitude_centroid double, " \
       "longitude_centroid double, priority_level string"
EVENT = "event_id long, event_name string, start_date date, end_date date, event_lat double, " \
        "event_lon double, has_alcohol boolean"


def haversine(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(
        math.radians(lat2)
    ) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1, a)))


def brute(calls, events, radius, whole_day):
    found = set()
    for n, when, lat, lon, _ in calls:
        for e, _, start, end, elat, elon, _ in events:
            if None in (when, lat, lon, start, end, elat, elon):
                continue
            last = dt.datetime.combine(end, dt.time())
            in_time = (
                start <= when.date() <= end
                if whole_day
                else dt.datetime.combine(start, dt.time()) <= when <= last
            )
            if in_time and haversine(lat, lon, elat, elon) <= radius:
                found.add((n, e))
    return found


def world(seed, centre, spread, n_calls=400, n_events=40):
    rnd = random.Random(seed)
    day = dt.date(2024, 1, 1)

    def place():
        lat = max(-89.9, min(89.9, centre[0] + rnd.uniform(-spread, spread)))
        lon = centre[1] + rnd.uniform(-spread, spread) * (10 if abs(centre[0]) > 80 else 1)
        return lat, (lon + 180) % 360 - 180

    calls = []
    for i in range(n_calls):
        lat, lon = place()
        when = dt.datetime.combine(day, dt.time()) + dt.timedelta(
            days=rnd.randrange(10), seconds=rnd.choice([0, rnd.randrange(86400), 86340])
        )
        calls.append((f"c{i}", when, lat, lon, "Priority 1"))
    events = []
    for i in range(n_events):
        lat, lon = place()
        start = day + dt.timedelta(days=rnd.randrange(10))
        events.append(
            (i, f"e{i}", start, start + dt.timedelta(days=rnd.choice([0, 1, 3])), lat, lon, i % 2 == 0)
        )
    return calls, events


@pytest.mark.parametrize("whole_day", [False, True])
@pytest.mark.parametrize("broadcast_rows", [20_000, 0])
@pytest.mark.parametrize(
    ("centre", "spread"),
    [((30.3, -97.7), 0.05), ((0.0, 179.995), 0.05), ((-60.0, -179.99), 0.05), ((84.0, 10.0), 0.05),
     ((89.85, 0.0), 0.04)],
)
def test_grid_join_equals_nested_loop(spark, centre, spread, broadcast_rows, whole_day):
    calls, events = world(7, centre, spread)
    calls += [("none", None, *centre, "x"), ("nowhere", dt.datetime(2024, 1, 2), None, None, "x")]
    events += [(99, "no place", dt.date(2024, 1, 1), dt.date(2024, 1, 9), None, 1.0, True)]
    got = joins.festival_incidents(
        spark.createDataFrame(calls, CALL), spark.createDataFrame(events, EVENT),
        radius_km=1.5, end_inclusive_day=whole_day, broadcast_rows=broadcast_rows, salt_rows=3,
    ).select("incident_number", "event_id").collect()
    pairs = [(r[0], r[1]) for r in got]
    assert len(pairs) == len(set(pairs))
    expected = brute(calls, events, 1.5, whole_day)
    assert expected
    assert set(pairs) == expected


def test_midnight_end_and_one_day_events(spark):
    calls = [
        ("start", dt.datetime(2024, 1, 2, 0, 0), 30.0, -97.0, "p"),
        ("noon", dt.datetime(2024, 1, 2, 12, 0), 30.0, -97.0, "p"),
        ("last", dt.datetime(2024, 1, 2, 23, 59), 30.0, -97.0, "p"),
    ]
    events = [(1, "one day", dt.date(2024, 1, 2), dt.date(2024, 1, 2), 30.0, -97.0, True)]
    c, e = spark.createDataFrame(calls, CALL), spark.createDataFrame(events, EVENT)
    midnight = {r[0] for r in joins.festival_incidents(c, e).select("incident_number").collect()}
    whole = {
        r[0]
        for r in joins.festival_incidents(c, e, end_inclusive_day=True)
        .select("incident_number").collect()
    }
    assert midnight == {"start"}
    assert whole == {"start", "noon", "last"}


def test_call_exactly_at_the_radius_counts(spark):
    lat = 30.0 + 1.0 / (6371 * math.pi / 180)
    d = haversine(30.0, -97.0, lat, -97.0)
    calls = [("edge", dt.datetime(2024, 1, 2), lat, -97.0, "p")]
    events = [(1, "e", dt.date(2024, 1, 2), dt.date(2024, 1, 3), 30.0, -97.0, True)]
    c, e = spark.createDataFrame(calls, CALL), spark.createDataFrame(events, EVENT)
    assert joins.festival_incidents(c, e, radius_km=d * (1 + 1e-12)).count() == 1
    assert joins.festival_incidents(c, e, radius_km=d * (1 - 1e-9)).count() == 0


def test_duplicate_events_join_once(spark):
    calls = [("a", dt.datetime(2024, 1, 2), 30.0, -97.0, "p")]
    event = (1, "e", dt.date(2024, 1, 1), dt.date(2024, 1, 3), 30.0, -97.0, True)
    c, e = spark.createDataFrame(calls, CALL), spark.createDataFrame([event, event], EVENT)
    fact = joins.festival_incidents(c, e)
    assert fact.count() == 1
    assert fact.first()["event_has_amplified_sound"] is False


def test_crowded_cell_is_spread_over_salts(spark):
    """All calls in one place and day still meet the event in several join keys."""
    calls = spark.range(3000).select(
        F.col("id").cast("string").alias("incident_number"),
        F.lit(dt.datetime(2024, 1, 2, 5)).cast("timestamp_ntz").alias("response_datetime"),
        (F.col("id") * 0.0 + 30.0).alias("latitude_centroid"),
        (F.col("id") * 0.0 - 97.0).alias("longitude_centroid"),
    )
    event = [(1, "e", dt.date(2024, 1, 1), dt.date(2024, 1, 3), 30.0, -97.0, True)]
    fact = joins.festival_incidents(
        calls, spark.createDataFrame(event, EVENT), broadcast_rows=0, salt_rows=8
    )
    assert fact.count() == 3000
    plan = fact._jdf.queryExecution().toString()
    assert "_salt" in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("point", [(30.3, -97.7), (0.0, 179.999), (84.0, 10.0)])
def test_radius_lookup_equals_brute_force(spark, point):
    calls, _ = world(3, point, 0.05)
    df = spark.createDataFrame(calls, CALL)
    expected = {c[0] for c in calls if haversine(c[2], c[3], *point) <= 2.0}
    got = joins.nearby_incidents(df, *point, 2.0).collect()
    assert {r["incident_number"] for r in got} == expected
    assert [r["distance_m"] for r in got] == sorted(r["distance_m"] for r in got)
    points = spark.createDataFrame([("p", *point)], "point_id string, lat double, lon double")
    for rows in (10, 0):
        batch = joins.nearby_batch(df, points, 2.0, salt_rows=3, broadcast_rows=rows)
        assert {r["incident_number"] for r in batch.collect()} == expected


def test_bounding_box_contains_circle():
    low, high, west, east = bounding_box(60.0, 10.0, 5.0)
    for turn in range(0, 360, 5):
        angle = math.radians(turn)
        lat = 60.0 + math.degrees(5.0 / 6371) * math.cos(angle)
        lon = 10.0 + math.degrees(5.0 / 6371 / math.cos(math.radians(60))) * math.sin(angle)
        if haversine(60.0, 10.0, lat, lon) <= 5.0:
            assert low <= lat <= high and west <= lon <= east


def test_grid_cells_are_whole_and_wrap(spark):
    grid = Grid(1.5)
    df = spark.createDataFrame([(30.0, -180.0), (30.0, 180.0)], "lat double, lon double")
    cells = df.select(grid.cell(F.col("lon"), grid.band(F.col("lat"))).alias("c")).collect()
    assert cells[0]["c"] == cells[1]["c"]


def test_geo_join_and_rates(spark):
    calls = spark.createDataFrame(
        [("a", "1"), ("b", "2"), ("c", "9"), ("d", None)], "incident_number string, geo_id string"
    )
    geo = spark.createDataFrame(
        [("1", 30.0, -97.0, 1.0), ("2", 31.0, -97.0, 1.0)],
        "geo_id string, latitude_centroid double, longitude_centroid double, area_sq_km double",
    )
    enriched = joins.enrich_geo(calls, geo)
    assert enriched.count() == 4
    rate = joins.match_rate(enriched).first()
    assert (rate["total"], rate["matched"], rate["match_rate"]) == (4, 2, 50.0)
    missing = {(r["geo_id"], r["call_count"]) for r in joins.unmatched_geo(calls, geo).collect()}
    assert missing == {("9", 1), (None, 1)}
    keyed = {r["incident_number"]: r["geo_id"]
             for r in joins.nullify_missing_fk(calls, geo, "geo_id").collect()}
    assert keyed == {"a": "1", "b": "2", "c": None, "d": None}


def test_festival_flag_keeps_every_call(spark):
    calls = spark.createDataFrame([("a",), ("b",)], "incident_number string")
    fact = spark.createDataFrame([("a", 1), ("a", 2)], "incident_number string, event_id int")
    got = {r[0]: r[1] for r in joins.flag_festival(calls, fact).collect()}
    assert got == {"a": True, "b": False}


def test_time_nodes_make_up_each_interval(spark):
    spans = sorted({(a, b) for a in range(0, 70, 3) for b in range(a, a + 90, 7)} | {(0, 0), (5, 4000), (0, 1023), (1, 1022)})
    rows = spark.createDataFrame(spans, "a long, b long")
    nodes = rows.select("*", F.inline(joins._time_nodes(F.col("a"), F.col("b")))).collect()
    days, count = {}, {}
    for r in nodes:
        width = 4 ** r["_level"]
        days.setdefault((r["a"], r["b"]), []).extend(range(r["_node"] * width, (r["_node"] + 1) * width))
        count[r["a"], r["b"]] = count.get((r["a"], r["b"]), 0) + 1
    for a, b in spans:
        assert sorted(days[a, b]) == list(range(a, b + 1))  # all days, none twice
    assert count[5, 4000] <= 36 and count[0, 1023] == 1


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_events_of_a_year_meet_all_their_calls(spark, broadcast_rows):
    start = dt.datetime(2023, 1, 1, 12)
    calls = spark.createDataFrame(
        [(f"c{i}", start + dt.timedelta(days=i % 700), 30.27 + (i % 7) * 0.01, -97.74) for i in range(2100)],
        "incident_number string, response_datetime timestamp_ntz, latitude_centroid double, longitude_centroid double",
    )
    periods = [(2023, 1, 1, 400), (2023, 3, 5, 365), (2022, 6, 1, 3000), (2024, 2, 29, 1), (2023, 12, 31, 2)]
    events = spark.createDataFrame(
        [(f"e{k}", f"e{k}", dt.date(y, m, d), dt.date(y, m, d) + dt.timedelta(days=n - 1), 30.27, -97.74) for k, (y, m, d, n) in enumerate(periods)],
        "event_id string, event_name string, start_date date, end_date date, event_lat double, event_lon double",
    )
    got = joins.festival_incidents(calls, events, 1.5, True, broadcast_rows=broadcast_rows)
    pairs = [(r["event_id"], r["incident_number"]) for r in got.collect()]
    want = {
        (e["event_id"], c["incident_number"])
        for e in events.collect()
        for c in calls.collect()
        if e["start_date"] <= c["response_datetime"].date() <= e["end_date"] and abs(c["latitude_centroid"] - 30.27) < 0.0135
    }
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    span = joins.call_span(calls)
    days = events.withColumns({"_from": F.lit(0).cast("int"), "_to": F.lit(699).cast("int")})
    copies = joins._event_cells(days, joins.Grid(1.5))
    assert copies.groupBy("event_id").count().agg(F.max("count")).first()[0] <= 9 * 24
    assert joins.events_in_range(events, calls, True, span).count() == 5


def crowd(spark):
    """Calls that share places and days, some twice, without a number or at midnight sharp, and events around them."""
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        when = start + dt.timedelta(days=i % 5, hours=0 if i % 11 == 0 else i % 24, minutes=0 if i % 11 == 0 else i % 50)
        number = None if i % 37 == 0 else f"c{i - i % 2}" if i % 10 == 1 else f"c{i}"
        rows.append((number, when, 30.27 + (i % 3) * 0.01, -97.74, f"Priority {i % 4}", None if i % 13 == 0 else i % 4,
                     None if i % 7 == 0 else f"type {i % 6}", float(i % 90)))
    calls = spark.createDataFrame(
        rows + [("lost", start, None, None, "Priority 0", 0, "type 1", 1.0)],
        "incident_number string, response_datetime timestamp_ntz, latitude_centroid double, longitude_centroid double,"
        " priority_level string, priority_numeric int, final_problem_category string, response_time double",
    )
    day = dt.date(2024, 1, 1)
    events = spark.createDataFrame(
        [(k, f"e{k}", day + dt.timedelta(days=k % 5), day + dt.timedelta(days=k % 5 + k % 3), 30.27 + (k % 4) * 0.008, -97.741, k % 2 == 0)
         for k in range(12)] + [(99, "far", day, day, 50.0, 1.0, True)],
        "event_id long, event_name string, start_date date, end_date date, event_lat double, event_lon double, has_alcohol boolean",
    )
    return calls, events


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_counted_fact_adds_up_to_the_listed_one(spark, rows_of, broadcast_rows):
    calls, events = crowd(spark)
    fact = joins.festival_incidents(calls, events, broadcast_rows=broadcast_rows)
    counts = joins.festival_incident_counts(
        calls, events, risk.incident_measures(), ("final_problem_category",), broadcast_rows=broadcast_rows, salt_rows=2
    )
    fact, counts = materialize(fact), materialize(counts)
    assert fact.count() > 2 * counts.select("event_id", *joins.MOMENT).distinct().count()
    one, other = (materialize(risk.festival_risk(f)) for f in (fact, counts))
    same = [c for c, t in one.dtypes if t != "double"]
    assert rows_of(one.select(same)) == rows_of(other.select(same))
    for c in ("avg_priority", "avg_distance", "avg_response_time", "risk_score"):
        got, want = ([r[0] for r in f.orderBy("event_id").select(c).collect()] for f in (other, one))
        assert got == pytest.approx(want)
    linked = joins.linked_calls(calls, counts)
    plain = analysis.overview_kpis(calls, fact, one)
    assert rows_of(analysis.overview_kpis(calls, counts, other, linked)) == rows_of(plain)


def test_summed_fact_gives_the_summary_of_the_listed_one(spark, rows_of):
    calls, events = crowd(spark)
    fact = joins.festival_incidents(calls, events)
    stored = calls.where("priority_numeric is null or priority_numeric < 3").unionByName(calls.limit(20))
    linked = risk.with_stored_priorities(calls, stored)
    summed = joins.festival_incident_counts(linked, events, risk.summary_measures())
    assert rows_of(risk.festival_summary(events, summed, stored)) == rows_of(risk.festival_summary(events, fact, stored))
    plan = risk.festival_summary(events, summed, stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "incident_number" not in plan


def test_pairs_are_made_without_working_out_distances_again(spark):
    """Distances and the shown form of columns are settled for places and calls, not for pairs."""
    calls, events = crowd(spark)
    shown = joins.festival_incidents(calls, events, render=catalog.comparable)
    plan = shown._jdf.queryExecution().optimizedPlan().toString().lower()
    above = plan.split("join inner")[0]
    assert above != plan and "asin(" not in plan and "round(" not in above and "date_format(" not in above
    plain = catalog.comparable(joins.festival_incidents(calls, events))
    assert plain.schema.simpleString() == shown.schema.simpleString()
    assert shown.exceptAll(plain).count() == plain.exceptAll(shown).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_pairs_come_from_lists_of_a_moments_events(spark, rows_of, monkeypatch, broadcast_rows):
    """A call meets lists of events, not each event; lists of two rows give the pairs that whole ones give."""
    calls, events = crowd(spark)
    whole = joins.festival_incidents(calls, events, 3.0, True, broadcast_rows=broadcast_rows)
    plan = whole._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "generate inline" in plan.split("join inner")[0]
    want = rows_of(whole)
    monkeypatch.setattr(joins, "LIST_BITS", 1)
    short = joins.festival_incidents(calls, events, 3.0, True, broadcast_rows=broadcast_rows, salt_rows=3)
    assert rows_of(short) == want and len(want) > 400
    at = {(e["event_id"], e["start_date"], e["end_date"], e["event_lat"], e["event_lon"]) for e in events.collect()}
    found = sorted(
        (str(c["incident_number"]), e)
        for c in calls.collect() if c["latitude_centroid"] is not None
        for e, start, end, lat, lon in at
        if start <= c["response_datetime"].date() <= end
        and haversine(c["latitude_centroid"], c["longitude_centroid"], lat, lon) <= 3.0
    )
    assert sorted((str(r["incident_number"]), r["event_id"]) for r in whole.collect()) == found


def test_pairs_of_calls_in_one_file_are_made_in_many_tasks(spark):
    calls, events = crowd(spark)
    stored = materialize(calls.coalesce(1))
    assert stored.rdd.getNumPartitions() == 1
    fact = joins.festival_incidents(stored, events)
    sizes = fact.rdd.glom().map(len).collect()
    assert len(sizes) >= 4 * spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 4
