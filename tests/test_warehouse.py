import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from pulsewatch import schemas
from pulsewatch.operators import key_summary, reports, warehouse
from pulsewatch.plans import pipeline
from pulsewatch.sources import readers, sinks
from pulsewatch.streaming import incremental

KV = "k string, a int, b string"


def test_upsert_all_some_and_insert_only(spark, rows_of):
    base = spark.createDataFrame([("x", 1, "old"), ("y", 2, "old")], KV)
    new = spark.createDataFrame([("y", 20, "new"), ("y", 30, "later"), ("z", 3, "new")], KV)
    order = [F.desc("a")]
    assert rows_of(warehouse.upsert(base, new, "k", order_by=order)) == [
        ("x", 1, "old"), ("y", 30, "later"), ("z", 3, "new"),
    ]
    assert rows_of(warehouse.upsert(base, new, "k", ["a"], order)) == [
        ("x", 1, "old"), ("y", 30, "old"), ("z", 3, "new"),
    ]
    assert rows_of(warehouse.insert_new(base, new, "k", order)) == [
        ("x", 1, "old"), ("y", 2, "old"), ("z", 3, "new"),
    ]


def test_update_to_null_and_missing_columns(spark, rows_of):
    base = spark.createDataFrame([("x", 1, "old")], KV)
    new = spark.createDataFrame([("x", None), ("z", 5)], "k string, a int")
    assert rows_of(warehouse.upsert(base, new, "k")) == [("x", None, "old"), ("z", 5, None)]


def test_incremental_rows(spark, ts, rows_of):
    schema = "incident_number string, response_datetime timestamp_ntz"
    base = spark.createDataFrame([("a", ts("2024-01-02")), ("n", None)], schema)
    # late, of an equal time, without a time: whatever is not loaded yet is due
    new = spark.createDataFrame(
        [("a", ts("2024-01-02")), ("b", ts("2024-01-01")), ("c", ts("2024-01-02")), ("d", None), ("n", None)],
        schema,
    )
    keys = {r["incident_number"] for r in warehouse.incremental_rows(new, base).collect()}
    assert keys == {"b", "c", "d"}
    assert warehouse.incremental_rows(new, base.limit(0)).count() == 5
    seen = warehouse.incremental_rows(new, base, since="2024-01-03").collect()
    assert {r["incident_number"] for r in seen} == {"a", "b", "c", "d"}


def test_upsert_shuffles_each_side_once(spark):
    base = spark.createDataFrame([("a", 1, "old")], KV)
    new = spark.createDataFrame([("a", 2, "new"), ("b", 3, "new")], KV)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warehouse.upsert(base, new, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
    assert plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize(
    ("files", "count", "due"),
    [
        ([("raw", "911/a.xlsx"), ("raw", "events/Event.xlsx")], 0, (True, True)),
        ([("raw", "911/a.xlsx"), ("transformed", "911_x"), ("transformed", "events_x")], 500, (False, False)),
        ([("raw", "911/a.xlsx"), ("transformed", "911_x")], 50, (True, False)),
        ([("raw", "911/a.xlsx"), ("enriched", "911_x")], 0, (False, False)),
        ([], 0, (False, False)),
    ],
)
def test_rebuild_plan(spark, files, count, due):
    inventory = spark.createDataFrame(files, "layer string, path string")
    plan = warehouse.rebuild_plan(inventory, spark.range(count).agg(F.count("*"))).collect()
    assert {r["task"]: r["is_due"] for r in plan} == dict(
        zip(("extract_calls", "extract_events"), due)
    )


def test_fact_load_casts_cuts_and_checks_keys(spark):
    calls = spark.createDataFrame(
        [("n" * 60, "2024-01-02 03:04:05", "7.0", "1", "30.5"), ("b", "bad", "x", "9", None)],
        "incident_number string, response_datetime string, response_hour string, geo_id string, "
        "latitude_centroid string",
    )
    geo = spark.createDataFrame([("1",)], "geo_id string")
    got = {r["incident_number"][:1]: r for r in warehouse.load_fact_calls(calls, geo).collect()}
    assert len(got["n"]["incident_number"]) == 60
    assert (got["n"]["response_hour"], got["n"]["geo_id"], got["n"]["latitude_centroid"]) == (
        7, "1", 30.5,
    )
    b = got["b"]
    assert (b["response_datetime"], b["response_hour"], b["geo_id"]) == (None, None, None)
    assert list(got["n"].asDict()) == [f.name for f in schemas.FACT_CALLS]


def test_long_keys_with_one_prefix_stay_apart(spark):
    calls = spark.createDataFrame(
        [("n" * 60 + c, "1" * 20 + c, "theft " * 40) for c in "ab"],
        "incident_number string, geo_id string, initial_problem_category string",
    )
    geo = spark.createDataFrame([("1" * 20 + "a",), ("1" * 20,)], "geo_id string")
    got = {r["incident_number"]: r for r in warehouse.load_fact_calls(calls, geo).collect()}
    assert set(got) == {"n" * 60 + "a", "n" * 60 + "b"}
    assert [got["n" * 60 + c]["geo_id"] for c in "ab"] == ["1" * 20 + "a", None]
    assert got["n" * 60 + "a"]["initial_problem_category"] == "theft " * 40
    cut = warehouse.load_fact_calls(calls, geo, limits={"initial_problem_category": 5}).head()
    assert cut["initial_problem_category"] == "theft"
    with pytest.raises(ValueError):
        warehouse.load_fact_calls(calls, geo, limits={"geo_id": 20})


def test_event_load(spark):
    events = spark.createDataFrame(
        [(7, "B", None), (5, None, True), (6, "A", False)],
        "event_id long, event_name string, has_alcohol boolean",
    )
    every = {r["event_id"]: r for r in warehouse.load_dim_event(events).collect()}
    assert set(every) == {5, 6, 7} and every[7]["has_alcohol"] is False
    assert (every[5]["event_name"], every[6]["event_name"]) == ("Event_4", "A")
    assert every[5]["event_type"] == "Festival"


def test_partition_upsert_rewrites_only_what_it_touches(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    schema = "k string, v int, p string"
    warehouse.upsert_partitions(
        path, spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], schema), "k", ["p"]
    )
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "p=z").iterdir()}
    # b arrives under another partition: it stays where it is, so it is never doubled
    change = spark.createDataFrame([("b", 20, "x"), ("d", 4, "w")], schema)
    for _ in range(2):
        warehouse.upsert_partitions(path, change, "k", ["p"])
        spark.catalog.refreshByPath(path)
        assert rows_of(spark.read.parquet(path).select("k", "v", "p")) == [
            ("a", 1, "x"), ("b", 20, "y"), ("c", 3, "z"), ("d", 4, "w"),
        ]
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "p=z").iterdir()}
    assert before == after


def test_partition_upsert_opens_only_partitions_that_may_hold_a_key(spark, tmp_path, rows_of):
    path, schema = str(tmp_path / "t"), "k long, v int, p int, q string"
    stored = [(100 * d + 7 * i, 0, d, "x" if d % 2 else None) for d in range(12) for i in range(10)]
    first = spark.createDataFrame(stored, schema)
    assert warehouse.upsert_partitions(path, first, "k", ["p", "q"]) == {"looked": 0, "rewritten": 0}
    change = [(307, 1, 3, "x"), (707, 1, 0, None), (5001, 1, 12, "new")]  # known, known elsewhere, unknown

    def upserted(rows):
        spark.catalog.refreshByPath(path)
        return warehouse.upsert_partitions(path, spark.createDataFrame(rows, schema), "k", ["p", "q"])

    # 307 lies in p=3 and 707 in p=7; p=0 and p=12 are rewritten as named by the increment
    assert upserted(change) == {"looked": 2, "rewritten": 4}
    spark.catalog.refreshByPath(path)
    got = {r["k"]: (r["v"], r["p"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 121 and spark.read.parquet(path).count() == 121
    assert (got[307], got[707], got[5001], got[7]) == ((1, 3), (1, 7), (1, 12), (0, 0))
    # keys inside the range of partitions that lack them: the filters say so
    assert upserted([(501, 1, 5, "x"), (502, 1, 5, "x")])["looked"] == 0
    # a partition that others have written to is opened, whatever its summary says
    spark.createDataFrame([(90_000, 0)], "k long, v int").write.mode("append").parquet(f"{path}/p=9/q=x")
    assert upserted([(90_000, 5, 1, "x")])["looked"] == 1
    spark.catalog.refreshByPath(path)
    assert spark.read.parquet(path).where("k = 90000").select("v", "p").collect() == [(5, 9)]


def test_key_summaries_never_miss(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr("uuid() AS k", "CAST(id % 9 AS INT) AS p").union(
        spark.sql("SELECT CAST(NULL AS STRING), 100")
    )
    rows.write.partitionBy("p").parquet(path)
    key_summary.summarise_keys(spark, path, "k", ["p"])
    base = spark.read.parquet(path)
    for p in (0, 8):
        held = key_summary.may_hold(path, base.where(f"p = {p}").select("k"), "k", ["p"])
        assert p in {r["p"] for r in held.collect()}
    strangers = spark.range(100).selectExpr("uuid() AS k")
    assert key_summary.may_hold(path, strangers, "k", ["p"]).count() <= 2
    nobody = key_summary.may_hold(path, base.where("k IS NULL").select("k"), "k", ["p"])
    assert nobody.count() == 0


def rows_dealt_by_pid(node):
    """Rows that each shuffle by pid alone has written, in a plan that has run."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return rows_dealt_by_pid(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return rows_dealt_by_pid(node.plan())
    below = node.children()
    rows = [n for i in range(below.size()) for n in rows_dealt_by_pid(below.apply(i))]
    if kind == "ShuffleExchangeExec" and re.match(r"hashpartitioning\(pid#\d+, \d+\)", node.outputPartitioning().toString()):
        rows.append(node.metrics().apply("shuffleRecordsWritten").value())
    return rows


def test_keys_of_one_partition_do_not_meet_in_one_task(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path / "t"), []
    frame = type(spark.range(1))
    hint = frame.hint
    spark.range(5_000).selectExpr("md5(string(id)) AS k", "int(id % 2) AS p").write.partitionBy("p").parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # at size no side is small enough
    try:
        with monkeypatch.context() as m:
            m.setattr(frame, "hint", lambda df, *args: written.append(df) or hint(df, *args))
            key_summary.summarise_keys(spark, path, "k", ["p"])
        held = key_summary.may_hold(path, spark.read.parquet(path).where("p = 1").select("k"), "k", ["p"])
        bits = next(df for df in written if "bits" in df.columns)
        assert bits.agg(F.count("*"), F.max("level")).first() == (spark.read.parquet(f"{path}/_key_summary/bits").count(), 11)
        assert [r["p"] for r in held.collect()] == [1]
        bits.collect()
        most = [max(rows_dealt_by_pid(df._jdf.queryExecution().executedPlan()), default=0) for df in (bits, held)]
        assert max(most) < 50, most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")


def raw_call(n, when, geo="48453001012.0", category="Theft"):
    row = {f.name: None for f in schemas.RAW_CALLS}
    row |= dict(incident_number=n, response_datetime=when, geo_id=geo, priority_level="Priority 1",
                response_time=60.0, final_problem_category=category)
    return tuple(row.values())


def geo_rows(spark):
    return spark.createDataFrame([("048453001012", 30.0, -97.0, 1.0)], schemas.DIM_GEO)


def test_stream_loads_only_new_files(spark, tmp_path):
    landing, table, mark = (str(tmp_path / n) for n in ("in", "fact", "mark"))
    geo = geo_rows(spark)

    def land(rows):
        df = spark.createDataFrame(rows, schemas.RAW_CALLS)
        df.write.mode("append").option("header", True).csv(landing)

    def load():
        query = incremental.load_stream(
            incremental.landed_calls(spark, landing), geo, table, mark
        )
        query.awaitTermination()
        return query

    land([raw_call("a", "2024-01-02 03:04:05"), raw_call("b", "2024-02-02 03:04:05")])
    load()
    land([raw_call("b", "2024-03-02 03:04:05"), raw_call("c", "2024-02-03 00:00:00", geo="9")])
    load()
    got = {r["incident_number"]: r for r in spark.read.parquet(table).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["b"]["response_month"] == "2024-02"
    assert got["b"]["latitude_centroid"] == 30.0
    assert (got["c"]["geo_id"], got["c"]["latitude_centroid"]) == (None, None)
    files = spark.read.parquet(table).inputFiles()
    load()
    assert sorted(spark.read.parquet(table).inputFiles()) == sorted(files)


def test_daily_pipeline_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    calls = [raw_call(str(i), f"2024-01-02 0{i}:00:00") for i in range(5)]
    spark.createDataFrame(calls, schemas.RAW_CALLS).write.option("header", True).csv(
        str(raw / "calls.csv")
    )
    event = {f.name: None for f in schemas.RAW_EVENTS}
    event |= dict(folderrsn=1, foldername="Fair", start_date="Jan 01, 2024",
                  end_date="Jan 03, 2024", gpslatitude="30.001", gpslongitude="-97.0",
                  alcohol_served="Yes")
    spark.createDataFrame([tuple(event.values())], schemas.RAW_EVENTS).write.option(
        "header", True
    ).csv(str(raw / "events.csv"))
    spark.createDataFrame(
        [("48453001012", "453", "+30.0", "-97.0", 1000000)], schemas.RAW_BLOCK_GROUPS
    ).write.option("header", True).csv(str(raw / "bg.csv"))
    hours = [f"2024-01-0{1 + i // 24}T{i % 24:02}:00" for i in range(48)]
    hourly = {"time": hours, "temperature_2m": [10.0] * 48, "relative_humidity_2m": [50] * 48, "precipitation": [0.5] * 48,
              "rain": [0.5] * 48, "weather_code": [61] * 48, "wind_speed_10m": [5.0] * 48, "wind_gusts_10m": [9.0] * 48}
    (raw / "weather.json").write_text(json.dumps({"hourly": hourly}))
    venue = {f.name: None for f in schemas.RAW_VENUES}
    rows = [venue | {"id": "v1", "name": "Hall", "latitude": 30.0, "longitude": -97.0}, venue | {"id": "v2", "name": "Nowhere"}]
    fields = [tuple(r[f.name] for f in schemas.RAW_VENUES) for r in rows]
    spark.createDataFrame(fields, schemas.RAW_VENUES).write.option("header", True).csv(str(raw / "venues.csv"))
    paths = pipeline.Paths(
        str(raw / "calls.csv"), str(raw / "events.csv"), str(raw / "bg.csv"), str(tmp_path / "wh"),
        str(raw / "weather.json"), str(raw / "venues.csv"),
    )
    for _ in range(2):
        pipeline.run_daily(spark, paths, "2024-01-05")
    assert spark.read.parquet(paths.table("fact_festival_incidents")).count() == 5
    (score,) = spark.read.parquet(paths.table("risk_scores")).collect()
    assert (score["incident_count"], score["risk_score"]) == (5, 5 * 0.5 + 30 + 10)
    assert spark.read.parquet(paths.table("pipeline_runs")).count() == 2
    assert spark.read.parquet(paths.table("dim_weather")).count() == 48
    days = spark.read.parquet(paths.table("dim_weather_daily")).collect()
    assert sorted((r["temp_avg_f"], r["precipitation_total_mm"], r["had_rain"]) for r in days) == [(50.0, 12.0, True)] * 2
    (hall,) = spark.read.parquet(paths.table("dim_venue")).collect()
    assert (hall["venue_id"], hall["primary_category"]) == ("v1", "Unknown")
    fresh = warehouse.stored_freshness(spark, paths.table("fact_calls")).first()
    assert fresh["db_count"] == 5 and abs(fresh["last_load"] - dt.datetime.now()) < dt.timedelta(days=1)
    report = spark.read.text(paths.table("reports/2024-01-05")).first()[0]
    document = json.loads(report)
    assert document["database_stats"]["total_911_calls"] == 5
    assert document["data_processing"]["call_records"] == 5
    assert document["data_processing"]["event_records"] == 1
    models = document["ml_models"]
    assert models["association_rules"] == {"status": "SKIPPED"}
    assert models["clustering"]["status"] == models["forecasting"]["status"] == "SKIPPED"
    (alert,) = spark.read.parquet(paths.table("alerts/2024-01-05")).where("type = 'LOW_VOLUME'").collect()
    assert "5" in alert["message"]


def test_models_of_the_daily_run(spark, tmp_path, ts):
    start = ts("2024-01-01T05:00:00")
    rows = [
        (
            str(i), start + dt.timedelta(days=i % 90, hours=i % 7), (start + dt.timedelta(days=i % 90)).date(), 5 + i % 7,
            "Mon", "Priority 1", i % 3, "Theft" if i % 7 < 3 else "Fire", 30.0 + (i % 15) / 100, -97.0 - (i % 15) / 100, 1.0,
        )
        for i in range(400)
    ]
    calls = spark.createDataFrame(
        rows,
        "incident_number string, response_datetime timestamp_ntz, response_date date, response_hour int, "
        "response_day_of_week string, priority_level string, priority_numeric int, final_problem_category string, "
        "latitude_centroid double, longitude_centroid double, response_time double",
    )
    paths = pipeline.Paths("", "", "", str(tmp_path))
    assert pipeline.run_models(calls, paths)[0] is None  # 400 calls are too few for rules
    assert pipeline.run_models(calls, paths, pipeline.Gates(zone_calls=401, forecast_days=91)) == (None, None, None)
    rules, places, forecast = pipeline.run_models(calls, paths, pipeline.Gates(rule_calls=400))
    assert rules == spark.read.parquet(paths.table("association_rules")).count() > 0
    assert places == spark.read.parquet(paths.table("zone_levels")).count() == 15
    week = [r["predicted_calls"] for r in spark.read.parquet(paths.table("forecast_7d")).collect()]
    assert len(week) == 7 and forecast == sum(week) / 7


def test_sinks_round_trip(spark, tmp_path, ts, rows_of):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "geo_id string, n int")
    for suffix in ("csv", "json", "parquet"):
        sinks.write_by_suffix(df, str(tmp_path / f"x.{suffix}"))
    schema = schemas.struct("geo_id string, n int")
    assert rows_of(readers.read_table(spark, str(tmp_path / "x.csv"), schema)) == rows_of(df)
    assert rows_of(spark.read.schema(schema).json(str(tmp_path / "x.json"))) == rows_of(df)
    with pytest.raises(ValueError, match="schema"):
        readers.read_table(spark, str(tmp_path / "x.csv"))

    dated = str(tmp_path / "dated")
    sinks.write_snapshot(df, dated, "2024-01-01")
    sinks.write_snapshot(df, dated, "2024-01-02")
    sinks.write_snapshot(df.limit(1), dated, "2024-01-02")
    days = spark.read.parquet(dated).groupBy("run_date").count().collect()
    assert {str(r["run_date"]): r["count"] for r in days} == {"2024-01-01": 2, "2024-01-02": 1}

    log = str(tmp_path / "log")
    for n in (1, 2):
        sinks.append_run_log(spark, log, "daily", "SUCCESS", n, ts("2024-01-01"))
    assert spark.read.parquet(log).count() == 2
    calls = spark.createDataFrame(
        [(str(i), 2024, "2024-01") for i in range(20)],
        "incident_number string, response_year int, response_month string",
    )
    sinks.write_calls(calls, str(tmp_path / "calls"))
    stored = spark.read.parquet(str(tmp_path / "calls"))
    assert stored.where("response_month = '2024-01'").count() == 20


def test_leading_zeros_survive_csv(spark, tmp_path):
    path = str(tmp_path / "geo.csv")
    sinks.write_table(geo_rows(spark), path, "csv")
    assert readers.read_geo_lookup(spark, path).first()["geo_id"] == "048453001012"


def test_first_available_and_chunks(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(one)
    spark.createDataFrame([(2,)], "x int").write.parquet(two)
    got = readers.first_available(spark, [str(tmp_path / "none"), two, one])
    assert got.columns == ["x"]
    with pytest.raises(FileNotFoundError):
        readers.first_available(spark, [str(tmp_path / "none")])
    chunks = readers.read_chunks(spark, [one, two])
    assert {(r["x"], r["y"]) for r in chunks.collect()} == {(1, "a"), (2, None)}
    union = readers.union_chunks([spark.read.parquet(two), spark.read.parquet(one)])
    assert union.count() == 2


def test_json_sources(spark, tmp_path):
    weather = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                          "temperature_2m": [1.5, None], "relative_humidity_2m": [50, 60],
                          "precipitation": [0.0, 0.2], "rain": [0.0, 0.2], "weather_code": [0, 61],
                          "wind_speed_10m": [1, 2], "wind_gusts_10m": [3, 4]}}
    (tmp_path / "w.json").write_text(json.dumps(weather, indent=1))
    rows = readers.read_weather_json(spark, str(tmp_path / "w.json")).orderBy("datetime").collect()
    assert rows[0]["datetime"] == dt.datetime(2024, 1, 1)
    assert (rows[1]["temperature_c"], rows[1]["weather_code"]) == (None, 61)

    results = {"last_updated": "x", "tournament": "t",
               "matches": [{"match_id": 1, "date": "21/12/2025", "time": "21:00", "team1": "A",
                            "team2": "B", "score": None, "status": "À venir", "scorers": ["s 1'"],
                            "stadium": "S", "attendance": None}],
               "standings": {"G": [{"team": "A", "played": 0, "won": 0, "drawn": 0, "lost": 0,
                                    "gf": 0, "ga": 0, "gd": 0, "points": 0}]}}
    (tmp_path / "r.json").write_text(json.dumps(results, indent=1, ensure_ascii=False))
    documents = readers.read_results_json(spark, str(tmp_path / "r.json"))
    match = readers.match_results(documents).first()
    assert match["kickoff"] == dt.datetime(2025, 12, 21, 21)
    assert match["score"] is None and match["scorers"] == ["s 1'"]
    table = readers.stored_standings(documents).first()
    assert (table["group_name"], table["team"], table["points"]) == ("G", "A", 0)


def test_call_date_range(spark, ts):
    calls = spark.createDataFrame([(ts("2023-05-01"),), (ts("2025-02-01"),)],
                                  "response_datetime timestamp_ntz")
    default = ("2023-01-01", "2025-12-31")
    row = readers.call_date_range(calls, default, last_year=2024).first()
    assert (row["start_year"], row["end_year"]) == (2023, 2024)
    empty = readers.call_date_range(calls.limit(0), default).first()
    assert (empty["start_year"], empty["end_year"]) == (2023, 2025)


def test_run_log_row(spark):
    row = reports.run_log_row(spark.range(3), "daily", "SUCCESS", "2024-01-01").first()
    assert (row["records_processed"], row["run_date"]) == (3, dt.datetime(2024, 1, 1))
