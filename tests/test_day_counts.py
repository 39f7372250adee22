"""Counts a day and place: merged results against the aggregates over all calls."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsewatch.operators import day_counts, reports, risk, warehouse
from pulsewatch.plans.pipeline import PARTITIONS, partitioned

SCHEMA = """incident_number string, response_datetime timestamp_ntz, latitude_centroid double,
longitude_centroid double, priority_numeric int"""


def call(key, day, place=1, priority=2):
    when = None if day is None else dt.datetime(2024, 1, 1, 23, 30) + dt.timedelta(days=day)
    at = (None, None) if place is None else (30.0 + place, -97.0 - place)
    return (key, when, *at, priority)


@pytest.fixture
def loaded(spark, tmp_path):
    calls, counts = str(tmp_path / "calls"), str(tmp_path / "counts")

    def load(rows):
        warehouse.upsert_partitions(
            calls, partitioned(spark.createDataFrame(rows, SCHEMA)), "incident_number", PARTITIONS,
            after=lambda touched: day_counts.recount(spark, calls, counts, PARTITIONS, touched),
        )
        return spark.read.parquet(calls), spark.read.parquet(counts)

    return load


def check(rows_of, calls, counts, events, month="response_month"):
    for days in (0, 30, 400):
        merged = day_counts.rolling_heatmap(counts, days, high=3, medium=1, month=month)
        full = risk.risk_heatmap(calls, days, high=3, medium=1)
        assert rows_of(merged.select(full.columns)) == rows_of(full)
    merged = day_counts.zone_heatmap(counts, high=3, medium=1)
    full = risk.zone_heatmap(calls, high=3, medium=1)
    assert rows_of(merged.select(full.columns)) == rows_of(full)
    assert rows_of(day_counts.db_stats(counts, events, events)) == rows_of(reports.db_stats(calls, events, events))


def test_counts_follow_late_moved_and_repeated_calls(spark, loaded, rows_of):
    events = spark.range(3)
    first = [call(f"a{i}", i * 7, i % 3, i % 4) for i in range(30)] + [call("n", None), call("p", 5, None)]
    check(rows_of, *loaded(first), events)
    late = [call("late1", 0, 2), call("late2", -40, 0, None), call("late3", 200, 1)]
    check(rows_of, *loaded(late), events)
    check(rows_of, *loaded([call("a3", 21, 9), call("n", None, 4)]), events)
    # a stored row stays in its partition whatever its new day, so months do not prune here
    calls, counts = loaded([call("a4", 400, 5)])
    check(rows_of, calls, counts, events, month=None)
    assert counts.agg(F.sum("n_calls")).first()[0] == calls.count() == 35
    before = rows_of(counts)
    assert rows_of(loaded(late)[1]) == before


def test_only_touched_partitions_are_recounted(loaded):
    loaded([call("a", 0), call("b", 40), call("c", 80)])
    _, counts = loaded([call("d", 0)])
    files = set(counts.inputFiles())
    _, counts = loaded([call("e", 41), call("a", 0, 7)])
    kept = {f.split("response_month=")[1][:7] for f in files & set(counts.inputFiles())}
    assert kept == {"2024-03"}


def test_counts_of_an_existing_table_are_built_whole(spark, tmp_path):
    calls, counts = str(tmp_path / "calls"), str(tmp_path / "counts")
    rows = partitioned(spark.createDataFrame([call("a", 0), call("b", 40)], SCHEMA))
    rows.write.partitionBy(*PARTITIONS).parquet(calls)
    day_counts.recount(spark, calls, counts, PARTITIONS, F.col("response_month") == "2024-01")
    assert spark.read.parquet(counts).agg(F.sum("n_calls")).first()[0] == 2


def test_a_window_opens_its_months_only(loaded):
    _, counts = loaded([call(str(i), i * 31) for i in range(12)])
    merged = day_counts.rolling_heatmap(counts, 30, month="response_month")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(response_month" in plan
    assert merged.collect()[0]["incident_count"] == 1


def test_no_calls_and_no_priorities(spark, rows_of):
    none = day_counts.count_days(spark.createDataFrame([], SCHEMA))
    assert rows_of(day_counts.rolling_heatmap(none)) == rows_of(day_counts.zone_heatmap(none)) == []
    assert rows_of(day_counts.db_stats(none, spark.range(0), spark.range(0))) == [(0, 0, 0, 0)]
    blank = day_counts.count_days(spark.createDataFrame([call("a", 0, 1, None)], SCHEMA))
    assert [r["avg_priority"] for r in day_counts.rolling_heatmap(blank).collect()] == [None]
