import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsewatch.functions import tails
from pulsewatch.operators import analysis, stats


def flagged(spark, yes, no):
    rows = [(True, v) for v in yes] + [(False, v) for v in no]
    return spark.createDataFrame(rows, "g boolean, v double")


def test_student_tail_matches_tables():
    # two-sided critical values of Student's t
    assert tails.student_p(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert tails.student_p(12.706, 1) == pytest.approx(0.05, abs=1e-5)
    assert tails.student_p(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)
    assert tails.student_p(0.0, 5) == pytest.approx(1.0)
    assert tails.student_p(float("inf"), 5) == 0.0
    assert tails.student_p(None, 5) is None


def test_rank_sum_tail():
    assert tails.exact_rank_sum_p(3, 4, 5) == pytest.approx(14 / 126)
    assert tails.exact_rank_sum_p(0, 3, 3) == pytest.approx(2 / 20)
    assert tails.rank_sum_p(12.5, 5, 5, 6.0) == pytest.approx(1.0)
    assert tails.rank_sum_p(0, 0, 5, 0) is None


def test_t_test_pooled(spark):
    yes, no = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    row = stats.t_test(flagged(spark, yes, no), "g", "v").first()
    pooled = (3 * statistics.variance(yes) + 2 * statistics.variance(no)) / 5
    t = (2.5 - 4.0) / math.sqrt(pooled * (1 / 4 + 1 / 3))
    assert row["t_statistic"] == pytest.approx(t)
    assert row["degrees_of_freedom"] == 5
    assert row["p_value"] == pytest.approx(tails.student_p(t, 5))


def test_t_test_gate(spark):
    row = stats.t_test(flagged(spark, [1.0], [2.0, 3.0]), "g", "v").first()
    assert row["t_statistic"] is None and row["p_value"] is None and row["stars"] == ""


@pytest.mark.parametrize("seed", [1, 2])
def test_u_equals_pairwise_count(spark, seed):
    rnd = random.Random(seed)
    yes = [float(rnd.randrange(12)) for _ in range(40)]
    no = [float(rnd.randrange(15)) for _ in range(60)]
    row = stats.mann_whitney(flagged(spark, yes, no), "g", "v").first()
    wins = sum((a > b) + 0.5 * (a == b) for a in yes for b in no)
    assert row["u_statistic"] == wins
    ties = sum(c**3 - c for c in np.unique(yes + no, return_counts=True)[1])
    assert row["tie_sum"] == ties
    assert 0 < row["p_value"] <= 1


def test_quantiles_equal_numpy(spark):
    rnd = random.Random(5)
    rows = [("a", rnd.choice([rnd.gauss(0, 1), 0.25])) for _ in range(700)]
    rows += [("b", 3.0), ("b", 5.0), ("c", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {
        r["k"]: r
        for r in stats.distribution(df, ["k"], "v", {"q1": 0.25, "q2": 0.5, "q9": 0.99}).collect()
    }
    values = [v for k, v in rows if k == "a"]
    assert got["a"]["n_values"] == 700
    assert got["a"]["mean"] == pytest.approx(np.mean(values))
    assert got["a"]["std"] == pytest.approx(np.std(values, ddof=1))
    for name, p in (("q1", 25), ("q2", 50), ("q9", 99)):
        assert got["a"][name] == pytest.approx(np.percentile(values, p))
    assert (got["b"]["q2"], got["b"]["q1"]) == (4.0, 3.5)
    assert (got["c"]["n_values"], got["c"]["q2"], got["c"]["std"]) == (0, None, None)
    assert None not in got


def test_quantiles_without_keys(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("v"))
    row = stats.distribution(df, [], "v", {"median": 0.5}).first()
    assert (row["n_values"], row["mean"], row["median"], row["min"]) == (101, 51.0, 51.0, 1.0)


def test_running_totals_over_many_ranges(spark):
    counts = spark.range(500).select(F.col("id").alias("v"), (F.col("id") % 3 + 1).alias("n"))
    got = stats.running_totals(counts, [], "v", ["n"], parts=16).orderBy("v").collect()
    below = 0
    for r in got:
        assert r["n_below"] == below
        below += r["n"]
    assert all(r["n_all"] == below for r in got)


def test_pearson_gate_and_value(spark):
    rnd = random.Random(3)
    xs = [rnd.gauss(0, 1) for _ in range(50)]
    rows = [(x, x + rnd.gauss(0, 1), None if i > 9 else x) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = stats.pearson(df, {"xy": ("x", "y"), "xz": ("x", "z")}).collect()
    assert [r["variable"] for r in got] == ["xy"]
    r = np.corrcoef([a for a, _, _ in rows], [b for _, b, _ in rows])[0, 1]
    assert got[0]["r"] == pytest.approx(r)
    t = r * math.sqrt(48 / (1 - r * r))
    assert got[0]["p_value"] == pytest.approx(tails.student_p(t, 48))
    assert got[0]["stars"] == "***"


def test_describe(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (4, 40.0)], "a int, b double")
    got = {r["column_name"]: r for r in stats.describe(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["p50"], got["a"]["p25"]) == (4, 2.5, 1.75)
    assert (got["b"]["count"], got["b"]["p50"], got["b"]["max"]) == (3, 20.0, 40.0)


def test_null_profile_and_histogram(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {r["column_name"]: (r["null_count"], r["null_pct"])
           for r in analysis.null_profile(df).collect()}
    assert got == {"a": (0, 0.0), "b": (1, 50.0)}
    forecast = spark.createDataFrame([(float(i), 0.0) for i in range(31)],
                                     "actual double, predicted double")
    bins = {r["bin"]: r["days"] for r in analysis.residual_histogram(forecast, 30).collect()}
    assert sum(bins.values()) == 31 and bins[29] == 2
    flat = spark.createDataFrame([(1.0, 1.0)] * 3, "actual double, predicted double")
    assert [tuple(r) for r in analysis.residual_histogram(flat).collect()] == [(0, 3)]


def test_alcohol_summary_rounds_half_even(spark):
    summary = spark.createDataFrame(
        [(1, 4, 1.0, 0.5, True), (2, 6, 2.0, 0.7, True), (3, 3, 1.5, 0.2, False)],
        "event_id long, incident_count long, avg_priority double, avg_distance_km double, "
        "has_alcohol boolean",
    )
    rows = {r["metric"]: r for r in analysis.alcohol_summary(summary).collect()}
    assert rows["Total Incidents"]["difference"] == 7.0
    assert rows["Median Incidents"]["with_alcohol"] == 5.0
    assert rows["Total Incidents"]["pct_difference"] == 233.3
    assert analysis.alcohol_average_gap(summary).first()[0] == 2.0


def test_response_summary_cuts_outliers(spark):
    rows = [("a", True, 10.0), ("b", True, 30.0), ("c", True, 7200.0), ("d", False, None),
            ("e", False, 60.0)]
    df = spark.createDataFrame(
        rows, "incident_number string, is_festival_related boolean, response_time double"
    )
    got = {r["metric"]: (r["festival"], r["non_festival"])
           for r in analysis.response_summary(df).collect()}
    assert got["Count"] == (2.0, 1.0)
    assert got["Mean (sec)"] == (20.0, 60.0)
    assert got["Median (min)"] == (20 / 60, 1.0)
    assert got["Std Dev"][1] is None


def test_brackets_of_narrow_wide_and_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(stats, "ACCURACY", 500)
    rnd = random.Random(11)
    rows = [("narrow", 7 + rnd.random() * 1e-9) for _ in range(4000)]
    rows += [("wide", rnd.lognormvariate(0, 8)) for _ in range(4000)]
    rows += [("tied", float(rnd.choice([1, 1, 1, 2, 5]))) for _ in range(4000)]
    rows += [("few", float(i)) for i in range(5)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    probs = {"low": 0.0, "q1": 0.25, "q5": 0.5, "q999": 0.999, "high": 1.0}
    got = {r["k"]: r for r in stats.distribution(df, ["k"], "v", probs, margin=0.006).collect()}
    for key in ("narrow", "wide", "tied", "few"):
        values = [v for k, v in rows if k == key]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert got["none"]["q5"] is None and got["none"]["n_values"] == 0
    values = [v for k, v in rows if k == "wide"]
    alone = stats.distribution(df.where("k = 'wide'"), [], "v", probs, margin=0.006).first()
    assert [alone[n] for n in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()], rel=1e-12)


def test_brackets_that_miss_are_ranked_whole(spark, monkeypatch):
    monkeypatch.setattr(stats, "ACCURACY", 3)  # a sketch far too coarse for its margin
    rows = [(k, float((i * 7919) % 3001)) for k in ("a", "b") for i in range(3001)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for r in stats.distribution(df, ["k"], "v", {"q3": 0.3, "q7": 0.7}, margin=0.001).collect():
        assert (r["q3"], r["q7"]) == (900.0, 2100.0)


def test_only_the_rows_in_brackets_are_ranked(spark, monkeypatch):
    seen = []
    ranked = stats._ranked

    def spy(rows, keys, summary, probs):
        seen.append(summary.select("_brackets").collect())
        return ranked(rows, keys, summary, probs)

    monkeypatch.setattr(stats, "_ranked", spy)
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    row = stats.distribution(df, [], "v", {"m": 0.5}).first()
    assert row["m"] == pytest.approx(np.median([(i * 7919) % 200_003 for i in range(200_000)]))
    ((bracket,),) = seen[0][0]
    assert len(seen) == 1 and bracket["high"] - bracket["low"] < 400


def test_rank_sum_tail_of_a_tiny_and_a_large_sample():
    few = [tails.exact_rank_sum_p(u, 5, 3000) for u in (100, 3000, 7000)]
    assert few == pytest.approx([tails.uniform_sum_p(u, 5, 3000) for u in (100, 3000, 7000)], rel=0.02, abs=1e-6)
    assert tails.rank_sum_p(10**7, 4, 10**7, 0) == pytest.approx(2 / 24, rel=1e-4)
    assert tails.rank_sum_p(0, 8, 40_000, 0) < 1e-30
