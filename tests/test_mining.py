import itertools
import random

import pytest

from pulsewatch.operators import mining


def baskets(spark, lists):
    return spark.createDataFrame(
        [(i, sorted(set(items))) for i, items in enumerate(lists)], "k int, items array<string>"
    )


def brute_itemsets(lists, support):
    counts = {}
    for items in map(lambda x: sorted(set(x)), lists):
        for size in range(1, len(items) + 1):
            for combo in itertools.combinations(items, size):
                counts[combo] = counts.get(combo, 0) + 1
    return {c: n for c, n in counts.items() if n / len(lists) >= support}


def brute_rules(lists, support, metric, threshold):
    sets = {k: n / len(lists) for k, n in brute_itemsets(lists, support).items()}
    rules = {}
    for items, s in sets.items():
        for size in range(1, len(items)):
            for left in itertools.combinations(items, size):
                right = tuple(x for x in items if x not in left)
                conf = s / sets[left]
                lift = conf / sets[right]
                if {"confidence": conf, "lift": lift}[metric] >= threshold:
                    rules[left, right] = (s, conf, lift)
    return rules


@pytest.fixture(scope="module")
def sample():
    rnd = random.Random(11)
    return [
        rnd.sample("abcdefgh", rnd.randrange(1, 6)) + (list("xyz") if rnd.random() < 0.3 else [])
        for _ in range(300)
    ]


@pytest.mark.parametrize("method", ["subsets", "bitmaps", "auto"])
def test_itemsets_equal_brute_force(spark, sample, method):
    found = mining.frequent_itemsets(baskets(spark, sample), 0.05, method=method).collect()
    assert {tuple(r["items"]): r["n"] for r in found} == brute_itemsets(sample, 0.05)
    assert all(r["length"] == len(r["items"]) for r in found)


@pytest.mark.parametrize(("metric", "threshold"), [("confidence", 0.3), ("lift", 1.2)])
def test_rules_equal_brute_force(spark, sample, metric, threshold):
    sets = mining.frequent_itemsets(baskets(spark, sample), 0.05)
    got = mining.association_rules(sets, metric, threshold).collect()
    expected = brute_rules(sample, 0.05, metric, threshold)
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in got} == set(expected)
    for r in got:
        s, conf, lift = expected[tuple(r["antecedents"]), tuple(r["consequents"])]
        assert (r["support"], r["confidence"], r["lift"]) == pytest.approx((s, conf, lift))
    lifts = [r["lift"] for r in got]
    assert lifts == sorted(lifts, reverse=True)
    assert any(len(r["consequents"]) > 1 for r in got)


def test_long_baskets_go_to_fpgrowth(spark):
    lists = [list("abcdefghijklmnop")] * 2 + [["a"]]
    found = mining.frequent_itemsets(baskets(spark, lists), 0.9, retry_support=None).collect()
    assert [tuple(r["items"]) for r in found] == [("a",)]


def test_counted_baskets_mine_like_plain_ones(spark, sample):
    plain = baskets(spark, sample)
    counted = plain.groupBy("items").count().withColumnRenamed("count", "n")
    for method in ("subsets", "bitmaps"):
        found = mining.frequent_itemsets(counted, 0.05, method=method).collect()
        assert {tuple(r["items"]): r["n"] for r in found} == brute_itemsets(sample, 0.05)


def test_counting_first_gives_the_same_baskets(spark):
    rows = [(str(i), i % 24, ["Sat", "Mon", None][i % 3], ["a b", None][i % 2]) for i in range(200)]
    df = spark.createDataFrame(
        rows,
        "incident_number string, response_hour int, response_day_of_week string, "
        "final_problem_category string",
    )
    for variant in ("full", "slots"):
        plain = mining.make_baskets(df, variant).groupBy("items").count().collect()
        counted = mining.count_baskets(df, variant).collect()
        assert {tuple(r["items"]): r["count"] for r in plain} == {
            tuple(r["items"]): r["n"] for r in counted
        }


def test_retry_only_when_nothing_is_frequent(spark):
    lists = [[str(i)] for i in range(10)]
    df = baskets(spark, lists)
    assert mining.frequent_itemsets(df, 0.5, retry_support=0.1).count() == 10
    assert mining.frequent_itemsets(df, 0.5, retry_support=None).count() == 0
    lists = [["x"]] * 6 + [["y"]] * 4
    found = mining.frequent_itemsets(baskets(spark, lists), 0.5, retry_support=0.1).collect()
    assert [tuple(r["items"]) for r in found] == [("x",)]


def test_full_baskets(spark):
    rows = [
        ("a", "Rain", "Hot", 0, "Sat", "Priority 1", "Theft of car", True, True),
        ("b", None, None, 18, "Mon", None, None, False, None),
        ("c", None, None, None, None, "Priority 2", None, False, False),
    ]
    df = spark.createDataFrame(
        rows,
        "incident_number string, weather_category string, temp_category string, "
        "response_hour int, response_day_of_week string, priority_level string, "
        "final_problem_category string, is_festival_related boolean, event_has_alcohol boolean",
    )
    got = {r[0]: r[1] for r in mining.make_baskets(df).collect()}
    assert got == {
        "a": ["Alcohol_Event", "Festival_Related", "Incident_Theft", "Priority_Priority1",
              "Temp_Hot", "Time_Night", "Weather_Rain", "Weekend"],
        "b": ["Time_Evening", "Weekday"],
    }


def test_slot_baskets_drop_hour_zero(spark):
    rows = [("a", 0, "Sat", "x"), ("b", 6, "Sat", "a very long category name"), ("c", 7, None, "x")]
    df = spark.createDataFrame(
        rows,
        "incident_number string, response_hour int, response_day_of_week string, "
        "final_problem_category string",
    )
    got = {r[0]: r[1] for r in mining.make_baskets(df, "slots").collect()}
    assert got == {"b": ["cat_a very long category name", "dow_Sat", "time_Night"]}


def test_rule_filters_and_labels(spark, sample):
    rules = mining.association_rules(mining.frequent_itemsets(baskets(spark, sample), 0.05))
    only = mining.rules_with(rules, "consequents", "a")
    assert all("a" in r["consequents"] for r in only.collect())
    kept = mining.filter_rules(rules, 0.5, 1.1).collect()
    assert all(r["confidence"] >= 0.5 and r["lift"] >= 1.1 for r in kept)
    top = mining.top_rules(rules, 5).collect()
    assert len(top) == 5 and all(" → " in r["rule"] for r in top)


def test_a_basket_of_seventy_items(spark, monkeypatch):
    monkeypatch.setattr(mining, "BLOCK", 16)
    monkeypatch.setattr(mining, "CANDIDATES", 700)
    rnd = random.Random(7)
    names = [f"i{i:02}" for i in range(70)]
    lists = [names] + [rnd.sample(names, rnd.randrange(1, 9)) for _ in range(150)]
    lists += [names[:4] + rnd.sample(names[4:], 3) for _ in range(100)] + [[]]
    found = mining.frequent_itemsets(baskets(spark, lists), 0.02, None).collect()
    got = {tuple(r["items"]): r["n"] for r in found}
    counts = {}
    for items in map(sorted, lists[1:]):
        for size in range(1, len(items) + 1):
            for combo in itertools.combinations(items, size):
                counts[combo] = counts.get(combo, 0) + 1
    # the long basket adds one to each set that another basket has; its other sets are too rare
    expected = {c: n + 1 for c, n in counts.items() if (n + 1) / len(lists) >= 0.02}
    assert got == expected and max(map(len, got)) >= 4


@pytest.mark.parametrize("method", ["subsets", "bitmaps"])
def test_retry_support_applies_if_nothing_is_frequent(spark, sample, method):
    found = mining.frequent_itemsets(baskets(spark, sample), 0.99, 0.1, method).collect()
    assert {tuple(r["items"]): r["n"] for r in found} == brute_itemsets(sample, 0.1)
    assert mining.frequent_itemsets(baskets(spark, sample), 0.99, None, method).collect() == []
    assert mining.frequent_itemsets(baskets(spark, []), 0.01, method=method).collect() == []


def test_counted_baskets_weigh_in_bitmaps(spark):
    counted = spark.createDataFrame([(["a", "b"], 10**12), (["a"], 5), (["a", "b", "c"], 2)], "items array<string>, n long")
    found = mining.frequent_itemsets(counted, 1e-12, None, "bitmaps").collect()
    assert {tuple(r["items"]): r["n"] for r in found} == {
        ("a",): 10**12 + 7, ("b",): 10**12 + 2, ("a", "b"): 10**12 + 2, ("c",): 2, ("a", "c"): 2, ("b", "c"): 2, ("a", "b", "c"): 2
    }
