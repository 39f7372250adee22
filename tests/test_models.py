import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from pulsewatch.operators import evaluation, knn, priority, sampling, zones


def points(spark, n, seed, dims=3, levels=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        xs = [
            float(rnd.randrange(levels)) if levels else rnd.gauss(rnd.choice([0, 6]), 1)
            for _ in range(dims)
        ]
        rows.append((f"k{seed}-{i:04d}", rnd.choice("abc"), *xs, 1.0))
    names = ", ".join(f"f{d} double" for d in range(dims))
    return rows, spark.createDataFrame(rows, f"key string, label string, {names}, flat double")


def brute_neighbours(train, test, k, dims):
    x = np.array([r[2 : 2 + dims] for r in train])
    spread = x.std(axis=0)
    out = {}
    for r in test:
        v = np.array(r[2 : 2 + dims])
        d2 = (((x - v) / spread) ** 2).sum(axis=1)
        order = sorted(range(len(train)), key=lambda i: (round(d2[i], 9), train[i][0]))[:k]
        out[r[0]] = [train[i][1] for i in order]
    return out


@pytest.mark.parametrize(("levels", "pivots"), [(None, 8), (None, 200), (3, 8)])
def test_knn_equals_brute_force(spark, levels, pivots):
    dims, ks = 3, (1, 3, 5)
    columns = [f"f{d}" for d in range(dims)] + ["flat"]
    train, train_df = points(spark, 300, 1, dims, levels)
    test, test_df = points(spark, 80, 2, dims, levels)
    expected = brute_neighbours(train, test, max(ks), dims)

    def vote(labels):
        return min(set(labels), key=lambda c: (-labels.count(c), c))

    wanted = {k: {key: vote(v[:k]) for key, v in expected.items()} for k in ks}
    accuracy = {k: np.mean([wanted[k][r[0]] == r[1] for r in test]) for k in ks}
    best = max(ks, key=lambda k: (accuracy[k], -k))
    predicted, per_k = knn.knn_classify(
        train_df.repartition(5), test_df, columns, "label", "key", ks, pivots
    )
    assert {r["k"]: r["accuracy"] for r in per_k.collect()} == pytest.approx(accuracy)
    got = predicted.collect()
    assert {r["k"] for r in got} == {best}
    assert {r["key"]: r["prediction"] for r in got} == wanted[best]
    assert len(got) == len(test)


def test_knn_with_split_cells_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_SPLIT", 7)
    train, train_df = points(spark, 120, 1)
    test, test_df = points(spark, 30, 2)
    columns = ["f0", "f1", "f2"]
    expected = brute_neighbours(train, test, 4, 3)
    found, xs = knn.neighbours(train_df, test_df, columns, "label", "key", 4, pivots=5)
    assert found.groupBy(*xs).count().where("count <> 4").count() == 0
    assert found.count() == 4 * len(test)
    total = found.groupBy("label").count().collect()
    flat = [c for v in expected.values() for c in v]
    assert {r["label"]: r["count"] for r in total} == {c: flat.count(c) for c in set(flat)}
    # fewer training rows than neighbours wanted: all of them are neighbours
    few, _ = knn.neighbours(train_df.limit(3), test_df, columns, "label", "key", 5, pivots=5)
    assert few.count() == 3 * len(test)


def test_top_categories(spark):
    df = spark.createDataFrame(
        [(i, c) for i, c in enumerate(["a"] * 3 + ["b"] * 2 + ["c"] * 2 + [None] * 4)],
        "i int, c string",
    )
    got = {(r["c"], r["o"]) for r in knn.top_categories(df, "c", 3, "o").collect()}
    assert got == {("a", "a"), ("b", "b"), ("c", "Other"), (None, "Unknown")}


def test_stratified_split_shares_and_repeats(spark):
    df = spark.range(1000).select(
        F.col("id").alias("k"), F.when(F.col("id") < 900, "big").otherwise("small").alias("c")
    )
    one = sampling.stratified_split(df, "c", "k")
    counts = {r["c"]: r["n"] for r in one.groupBy("c")
              .agg(F.count_if("is_train").alias("n")).collect()}
    assert counts == {"big": 720, "small": 80}
    two = sampling.stratified_split(df.repartition(9), "c", "k")
    assert {r["k"] for r in one.where("is_train").collect()} == {
        r["k"] for r in two.where("is_train").collect()
    }


def test_classification_report(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    got = {r["class_name"]: r for r in evaluation.classification_report(df).collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["support"]) == (0.5, 0.5, 2)
    assert got["b"]["f1_score"] == pytest.approx(0.8)
    assert (got["c"]["precision"], got["c"]["f1_score"]) == (0.0, 0.0)
    assert got["accuracy"]["f1_score"] == pytest.approx(0.6)
    assert got["macro avg"]["recall"] == pytest.approx(0.5)
    assert got["weighted avg"]["support"] == 5


def places(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(60):
        group = i % 3
        rows.append((30 + group + rnd.uniform(0, 0.1), -97.0 - group, 10 * (group + 1),
                     float(group), 1.0 + group, float(group + 2)))
    return spark.createDataFrame(
        rows,
        "latitude double, longitude double, incident_count long, avg_priority double, "
        "log_incidents double, location_risk double",
    )


def test_cluster_search_finds_the_groups(spark):
    clustered = zones.cluster_zones(places(spark), ks=range(2, 5), restarts=2)
    stats = zones.cluster_stats(clustered).orderBy("avg_risk").collect()
    assert [s["avg_risk"] for s in stats] == [2.0, 3.0, 4.0]
    labels = {r["location_risk"]: r["risk_zone"] for r in clustered.collect()}
    assert labels == {2.0: "LOW_RISK", 3.0: "MEDIUM_RISK", 4.0: "HIGH_RISK"}


def test_levels_by_rank(spark):
    levels = zones.cluster_levels(places(spark), restarts=2)
    got = {r["location_risk"]: r["risk_level"] for r in levels.collect()}
    assert got == {4.0: "HIGH", 3.0: "MEDIUM", 2.0: "LOW"}


def test_hour_clusters_cover_missing_values(spark):
    rows = [(str(i), 1, 0) for i in range(20)] + [(f"x{i}", 22, 9) for i in range(5)]
    rows += [("n", None, None), ("m", 12, 2)]
    df = spark.createDataFrame(
        rows, "incident_number string, response_hour int, priority_numeric int"
    )
    got = {r["incident_number"]: r["risk_level"] for r in zones.cluster_hours(df, restarts=2).collect()}
    assert len(got) == len(rows)
    assert got["0"] == "HIGH" and got["x0"] == "MEDIUM" and got["n"] == got["m"] == "LOW"


def test_gates(spark):
    assert zones.enough_rows(spark.range(100), 100)
    assert not zones.enough_rows(spark.range(99), 100)
    calls = spark.createDataFrame([(1.0,), (None,), (None,)], "latitude_centroid double")
    assert zones.has_places(calls) and not zones.has_places(calls, 0.5)


def labelled(spark, n=400):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        p = rnd.choice([0, 1, 1, 1, 2, 3])
        rows.append((str(i), f"Priority {p}", p, p * 6 + rnd.randrange(3),
                     rnd.choice(["Mon", "Sun"]), f"cat{p}" if p else None, 30.0 + p, -97.0))
    rows.append(("x", "Priority 9", 9, 1, "Mon", "cat1", 30.0, -97.0))
    return spark.createDataFrame(
        rows,
        "incident_number string, priority_level string, priority_numeric int, response_hour int, "
        "response_day_of_week string, initial_problem_category string, latitude_centroid double, "
        "longitude_centroid double",
    )


def test_priority_forest(spark):
    rows, columns = priority.priority_features(labelled(spark))
    assert rows.count() == 400
    assert columns == ["latitude_centroid", "longitude_centroid", "hour_sin", "hour_cos",
                       "response_hour", "day_num", "is_weekend", "category_encoded"]
    codes = {r["priority_class"]: r["category_encoded"] for r in rows.collect()}
    assert codes == {0: 0, 1: 1, 2: 2, 3: 3}
    balanced = priority.balance(rows, "priority_class")
    sums = [r["w"] for r in balanced.groupBy("priority_class")
            .agg(F.sum("weight").alias("w")).collect()]
    assert sums == pytest.approx([100.0] * 4)
    model = priority.train_priority(rows, columns, trees=5, depth=5)
    predicted = priority.predict(model, rows, "incident_number", "priority_class")
    assert predicted.where("label = prediction").count() > 380
    weights = priority.feature_importance(spark, model, columns).collect()
    assert sum(r["importance"] for r in weights) == pytest.approx(1.0)
    assert [r["importance"] for r in weights] == sorted(
        (r["importance"] for r in weights), reverse=True
    )
    assert priority.cross_validate(rows, columns, folds=2, trees=3, depth=4) > 0.9


def test_validation_grows_one_forest_a_fold_in_several_tasks(spark, monkeypatch):
    rows, columns = priority.priority_features(labelled(spark))
    few = rows.coalesce(1)
    assert priority.dealt(few, 400) is few
    monkeypatch.setattr(priority, "TASK_ROWS", 150)
    spread = priority.dealt(few, 400)
    assert spread.rdd.getNumPartitions() == 3
    assert spread.exceptAll(few).count() == few.exceptAll(spread).count() == 0
    grown, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: grown.append(self.getCacheNodeIds()) or fit(self, df))
    assert priority.cross_validate(few, columns, folds=2, trees=3, depth=4) > 0.9
    assert grown == [True, True]
    monkeypatch.setattr(priority, "NODE_IDS", 1)
    assert priority.kept_nodes(priority.forest_pipeline(columns), 400).getStages()[-1].getCacheNodeIds() is False


def test_small_forest_scores_every_call(spark):
    assert priority.small_forest(labelled(spark)).count() == 401


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i, own in enumerate(labels):
        size = (labels == own).sum()
        if size == 1:
            scores.append(0.0)
            continue
        a = d[i, labels == own].sum() / (size - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


@pytest.mark.parametrize("block", [7, 2048])
def test_silhouettes_equal_brute_force(spark, block):
    rnd = np.random.default_rng(5)
    x = np.concatenate((rnd.normal(0, 1, (40, 3)), rnd.normal(4, 1, (30, 3))))
    x = np.concatenate((x, x[:9], [[50.0, 50, 50]]))  # repeated places, and one alone in its cluster
    two = (x[:, 0] > 2).astype(int)
    four = np.where(x[:, 0] > 40, 3, two + (x[:, 1] > 5))  # cluster 2 may be small
    rows = [(*map(float, v), int(a), int(b), 0) for v, a, b in zip(x, two, four, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, two int, four int, flat int")
    scaled = zones.scale(df, ["a", "b", "c"]).repartition(3)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    got = zones.silhouettes(scaled, {"two": 2, "four": 4, "flat": 3}, block=block)
    assert got["two"] == pytest.approx(brute_silhouette(z, two), abs=1e-9)
    assert got["four"] == pytest.approx(brute_silhouette(z, four), abs=1e-9)
    assert np.isnan(got["flat"])


def test_scale_by_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = sorted(tuple(r["scaled"]) for r in zones.scale(df, ["a", "b"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_search_k_finds_the_clusters_that_are_there(spark):
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.normal(c, 0.2, (25, 2)) for c in (0, 5, 10, 15)])
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double")
    scaled = zones.materialize(zones.scale(df, ["a", "b"]))
    _, scores = zones.search_k(scaled, range(3, 7), restarts=3)
    assert max(scores, key=scores.get) == 4
