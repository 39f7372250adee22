"""Clustering of places into risk zones."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.session import at_most, materialize

ZONE_FEATURES = ["latitude", "longitude", "log_incidents", "avg_priority", "location_risk"]


def scale(df: DataFrame, columns: list[str], out: str = "scaled") -> DataFrame:
    """Columns as one vector, each less its mean and over its population deviation.

    A column without spread becomes 0.
    """
    rows = df.na.drop(subset=columns)
    measures = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.avg, F.stddev_pop)]
    row = rows.agg(*measures).first()
    scaled = {
        f"_{c}": (F.col(c) - F.lit(row[f"avg_{c}"])) / F.lit(row[f"stddev_pop_{c}"] or 1.0)
        for c in columns
    }
    vectors = rows.withColumns(scaled)
    assembler = VectorAssembler(inputCols=list(scaled), outputCol=out)
    return assembler.transform(vectors).drop(*scaled)


def best_kmeans(scaled: DataFrame, k: int, seed: int, restarts: int) -> KMeansModel:
    """Model with the lowest cost over several starts."""
    fits = [
        KMeans(k=k, seed=seed + i, featuresCol="scaled", predictionCol="cluster").fit(scaled)
        for i in range(restarts)
    ]
    return min(fits, key=lambda model: model.summary.trainingCost)


def _block_sums(clusters: list[int]):
    """Distances of two blocks' vectors to each other, summed by cluster, for every labelling."""

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        places = [np.array(t["xs"].to_pylist(), float).reshape(t.num_rows, -1) for t in (left, right)]
        members = []
        for t in (left, right):
            labels = np.array(t["labels"].to_pylist(), int).reshape(t.num_rows, -1)
            weight = t["weight"].to_numpy()[:, None]
            one_hot = [(labels[:, [i]] == np.arange(k)) * weight for i, k in enumerate(clusters)]
            members.append(np.concatenate(one_hot, axis=1))
        within = left.num_rows and right.num_rows and left["block"][0] == right["block"][0]
        ids, parts = [], []
        for a, b in ((0, 1),) if within else ((0, 1), (1, 0)):
            table = (left, right)[a]
            for at in range(0, table.num_rows, BLOCK_ROWS):
                x = places[a][at : at + BLOCK_ROWS]
                squares = np.zeros((len(x), len(places[b])))
                for d in range(x.shape[1] if len(places[b]) else 0):
                    squares += (x[:, [d]] - places[b][:, d]) ** 2
                parts.append(np.sqrt(squares) @ members[b])
            ids.append(table["id"].to_numpy())
        flat = np.concatenate(parts) if parts else np.zeros((0, sum(clusters)))
        return pa.table({"id": np.concatenate(ids), "sums": pa.array(list(flat), pa.list_(pa.float64()))})

    return sums


BLOCK_ROWS = 256  # rows of one distance matrix


def _least_other(means: Column, own: Column) -> Column:
    """The least entry but that at ``own``; nulls (empty clusters) do not count."""
    return F.array_min(F.transform(means, lambda m, j: F.when(j != own, m)))


def silhouettes(
    labelled: DataFrame, labels: dict[str, int], features: str = "scaled", block: int = 2048
) -> dict[str, float]:
    """Mean silhouette, on Euclidean distances, of each column of ``labels`` (column: clusters).

    A row's distances to all rows are summed by cluster: those to its own, over the other members,
    give a; the least mean to another cluster gives b; (b - a) / max(a, b) is averaged over rows, and
    is 0 for the only row of a cluster. Equal vectors collapse into one with a weight first (equal
    vectors have equal labels). Vectors are dealt to blocks of about ``block`` by hash and each two
    blocks meet once, for both directions and all labellings together, so a task holds two blocks and
    passes on a few sums a row. The work is the square of the distinct places, as the measure's
    definition has it. Without two clusters in use the silhouette is NaN.
    """
    names = list(labels)
    clusters = [labels[c] for c in names]
    points = labelled.select(vector_to_array(features).alias("xs"), F.array(*names).alias("labels"))
    places = points.groupBy("xs").agg(F.count("*").cast("double").alias("weight"), F.min("labels").alias("labels"))
    places = materialize(places.withColumn("id", F.monotonically_increasing_id()))
    blocks = max(1, -(-places.count() // block))
    dealt = places.withColumn("block", F.pmod(F.hash("xs"), F.lit(blocks)))
    ahead = dealt.withColumn("other", F.explode(F.sequence("block", F.lit(blocks - 1))))
    behind = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), "block")))
    left = ahead.withColumnsRenamed({"block": "one", "other": "two"}).withColumn("block", F.col("one"))
    right = behind.withColumnsRenamed({"block": "two", "other": "one"}).withColumn("block", F.col("two"))
    met = left.groupBy("one", "two").cogroup(right.groupBy("one", "two"))
    parts = met.applyInArrow(_block_sums(clusters), "id long, sums array<double>")
    width = sum(clusters)
    totals = parts.groupBy("id").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    judged = places.join(totals, "id")
    sizes = places.agg(
        *[
            F.array(*[F.sum(F.when(F.get("labels", F.lit(i)) == j, F.col("weight")).otherwise(0.0)) for j in range(k)]).alias(c)
            for i, (c, k) in enumerate(labels.items())
        ]
    ).first()
    scores, start = [], 0
    for i, (c, k) in enumerate(labels.items()):
        own = F.get("labels", F.lit(i))
        counts = F.array(*[F.lit(float(n or 0)) for n in sizes[c]])
        distances = F.slice("sums", start + 1, k)
        start += k
        a = F.get(distances, own) / (F.get(counts, own) - 1)
        b = _least_other(F.zip_with(distances, counts, lambda s, n: F.when(n > 0, s / n)), own)
        one = F.when(F.get(counts, own) <= 1, F.lit(0.0)).when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)).otherwise(0.0)
        used = sum(1 for n in sizes[c] if n)
        mean = F.sum(one * F.col("weight")) / F.sum("weight") if used > 1 else F.lit(float("nan"))
        scores.append(mean.alias(c))
    row = judged.agg(*scores).first()
    return {c: float("nan") if row[c] is None else row[c] for c in names}


def search_k(
    scaled: DataFrame, ks: Iterable[int], seed: int = 42, restarts: int = 10
) -> tuple[KMeansModel, dict[int, float]]:
    """Number of clusters with the best silhouette, the smaller one on a tie.

    All labellings are judged in one pass over the distances.
    """
    models = {k: best_kmeans(scaled, k, seed, restarts) for k in ks}

    def labelled(df: DataFrame, k: int) -> DataFrame:
        return models[k].copy({models[k].predictionCol: f"_{k}"}).transform(df)

    measured = silhouettes(reduce(labelled, models, scaled), {f"_{k}": k for k in models})
    scores = {k: measured[f"_{k}"] for k in models}
    best = max(scores, key=lambda k: (scores[k] if scores[k] == scores[k] else float("-inf"), -k))
    return models[best], scores


def cluster_stats(clustered: DataFrame) -> DataFrame:
    """Centre, incidents, mean priority and mean risk per cluster, two digits."""
    return clustered.groupBy("cluster").agg(
        F.bround(F.avg("latitude"), 2).alias("center_lat"),
        F.bround(F.avg("longitude"), 2).alias("center_lon"),
        F.sum("incident_count").alias("total_incidents"),
        F.bround(F.avg("incident_count"), 2).alias("avg_incidents"),
        F.bround(F.avg("avg_priority"), 2).alias("avg_priority"),
        F.bround(F.avg("location_risk"), 2).alias("avg_risk"),
    )


def label_zones(stats: DataFrame) -> DataFrame:
    """Zone by the 33rd and 66th percentile of the clusters' mean risk (a few rows)."""
    cuts = stats.agg(F.percentile("avg_risk", [0.33, 0.66]).alias("cuts")).scalar()
    risk = F.col("avg_risk")
    zone = (
        F.when(risk >= F.element_at(cuts, 2), "HIGH_RISK")
        .when(risk >= F.element_at(cuts, 1), "MEDIUM_RISK")
        .otherwise("LOW_RISK")
    )
    return stats.withColumn("risk_zone", zone)


def with_zone(clustered: DataFrame, labels: DataFrame, column: str = "risk_zone") -> DataFrame:
    """Add each row's zone; there is one label row per cluster, at most a dozen."""
    return clustered.join(F.broadcast(labels.select("cluster", column)), "cluster")


def cluster_zones(
    places: DataFrame, ks: Iterable[int] = range(3, 10), seed: int = 42, restarts: int = 10
) -> DataFrame:
    """Places with cluster and zone, the number of clusters chosen by silhouette."""
    scaled = materialize(scale(places, ZONE_FEATURES))
    model, _ = search_k(scaled, ks, seed, restarts)
    clustered = materialize(model.transform(scaled).drop("scaled"))
    return with_zone(clustered, label_zones(cluster_stats(clustered)))


def cluster_levels(places: DataFrame, k: int = 3, seed: int = 42, restarts: int = 10) -> DataFrame:
    """Places in ``k`` clusters; the riskiest is HIGH, the next MEDIUM, the rest LOW."""
    scaled = materialize(scale(places, ZONE_FEATURES))
    model = best_kmeans(scaled, k, seed, restarts)
    clustered = materialize(model.transform(scaled).drop("scaled"))
    risk = clustered.groupBy("cluster").agg(F.avg("location_risk").alias("risk"))
    rank = F.row_number().over(Window.orderBy(F.desc("risk"), "cluster"))
    level = F.when(rank == 1, "HIGH").when(rank == 2, "MEDIUM").otherwise("LOW")
    return with_zone(clustered, risk.withColumn("risk_level", level), "risk_level")


def cluster_hours(calls: DataFrame, k: int = 3, seed: int = 42, restarts: int = 10) -> DataFrame:
    """Fallback without places: calls by hour and priority; the largest cluster is HIGH.

    There are few distinct (hour, priority) pairs, so the model is fitted on those
    with their counts as weights and every call takes the cluster of its pair.
    """
    filled = calls.select(
        "incident_number",
        F.coalesce("response_hour", F.lit(12)).cast("double").alias("hour"),
        F.coalesce("priority_numeric", F.lit(2)).cast("double").alias("priority"),
    )
    pairs = filled.groupBy("hour", "priority").agg(F.count("*").cast("double").alias("weight"))
    vectors = materialize(
        VectorAssembler(inputCols=["hour", "priority"], outputCol="scaled").transform(pairs)
    )
    fits = [
        KMeans(
            k=k, seed=seed + i, featuresCol="scaled", predictionCol="cluster", weightCol="weight"
        ).fit(vectors)
        for i in range(restarts)
    ]
    model = min(fits, key=lambda m: m.summary.trainingCost)
    assigned = materialize(model.transform(vectors).drop("scaled"))
    sizes = assigned.groupBy("cluster").agg(F.sum("weight").alias("size"))
    rank = F.row_number().over(Window.orderBy(F.desc("size"), "cluster"))
    level = F.when(rank == 1, "HIGH").when(rank == 2, "MEDIUM").otherwise("LOW")
    levelled = with_zone(assigned, sizes.withColumn("risk_level", level), "risk_level")
    return filled.join(
        F.broadcast(levelled.select("hour", "priority", "cluster", "risk_level")),
        ["hour", "priority"],
    ).select("incident_number", "cluster", "risk_level")


def enough_rows(df: DataFrame, minimum: int) -> bool:
    """Gate before a model run: reads at most ``minimum`` rows."""
    return not at_most(df, minimum - 1)


def has_places(calls: DataFrame, share: float = 0.3) -> bool:
    """Whether more than ``share`` of the calls carry coordinates."""
    row = calls.agg(F.count("latitude_centroid").alias("n"), F.count("*").alias("t")).first()
    return row["t"] > 0 and row["n"] > row["t"] * share
