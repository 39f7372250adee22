"""Centroid clustering by the threshold algorithm.

Vectors become integers, floor(1024 * x) of each component. In each dimension the centroids are
listed by their value; for a vector the lists are walked outward from its own value, the nearer end
first. Each step shows one more centroid a dimension; those seen for the first time get their exact
squared distance. What no list has shown yet is at least as far as the sum of the squared gaps at the
frontiers, so the walk stops when that sum strictly exceeds the best distance (a centroid at an equal
distance with a smaller number could still come). Rounds of Lloyd's algorithm use it: assignment, then
the exact floor of the mean.

Scale: each round reads the vectors once; a partition hands on one sum a cluster and component,
whatever it holds, so a cluster of a third of all vectors is no hot key. Centroids, clusters times
components, are all that the driver sees. Give a table, not a long chain of operators, since each
round reads its input anew.

Exactness: all is integer. Components up to EXACT in size are taken in 64 bits, larger ones as
integers of any size; sums over partitions are decimals of 38 digits, so vectors with a component of
FAR or more count as not finite. A squared distance beyond 64 bits, or a sum of them, is null.

Edge cases: vectors that are null, of another length, or hold null or non-finite components are left
out; repeated rows each count, also as first centroids; ties go to the smaller number; a null vec_id
is kept, but is the last choice for a first centroid; fewer vectors than clusters give as many
centroids as there are vectors; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch.llm.common import stored

CLUSTERS, SIZE, ROUNDS, SEED = 8, 64, 10, 3
SCALE = 1024
EXACT = 1 << 27  # with up to 64 components, squared distances stay below 2**63
FAR = 1e24
ROWS = 2048  # vectors that are walked at once


def whole(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are kept, and their integer components."""
    lists = column.cast(pa.list_(pa.float64()))
    ends = lists.offsets.to_numpy()
    wide = np.diff(ends) == size
    if lists.null_count:
        wide &= ~np.asarray(lists.is_null())
    rows = np.flatnonzero(wide)
    values = lists.values
    flat = values.to_numpy(zero_copy_only=False).astype(float)
    bad = ~(np.abs(flat) < FAR)
    if values.null_count:
        bad |= np.asarray(values.is_null())
    places = ends[rows][:, None] + np.arange(size)
    rows = rows[~bad[places].any(1)]
    places = ends[rows][:, None] + np.arange(size)
    scaled = np.floor(flat[places] * SCALE)  # a power of two: the product is exact
    if scaled.size and np.abs(scaled).max() > EXACT:
        return rows, np.vectorize(int, otypes=[object])(scaled)
    return rows, scaled.astype(np.int64)


def assigned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and how many distances were computed."""
    if vectors.dtype == object or (centroids.size and np.abs(centroids).max() > EXACT):
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    else:
        centroids = centroids.astype(np.int64)
    n, size = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T  # by dimension: centroids by value
    values = np.take_along_axis(centroids.T, order, axis=1)
    dims = np.arange(size)
    rows = np.arange(n)
    # the lists' ends nearest to the vector's own value, on either side
    right = (values[None] < vectors[:, :, None]).sum(2)
    left = right - 1
    seen = np.zeros((n, k), bool)
    best = np.full(n, -1, vectors.dtype)
    number = np.full(n, k)
    computed = 0
    for step in range(k):
        if not len(rows):
            break
        x = vectors[rows]
        to_left = x - values[dims, np.maximum(left, 0)]
        to_right = values[dims, np.minimum(right, k - 1)] - x
        go_left = (right >= k) | ((left >= 0) & (to_left <= to_right))
        gap = np.where(go_left, to_left, to_right)
        shown = order[dims, np.where(go_left, left, right)]
        left, right = left - go_left, right + ~go_left
        new = np.zeros((len(rows), k), bool)
        new[np.arange(len(rows))[:, None], shown] = True
        new &= ~seen[rows]
        seen[rows] |= new
        who, which = np.nonzero(new)
        computed += len(who)
        away = x[who] - centroids[which]
        distance = (away * away).sum(1)
        # better: smaller distance, then smaller number
        for i in np.unique(which):
            at, d = rows[who[which == i]], distance[which == i]
            better = (best[at] < 0) | (d < best[at]) | ((d == best[at]) & (i < number[at]))
            best[at[better]], number[at[better]] = d[better], i
        frontier = (gap * gap).sum(1)
        open_ = frontier <= best[rows]
        rows, left, right = rows[open_], left[open_], right[open_]
    return number, best, computed


def _batches(vectors: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    for at in range(0, len(vectors), ROWS):
        part = slice(at, at + ROWS)
        number, distance, _ = assigned(vectors[part], centroids)
        yield part, number, distance


def _sums(centroids: np.ndarray, size: int):
    """Count and component sums of each cluster in the partition."""
    kind = pa.list_(pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [0] * len(centroids)
        totals = np.zeros((len(centroids), size), object)
        for batch in batches:
            _, vectors = whole(batch.column("vector"), size)
            for part, number, _ in _batches(vectors, centroids):
                for i in np.unique(number):
                    mine = vectors[part][number == i]
                    n[i] += len(mine)
                    totals[i] += mine.sum(0).astype(object)
        held = [i for i in range(len(centroids)) if n[i]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array([n[i] for i in held], pa.int64()), pa.array([[Decimal(v) for v in totals[i]] for i in held], kind)],
            names=["cluster", "n", "totals"],
        )

    return run


def _placed(centroids: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = whole(batch.column("vector"), size)
            clusters, distances = np.zeros(len(rows), np.int32), np.zeros(len(rows), object)
            for part, number, distance in _batches(vectors, centroids):
                clusters[part], distances[part] = number, distance.astype(object)
            fits = [int(d) if d < 1 << 63 else None for d in distances]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(clusters), pa.array(fits, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def _kept(vectors: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = whole(batch.column("vector"), size)
            yield batch.take(pa.array(rows))

    return vectors.mapInArrow(run, vectors.schema)


def first_centroids(vectors: DataFrame, clusters: int, size: int, seed: int) -> np.ndarray:
    """The kept vectors with the smallest hash of their ids, by hash; equal ids by their components."""
    named = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    rows = _kept(vectors, size).orderBy(F.sha2(named, 256).asc_nulls_last(), "vector").limit(clusters).collect()
    found = [[math.floor(float(x) * SCALE) for x in r["vector"]] for r in rows]
    return np.array(found, object).reshape(len(rows), size)


def moved(vectors: DataFrame, centroids: np.ndarray, size: int) -> np.ndarray:
    """The floor of the mean of each cluster; an empty one stays."""
    parts = vectors.select("vector").mapInArrow(_sums(centroids, size), "cluster int, n long, totals array<decimal(38,0)>")
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("totals", F.lit(i))) for i in range(size)]).alias("totals")
    )
    after = centroids.copy()
    for row in sums.collect():  # one row a cluster
        after[row["cluster"]] = [int(t) // row["n"] for t in row["totals"]]
    return after


def clustered(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    size: int = SIZE,
    rounds: int = ROUNDS,
    seed: int = SEED,
    column: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) for each kept vector."""
    vectors = embeddings.select("vec_id", F.col(column).alias("vector"))
    centroids = first_centroids(vectors, clusters, size, seed)
    if not len(centroids):
        return _described(vectors.sparkSession.createDataFrame([], _schema(embeddings)), centroids)
    for _ in range(rounds):
        after = moved(vectors, centroids, size)
        if (after == centroids).all():
            break  # every further round gives the same
        centroids = after
    placed = vectors.mapInArrow(_placed(centroids, size), _schema(embeddings))
    return _described(stored(placed, "centroids"), centroids)


def _schema(embeddings: DataFrame) -> T.StructType:
    id_type = T.StructField("vec_id", embeddings.schema["vec_id"].dataType)
    return T.StructType([id_type, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])


def _described(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole_sum = F.when(F.count("distance") == F.count(F.lit(1)), exact).alias("total")
    sums = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(whole_sum).collect()}  # one row a cluster
    everything = None if None in sums.values() else sum(sums.values())

    def long(value: int | None) -> Column:
        return F.lit(int(value) if value is not None and value < 1 << 63 else None).cast("long")

    def by_cluster(values: list[Column], kind: str) -> Column:
        return F.get(F.array(*values), F.col("cluster")) if values else F.lit(None).cast(kind)

    lines = [",".join(str(int(v)) for v in c) for c in centroids]
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([long(sums.get(i)) for i in range(len(centroids))], "long").alias("cluster_inertia"),
        long(everything).alias("inertia"),
        by_cluster([F.lit(hashlib.sha256(line.encode()).hexdigest()) for line in lines], "string").alias("centroid_sha256"),
        by_cluster([F.lit(line) for line in lines], "string").alias("centroid"),
    )
