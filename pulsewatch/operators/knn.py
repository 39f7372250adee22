"""Exact k-nearest-neighbour classification in the cells of a k-d tree.

A k-d tree, fitted on a sample that grows with the data, deals the training vectors to cells. A
test vector first asks the smallest branch around it that holds k rows; the k-th distance found
is a bound, and it goes on to cells whose boxes lie within half of it, then within what is left of
it. A cell answers with its k nearest only, so what moves is visits, not pairs. The bound is valid
for any data: the result equals a full comparison, only the work depends on how well data cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.session import materialize

# Visits to one cell handled under one key before they are split, the cell being copied.
CELL_SPLIT = 200_000
# Training vectors that a cell is to hold, and sampled vectors for each cell.
CELL_ROWS, CELL_SAMPLE = 8192, 8
ASKED = 512  # test vectors compared at once
_SLACK = 1e-9


def top_categories(df: DataFrame, column: str, n: int = 10, out: str | None = None) -> DataFrame:
    """Keep the ``n`` most frequent values and call the rest 'Other'."""
    value = F.coalesce(F.col(column), F.lit("Unknown"))
    named = df.withColumn("_value", value)
    top = (
        named.groupBy("_value")
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), "_value")
        .limit(n)
        .select("_value", F.lit(True).alias("_top"))
    )
    kept = F.when(F.col("_top"), F.col("_value")).otherwise("Other")
    # the right side has n rows by construction
    return (
        named.join(F.broadcast(top), "_value", "left")
        .withColumn(out or column, kept)
        .drop("_value", "_top")
    )


def incident_features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Place, cyclic hour, weekday, weather and priority, as far as the columns exist."""
    present, columns, updates = set(df.columns), [], {}
    if "latitude_centroid" in present:
        columns += ["latitude_centroid", "longitude_centroid"]
    if "response_hour" in present:
        updates["hour_sin"] = V.cycle_sin(F.col("response_hour"), 24)
        updates["hour_cos"] = V.cycle_cos(F.col("response_hour"), 24)
        columns += ["hour_sin", "hour_cos"]
    if "response_day_of_week" in present:
        day = V.day_number(F.col("response_day_of_week"))
        updates["day_num"] = day
        updates["is_weekend"] = F.coalesce(day >= 5, F.lit(False)).cast("int")
        columns += ["day_num", "is_weekend"]
    if "temperature_f" in present:
        columns += ["temperature_f", "humidity_pct", "precipitation_mm"]
    if "priority_numeric" in present:
        columns.append("priority_numeric")
    return df.withColumns(updates), columns


def knn_features(df: DataFrame, key: str = "incident_number") -> tuple[DataFrame, list[str]]:
    """Complete feature rows with the incident category (top ten, else 'Other')."""
    named = top_categories(df, "final_problem_category", 10, "incident_category")
    featured, columns = incident_features(named)
    rows = featured.select(key, *columns, "incident_category").na.drop(subset=columns)
    return rows, columns


def _scaled_columns(
    df: DataFrame, columns: list[str], moments: dict[str, tuple[float, float]]
) -> DataFrame:
    scaled = []
    for i, c in enumerate(columns):
        mean, spread = moments[c]
        scaled.append(((F.col(c).cast("double") - F.lit(mean)) / F.lit(spread)).alias(f"x{i}"))
    return df.select("*", *scaled)


def _moments(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature; a constant feature keeps scale 1."""
    aggs = [f(c).alias(f"{n}{i}") for i, c in enumerate(columns)
            for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


class Tree:
    """Cells of a k-d tree: halved at the median of the widest column until a leaf is small."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.dim: list[int] = []
        self.cut: list[float] = []
        self.below: list[list[int]] = []
        self.cell: list[int] = []
        leaf, count = max(1, -(-len(sample) // leaves)), 0
        todo = [(sample, -1)]
        while todo:
            held, parent = todo.pop()
            node = len(self.cell)
            if parent >= 0:
                self.below[parent].append(node)
            spread = np.ptp(held, axis=0) if len(held) > leaf else np.zeros(1)
            dim = int(spread.argmax())
            cut = 0.0
            if spread[dim] > 0:
                column = np.sort(held[:, dim])
                cut = float(column[(len(column) - 1) // 2])
                if cut == column[-1]:
                    cut = float(column[np.searchsorted(column, cut) - 1])
            self.dim.append(dim)
            self.cut.append(cut)
            self.below.append([])
            self.cell.append(count if spread[dim] == 0 else -1)
            if spread[dim] == 0:
                count += 1
                continue
            left = held[:, dim] <= cut
            todo += [(held[~left], node), (held[left], node)]
        # the order in which they come: the left branch first
        self.cells = count

    def fill(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Rows and tight boxes of the cells, and of the branches above them."""
        n = len(self.cell)
        self.rows = np.zeros(n, np.int64)
        self.low = np.full((n, low.shape[1]), np.inf)
        self.high = np.full((n, low.shape[1]), -np.inf)
        for node in reversed(range(n)):
            at = self.cell[node]
            if at >= 0:
                self.rows[node], self.low[node], self.high[node] = rows[at], low[at], high[at]
            else:
                parts = self.below[node]
                self.rows[node] = self.rows[parts].sum()
                self.low[node], self.high[node] = self.low[parts].min(0), self.high[parts].max(0)

    def branch(self, vectors: np.ndarray, least: int) -> np.ndarray:
        """The smallest node around each vector with ``least`` rows (0: the cell)."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, who = todo.pop()
            out[who] = node
            if not len(who) or not self.below[node]:
                continue
            left = vectors[who, self.dim[node]] <= self.cut[node]
            for child, part in zip(self.below[node], (who[left], who[~left])):
                if not least or self.rows[child] >= least:
                    todo.append((child, part))
        return out

    def visits(
        self, vectors: np.ndarray, floor: np.ndarray, bound: np.ndarray, home: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Cells whose boxes lie beyond ``floor`` and within ``bound`` (squared), outside of the home branch."""
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, who = todo.pop()
            who = who[home[who] != node]
            gap = np.maximum(np.maximum(self.low[node] - vectors[who], vectors[who] - self.high[node]), 0.0)
            far = (gap * gap).sum(1)
            near = far <= bound[who]
            if self.below[node]:
                if near.any():
                    todo += [(child, who[near]) for child in self.below[node]]
                continue
            who = who[near & (far > floor[who])]
            if len(who):
                yield self.cell[node], who

    def under(self, node: int) -> list[int]:
        """The cells of a branch."""
        found, todo = [], [node]
        while todo:
            at = todo.pop()
            todo += self.below[at]
            if self.cell[at] >= 0:
                found.append(self.cell[at])
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _at_home(tree: Tree, k: int):
    """Each vector with the cells of the smallest branch around it that holds k rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [tree.under(node) for node in tree.branch(_matrix(batch.column("v")), k)]
            yield _visits(batch, [(i, c) for i, found in enumerate(cells) for c in found])

    return run


def _abroad(tree: Tree, k: int):
    """Each vector with the cells outside of that branch between ``floor`` and ``bound``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            floor, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("floor", "bound"))
            found = tree.visits(vectors, floor, bound, tree.branch(vectors, k)) if len(vectors) else ()
            yield _visits(batch, [(i, cell) for cell, who in found for i in who.tolist()])

    return run


def _visits(batch: pa.RecordBatch, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    rows, cells = pa.array([i for i, _ in pairs], pa.int64()), pa.array([c for _, c in pairs], pa.int32())
    return pa.RecordBatch.from_arrays([batch.column("v").take(rows), cells], names=["v", "cell"])


def _answer(k: int):
    """The k nearest rows of the cell for each vector that asks; a cell's own vectors come first."""

    def nearest(points: np.ndarray, starts: np.ndarray, rows: pa.Array, asked: pa.Array) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(asked), ASKED):
            some = asked.slice(at, ASKED)
            vectors = _matrix(some)
            squares = np.zeros((len(vectors), len(points)))
            for d in range(points.shape[1]):
                squares += (vectors[:, d : d + 1] - points[None, :, d]) ** 2
            squares = np.round(squares, 9)
            if len(points) > k:
                least = np.partition(squares, k - 1, axis=1)[:, k - 1]
                who, which = np.nonzero(squares <= least[:, None])
            else:
                who, which = np.nonzero(squares >= 0)
            # points stand in the order of their first rows, which breaks ties
            order = np.lexsort((which, squares[who, which], who))
            who, which = who[order], which[order]
            first = np.searchsorted(who, np.arange(len(vectors)))
            kept = np.arange(len(who)) - first[who] < k
            who, which = who[kept], which[kept]
            sizes = starts[which + 1] - starts[which]
            row = np.repeat(starts[which] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            taken = rows.take(pa.array(row))
            found = pa.StructArray.from_arrays(
                [pa.array(np.repeat(squares[who, which], sizes)), taken.field("id"), taken.field("label")], ["d2", "id", "label"]
            )
            ends = np.concatenate(([0], np.cumsum(np.bincount(who, sizes, len(vectors)))))
            yield pa.RecordBatch.from_arrays(
                [some, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], names=["v", "found"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        held: list[pa.RecordBatch] = []
        cell: tuple | None = None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("cell", "part", "kind")])
            edges = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                if start == end:
                    continue
                here, kind = tuple(place[:2, start]), place[2, start]
                part = batch.slice(start, end - start)
                if here != at:
                    at, held, cell = here, [], None
                if kind == 0:
                    held.append(part)
                elif held:
                    if cell is None:
                        lists = pa.chunked_array([h.column("rows") for h in held]).combine_chunks()
                        points = np.concatenate([_matrix(h.column("v")) for h in held])
                        starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
                        cell = (points, starts.astype(np.int64), lists.flatten())
                    yield from nearest(*cell, part.column("v"))

    return run


def neighbours(
    train: DataFrame,
    test: DataFrame,
    columns: list[str],
    label: str,
    key: str,
    k: int,
    pivots: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """The ``k`` nearest training rows of every distinct test vector.

    Ties in distance (to nine digits of its square) go to the smaller key. Rows with equal
    features are one vector: a training vector keeps only its first ``k`` rows, which are all
    that can count, and a test vector is searched once for all its rows. By default a cell is
    to hold CELL_ROWS vectors, so cells grow with the data; ``pivots`` sets their number.
    Returns the frame (x0.., rank, label) and the names of the vector columns.
    """
    spark = train.sparkSession
    xs = [f"x{i}" for i in range(len(columns))]
    moments = _moments(train, columns)
    first = Window.partitionBy(*xs).orderBy(key)
    row_type = f"array<struct<id:{train.schema[key].dataType.simpleString()},label:{train.schema[label].dataType.simpleString()}>>"
    points = materialize(
        _scaled_columns(train.select(key, label, *columns), columns, moments)
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= k)
        .groupBy(*xs)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("id"), F.col(label).alias("label")))).alias("rows"))
        .select(F.array(*xs).alias("v"), F.col("rows").cast(row_type).alias("rows"))
    )
    count = points.count()
    leaves = pivots or max(16, count // CELL_ROWS)
    # a sample of as many vectors as the cells need, by a hash of the vector
    share = min(1.0, leaves * CELL_SAMPLE / max(count, 1))
    hashed = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = np.array([r["v"] for r in points.where(hashed).select("v").sort("v").collect()], dtype="float64")
    tree = Tree(sample.reshape(len(sample), len(xs)), leaves)

    @F.pandas_udf("int")
    def cell_of(vectors: pd.Series) -> pd.Series:
        nodes = tree.branch(np.stack(vectors.to_numpy()), 0) if len(vectors) else []
        return pd.Series([tree.cell[n] for n in nodes], dtype="int32")

    placed = materialize(points.withColumn("cell", cell_of("v")))
    sides = [f(F.get("v", F.lit(i))).alias(f"{n}{i}") for i in range(len(xs)) for n, f in (("low", F.min), ("high", F.max))]
    boxes = placed.groupBy("cell").agg(F.sum(F.size("rows")).alias("n"), *sides).collect()  # one row a cell
    rows = np.zeros(tree.cells, np.int64)
    low, high = np.full((tree.cells, len(xs)), np.inf), np.full((tree.cells, len(xs)), -np.inf)
    for box in boxes:
        rows[box["cell"]] = box["n"]
        low[box["cell"]] = [box[f"low{i}"] for i in range(len(xs))]
        high[box["cell"]] = [box[f"high{i}"] for i in range(len(xs))]
    tree.fill(rows, low, high)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found_type = f"v array<double>, found array<struct<d2:double,{row_type[len('array<struct<') : -2]}>>"

    def answers(visits: DataFrame) -> DataFrame:
        """(v, found): what each visited cell answers."""
        crowded = visits.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CELL_SPLIT).collect()
        parts = F.lit(1)
        if crowded:
            known = F.create_map(*[F.lit(x) for r in crowded for x in (r["cell"], 1 + r["n"] // CELL_SPLIT)])
            parts = F.coalesce(known[F.col("cell")], F.lit(1))
        used = placed.join(visits.select("cell").distinct(), "cell", "left_semi")
        held = used.select(
            "cell", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("part"), F.lit(0).alias("kind"),
            "v", "rows", F.get("rows", F.lit(0))["id"].alias("low"),
        )
        asked = visits.select(
            "cell", F.pmod(F.xxhash64("v"), parts).cast("int").alias("part"), F.lit(1).alias("kind"), "v",
            F.lit(None).cast(row_type).alias("rows"), F.lit(None).cast(train.schema[key].dataType).alias("low"),
        )
        met = held.unionByName(asked).repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "kind", "low")
        return met.drop("low").mapInArrow(_answer(k), found_type)

    def merged(found: DataFrame) -> DataFrame:
        best = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k)
        return found.groupBy("v").agg(best.alias("found"))

    kth = F.when(F.size("found") >= k, F.element_at("found", k)["d2"] * (1 + _SLACK) + _SLACK)
    bound = F.coalesce(kth, F.lit(float("inf")))
    wanted = _scaled_columns(test.select(*columns), columns, moments).select(F.array(*xs).alias("v")).distinct()
    best = materialize(merged(answers(materialize(wanted.mapInArrow(_at_home(tree, k), "v array<double>, cell int")))))
    best = best.withColumns({"floor": F.lit(-1.0), "half": bound / 4})
    for limit in (F.col("half"), bound):
        visits = best.select("v", "floor", limit.alias("bound")).mapInArrow(_abroad(tree, k), "v array<double>, cell int")
        visits = materialize(visits)
        if not visits.isEmpty():
            more = merged(best.select("v", "found").unionByName(answers(visits)))
            best = materialize(more.join(best.select("v", "half"), "v"))
        best = best.withColumn("floor", F.col("half"))
    ranked = best.select("v", F.posexplode("found").alias("place", "r"))
    return ranked.select(
        *[F.get("v", F.lit(i)).alias(x) for i, x in enumerate(xs)], (F.col("place") + 1).alias("rank"), F.col("r.label").alias("label")
    ), xs


def knn_classify(
    train: DataFrame,
    test: DataFrame,
    columns: list[str],
    label: str = "incident_category",
    key: str = "incident_number",
    ks: tuple[int, ...] = (3, 5, 7, 9, 11, 13),
    pivots: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Majority vote for every k from one search; the k with the best accuracy wins.

    A tied vote goes to the lowest label, tied accuracy to the smallest k. Returns
    the test rows with their prediction and the accuracy per k.
    """
    found, xs = neighbours(train, test, columns, label, key, max(ks), pivots)
    found = materialize(found)
    votes = (
        found.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
        .where(F.col("rank") <= F.col("k"))
        .groupBy(*xs, "k", "label")
        .agg(F.count("*").alias("n"))
        .groupBy(*xs, "k")
        .agg(F.min_by("label", F.struct((-F.col("n")).alias("n"), "label")).alias("prediction"))
    )
    votes = materialize(votes)
    moments = _moments(train, columns)
    rows = _scaled_columns(test.select(key, label, *columns), columns, moments)
    judged = (
        rows.groupBy(*xs, label)
        .agg(F.count("*").alias("n"))
        .join(votes, xs)
        .groupBy("k")
        .agg(
            (F.sum(F.when(F.col(label) == F.col("prediction"), F.col("n")).otherwise(0))
             / F.sum("n")).alias("accuracy")
        )
    )
    accuracy = materialize(judged)
    best = accuracy.agg(F.min_by("k", F.struct((-F.col("accuracy")).alias("a"), "k"))).scalar()
    chosen = votes.where(F.col("k") == best)
    predicted = rows.join(chosen, xs).select(
        key, F.col(label).alias("label"), "prediction", "k"
    )
    return predicted, accuracy.orderBy("k")
