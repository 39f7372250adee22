"""Quality scores: kernel ridge regression by random Fourier features, then isotonic calibration.

Each text gives a vector of document statistics. Random Fourier features (cosines of random
projections) approximate a Gaussian kernel between those vectors. Every partition sums its part
of the normal equations, Spark sums the parts, and the driver solves one small system. The
equations are summed by fold, so leaving a fold out is a subtraction; scores of left-out rows,
counted in bins of equal size, give an isotonic map to probabilities. Folds are dealt by a hash of the
statistics, so copies of a text share one and no left-out score has seen its text.

Edge cases: null and empty texts have the statistics of an empty text and get a score; without
labelled rows the score is 0.5, with one class its share; labels other than 0 and 1 are ignored;
a doc_id with several labels has the largest. Repeated rows each give a row; other columns of the
documents are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, stored

STATISTICS = (
    "words", "word_length", "word_deviation", "longest", "distinct", "top_word", "repeats", "capitals", "digits",
    "stops", "shouts", "bars", "symbols", "blanks", "beyond_ascii", "entropy", "lines", "distinct_lines", "line_length",
    "ended_lines", "symbol_words", "pairs", "upper_words", "characters",
)
FEATURES = 256
FOLDS = 4
PENALTY = 1e-2
BINS = 200
SEED = 11

_CLASS = np.zeros((8, 256))
for _row, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!", b"|", b"#$%&*@^~_=+<>/\\{}[]", b" \t\r\n", bytes(range(128, 192)))
):
    _CLASS[_row, list(_bytes)] = 1  # the last: continuation bytes
_SYMBOLS = frozenset("#$%&*@^~_=+<>/\\{}[]|!")


def statistics(text: str | None) -> list[float]:
    """Numbers of a moderate size that describe a text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    upper, digits, stops, shouts, bars, symbols, blanks, beyond = _CLASS @ counts / size
    shares = counts[counts > 0] / size
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(1, len(lines))
    return [
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        len(seen) / n**0.8,
        max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        upper,
        digits,
        stops,
        shouts,
        bars,
        symbols,
        blanks,
        beyond,
        float(-(shares * np.log(shares)).sum()) if len(raw) else 0.0,
        np.log1p(len(lines)),
        len(set(lines)) / n_lines,
        np.log1p(len(text) / n_lines),
        sum(x.rstrip()[-1:] in ".!?:\"" for x in lines) / n_lines,
        sum(not _SYMBOLS.isdisjoint(w[-1]) for w in words) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        sum(w.isupper() for w in words) / n,
        np.log1p(len(text)),
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), x], names=["doc_id", "x"])


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each text."""
    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(_describe, f"doc_id {kind}, x array<double>"), "statistics")


@dataclass
class Kernel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.weights + self.phase)
        return np.concatenate((waves, z, np.ones((len(x), 1))), axis=1)


def kernel_for(mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = SEED) -> Kernel:
    random = np.random.default_rng(seed)
    width = np.sqrt(len(mean))  # of the Gaussian, in standard deviations
    return Kernel(mean, scale, random.normal(0, 1 / width, (len(mean), features)), random.uniform(0, 2 * np.pi, features))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def _equations(shared, folds: int):
    """The rows of [sum of f f', sum of f y] of a partition, by fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(*shared.value)
        sums: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            f = kernel(_matrix(batch.column("x")))
            y, fold = batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            both = np.concatenate((f, y[:, None].astype(float)), axis=1)
            if sums is None:
                sums = np.zeros((folds, f.shape[1], both.shape[1]))
            for k in range(folds):
                sums[k] += f[fold == k].T @ both[fold == k]
        if sums is not None:
            folds_, rows = np.indices(sums.shape[:2])
            yield pa.RecordBatch.from_arrays(
                [pa.array(folds_.ravel().astype(np.int32)), pa.array(rows.ravel().astype(np.int32)), pa.array(list(sums.reshape(-1, sums.shape[2])), pa.list_(pa.float64()))],
                names=["fold", "i", "row"],
            )

    return run


def _raw(shared):
    """Score of each row by the weights of its fold (of all rows if it has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters, weights = shared.value
        kernel = Kernel(*parameters)
        for batch in batches:
            f = kernel(_matrix(batch.column("x"))) if batch.num_rows else np.empty((0, weights.shape[1]))
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            raw = np.einsum("nd,nd->n", f, weights[fold])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names if c != "x"] + [pa.array(raw)],
                names=[c for c in batch.schema.names if c != "x"] + ["raw"],
            )

    return run


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step means of y by x (pool adjacent violators), as points to interpolate between."""
    pools: list[list[float]] = []
    for a, b, w in zip(x, y, n, strict=True):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


@dataclass
class Model:
    kernel: Kernel | None
    weights: np.ndarray | None
    points: np.ndarray
    values: np.ndarray


def fit(labelled: DataFrame, features: int = FEATURES, folds: int = FOLDS, penalty: float = PENALTY, bins: int = BINS) -> Model:
    """Fit on (doc_id, x, y); all rows take part, only sums reach the driver."""
    spark = labelled.sparkSession
    rows = stored(
        labelled.where("y in (0, 1)").select(
            "x", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("x"), F.lit(folds)).cast("int").alias("fold")
        ),
        "labelled",
    )
    x = array_to_vector("x")
    base = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("share"),
        vector_to_array(Summarizer.mean(x)).alias("mean"), vector_to_array(Summarizer.std(x)).alias("std"),
    ).head() if rows.limit(1).count() else None
    if base is None or base["n"] < 2 * folds or base["share"] in (0.0, 1.0):
        value = 0.5 if base is None else base["share"]
        return Model(None, None, np.zeros(1), np.full(1, value))
    kernel = kernel_for(np.array(base["mean"]), np.maximum(np.array(base["std"]), 1e-6), features)
    parameters = (kernel.mean, kernel.scale, kernel.weights, kernel.phase)
    parts = rows.mapInArrow(_equations(spark.sparkContext.broadcast(parameters), folds), "fold int, i int, row array<double>")
    summed = parts.groupBy("fold", "i").agg(vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row")).collect()
    size = len(summed[0]["row"]) - 1
    sums = np.zeros((folds, size, size + 1))
    for r in summed:
        sums[r["fold"], r["i"]] = r["row"]

    def solve(total: np.ndarray) -> np.ndarray:
        ridge = max(penalty * np.trace(total[:, :size]) / size, 1e-9) * np.eye(size)  # a fold may hold all rows
        return np.linalg.solve(total[:, :size] + ridge, total[:, size])

    whole = sums.sum(axis=0)
    weights = np.stack([solve(whole - s) for s in sums])
    shared = spark.sparkContext.broadcast((parameters, weights))
    left_out = stored(rows.mapInArrow(_raw(shared), "y int, fold int, raw double"), "left-out")
    cuts = left_out.approxQuantile("raw", [i / bins for i in range(1, bins)], 0.25 / bins)
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    counted = (
        left_out.groupBy(F.size(F.filter(edges, lambda c: c < F.col("raw"))).alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .collect()
    )
    points, values = isotonic(*(np.array([r[c] for r in counted], float) for c in ("raw", "y", "n")))
    return Model(kernel, solve(whole), points, values)


def scored(statistics_of: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for the rows of ``described``."""
    if model.kernel is None:
        return statistics_of.select("doc_id", F.lit(float(model.values[0])).alias("score"))
    k = model.kernel
    shared = statistics_of.sparkSession.sparkContext.broadcast(((k.mean, k.scale, k.weights, k.phase), model.weights[None]))
    points, values = model.points, model.values
    measure = _raw(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in measure(batches):
            score = np.interp(batch.column("raw").to_numpy(zero_copy_only=False), points, values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    kind = statistics_of.schema["doc_id"].dataType.simpleString()
    rows = statistics_of.select("doc_id", "x", F.lit(0).alias("fold"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def labelled_rows(statistics_of: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """(doc_id, x, y) of labelled documents."""
    y = labels.where(F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).alias("y"))
    return statistics_of.join(y, "doc_id")
