"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence has the score sigmoid(bias + sum of the weights of its words); a document has the
noisy-or of its sentences. Weights belong to words and to their beginnings, so that inflected
forms share evidence. Only document labels are known: the likelihood of the noisy-or is maximised
by gradient steps, whose sums over documents Spark takes. The fitted sentence scores then locate
the offending sentences.

The fit reads a bounded sample of labelled documents (SAMPLE_DOCS; half of it for each class, and what
the other class leaves, drawn by hash and weighted back to the classes' shares, so a rare class is
seen whole; equal texts count once). The model keeps the SELECTED features, hashed to BITS bits, that
are most strongly associated with the labels among those in LEAST_DOCS or more sampled documents; these
bound the fit alone, scores cover all texts. Edge cases: null and empty texts have no sentence and get the score of the bias alone;
without labels of both classes all scores are the share of label 1 (0 without labels); labels
other than 0 and 1 are ignored; a doc_id with several labels has the largest; repeated rows each
give a row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, stored

SAMPLE_DOCS = 20_000
PARTS = 12  # partitions of the sample, and of each gradient
BEGINNINGS = (3, 4, 5, 6)
BITS = 22
SELECTED = 16_384  # features kept, by the strength of their association with the labels
LEAST_DOCS = 5
STEPS = 40
RATE = 0.25
PENALTY = 0.3  # of a Gaussian prior on the weights, for the whole sample
CACHE_WORDS = 500_000
OFFENDING = 0.5

_SENTENCE = re.compile(r"[^\n.!?]*[.!?]+|[^\n.!?]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed features of a lowered word: itself and its beginnings."""
    forms = [f"={word}", *(word[:k] for k in BEGINNINGS if len(word) >= k)]
    return [xxhash.xxh3_64_intdigest(f) & ((1 << BITS) - 1) for f in forms]


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(start, end, lowered words) of each sentence that has a word."""
    out = []
    for m in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(m.group().lower())
        if words:
            out.append((m.start(), m.end(), words))
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a feature, by partition."""
    known: dict[str, list[int]] = {}
    counts = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for text, y in zip(batch["text"], batch["y"], strict=True):
            words = set(_WORD.findall((text or "").lower()))
            if len(known) > CACHE_WORDS:
                known.clear()
            ids: set[int] = set()
            for w in words:
                if w not in known:
                    known[w] = features(w)
                ids.update(known[w])
            counts[y, np.fromiter(ids, np.int64, len(ids))] += 1
    held = np.flatnonzero(counts.sum(axis=0))
    yield pd.DataFrame({"feature": held, "zeros": counts[0, held], "ones": counts[1, held]})


def _encode(shared):
    """Per document: feature places of its sentences, flat, and how many each sentence has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {int(f): i for i, f in enumerate(shared.value)}
        known: dict[str, list[int]] = {}
        for batch in batches:
            flat, sizes = [], []
            for text in batch["text"]:
                own: list[int] = []
                own_sizes = []
                for _, _, words in sentences(text):
                    before = len(own)
                    for w in words:
                        if w not in known:
                            if len(known) > CACHE_WORDS:
                                known.clear()
                            known[w] = [place[f] for f in features(w) if f in place]
                        own += known[w]
                    own_sizes.append(len(own) - before)
                flat.append(own)
                sizes.append(own_sizes)
            yield pd.DataFrame({"y": batch["y"], "flat": flat, "sizes": sizes})

    return run


def gradient(
    weights: np.ndarray, bias: float, y: np.ndarray, doc_of: np.ndarray, sentence_of: np.ndarray, flat: np.ndarray,
    counts_as: tuple[float, float] = (1.0, 1.0),
):
    """Log likelihood of the noisy-or, and its gradients for weights and bias.

    A document counts as ``counts_as[label]`` documents.
    """
    each = np.asarray(counts_as)[y]
    z = bias + np.bincount(sentence_of, weights=weights[flat], minlength=len(doc_of))
    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    # an empty document counts as one sentence without words
    none = -np.logaddexp(0, np.clip(z, -40, 40))
    clean = np.bincount(doc_of, weights=none, minlength=len(y))
    toxic = np.maximum(-np.expm1(clean), 1e-12)
    pull = each * np.where(y == 1, np.exp(clean) / toxic, -1.0)
    slope = p * pull[doc_of]
    gain = float((each * np.where(y == 1, np.log(toxic), clean)).sum())
    return gain, np.bincount(flat, weights=slope[sentence_of], minlength=len(weights)), float(slope.sum())


def _slopes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, counts_as = shared.value
        total, n = np.zeros(len(weights) + 2), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False)
            flat, sizes = batch.column("flat"), batch.column("sizes")
            per_doc = np.diff(sizes.offsets.to_numpy())
            doc_of = np.repeat(np.arange(len(y)), per_doc)
            each = sizes.flatten().to_numpy(zero_copy_only=False)
            sentence_of = np.repeat(np.arange(len(each)), each)
            gain, slope, lean = gradient(weights, bias, y, doc_of, sentence_of, flat.flatten().to_numpy(zero_copy_only=False), counts_as)
            total += np.concatenate(([gain, lean], slope))
            n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["n", "total"])

    return run


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def class_rates(zeros: int, ones: int, sample_docs: int) -> tuple[float, float]:
    """Share of each class to draw: half of the sample for each, and what the other class leaves."""
    half = sample_docs / 2
    return tuple(
        min(1.0, max(half, sample_docs - other) / own) if own else 1.0 for own, other in ((zeros, ones), (ones, zeros))
    )


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> Model:
    """Fit on (doc_id, text, y)."""
    spark = labelled.sparkSession
    bound_batches(spark)
    known = labelled.where("y in (0, 1)").select("doc_id", "text", F.col("y").cast("int").alias("y"))
    size = known.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("share")).head()
    share = size["share"] or 0.0
    if share in (0.0, 1.0):
        limit = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(limit / (1 - limit))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    toxic = round(size["n"] * share)
    rates = class_rates(size["n"] - toxic, toxic, sample_docs)
    # drawn without the texts first (some SAMPLE_DOCS ids), so that only texts of the sample meet their labels
    taken = stored(known.where(draw < F.when(F.col("y") == 1, rates[1]).otherwise(rates[0])).select("doc_id").distinct(), "toxic-ids")
    drawn = known.join(F.broadcast(taken), "doc_id", "left_semi").dropDuplicates(["text", "y"])
    sample = stored(drawn.repartition(PARTS), "toxic-sample")
    counts = sample.mapInPandas(_count, "feature long, zeros long, ones long").groupBy("feature").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    zeros, ones = totals.get(0, 0), totals.get(1, 0)
    # each document stands for those that were not drawn of its class, on average for one
    mean = (zeros / rates[0] + ones / rates[1]) / max(1, zeros + ones)
    counts_as = (1 / rates[0] / mean, 1 / rates[1] / mean)
    odds = F.log((F.col("ones") + 0.5) / (ones + 1.0)) - F.log((F.col("zeros") + 0.5) / (zeros + 1.0))
    spread = F.sqrt(1 / (F.col("ones") + 0.5) + 1 / (F.col("zeros") + 0.5))
    best = (
        counts.where(F.col("ones") + F.col("zeros") >= LEAST_DOCS)
        .select("feature", odds.alias("odds"), (F.abs(odds) / spread).alias("strength"))
        .orderBy(F.desc("strength"), "feature")
        .limit(SELECTED)
        .toPandas()
        .sort_values("feature")
    )
    chosen = best["feature"].to_numpy(np.int64)
    encoded = stored(
        sample.mapInPandas(_encode(spark.sparkContext.broadcast(chosen)), "y int, flat array<int>, sizes array<int>").coalesce(PARTS),
        "toxic-encoded",
    )
    weights = np.concatenate(([-4.0], np.zeros(len(chosen))))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):  # gradient ascent with moments
        shared = spark.sparkContext.broadcast((weights[1:], float(weights[0]), counts_as))
        parts = encoded.mapInArrow(_slopes(shared), "n long, total array<double>").collect()  # one row for each part
        n = sum(r["n"] for r in parts)
        slope = np.sum([r["total"][1:] for r in parts], axis=0) / n - PENALTY / n * np.concatenate(([0.0], weights[1:]))
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights = weights + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        shared.unpersist()
    return Model(chosen, weights[1:], float(weights[0]))


def _score(shared, locate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights, bias = shared.value
        weight = dict(zip(chosen.tolist(), weights.tolist(), strict=True))
        known: dict[str, float] = {}
        for batch in batches:
            scores, found = [], []
            for text in batch.column("text"):
                if len(known) > CACHE_WORDS:
                    known.clear()
                spans = sentences(text.as_py())
                z = np.full(max(1, len(spans)), bias)
                for i, (_, _, words) in enumerate(spans):
                    for w in words:
                        v = known.get(w)
                        if v is None:
                            v = known[w] = sum(weight.get(f, 0.0) for f in features(w))
                        z[i] += v
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                scores.append(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-15)).sum())))
                if locate:
                    found.append([{"start": s, "end": e, "score": float(p[i])} for i, (s, e, _) in enumerate(spans) if p[i] >= OFFENDING])
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64())]
            names = ["doc_id", "score"]
            if locate:
                columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))))
                names.append("offending")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def scored(docs: DataFrame, model: Model, locate: bool = True) -> DataFrame:
    """(doc_id, score, offending): the sentences at or above OFFENDING, in code points."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double"
    if locate:
        schema += ", offending array<struct<start:long,end:long,score:double>>"
    return docs.select("doc_id", "text").mapInArrow(_score(shared, locate), schema)
