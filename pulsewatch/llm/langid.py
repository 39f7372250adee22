"""Language identification by unigram pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. A word (a run of
letters, lowered, with the vocabulary's word mark before it) has the probability of all ways to
cut it into pieces, by a forward recursion; a text has that of its words. The probabilities are
fitted by expectation-maximisation (forward-backward) on word counts that Spark gathers from a
bounded sample of labelled documents; each round of expected counts is summed in Spark.

Edge cases: texts that are null or have no letter are ``und`` with score 0; ties go to the first
language by name; a run of letters is scored in stretches of 24 code points, so scripts without
blanks work; unknown characters cost the same in all languages; without any labelled row
everything is ``und``. Repeated rows each give a row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Labelled documents for each language that the fit reads, on average over hashed draws.
SAMPLE_DOCS = 300
ROUNDS = 2
STRETCH = 24
SMOOTHING = 0.05
UNKNOWN = 1e-7
CACHE_WORDS = 300_000
MARK = "▁"
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lowered runs of letters, long ones in stretches; empty if there is no letter."""
    found = _LETTERS.findall((text or "").lower())
    if not any(c.isalpha() for word in found for c in word):
        return []
    if max(map(len, found)) > STRETCH:
        found = [w[i : i + STRETCH] for w in found for i in range(0, len(w), STRETCH)]
    return found


def pieces_of(path: str = VOCABULARY) -> list[str]:
    """The pieces of a public vocabulary that lowered words can hold."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i)]
    return sorted({p for p in pieces if p == p.lower() and p.replace(MARK, "").isalpha() and MARK not in p[1:]})


class Lattice:
    """All piece positions of words; row -2 of a table stands for unknown characters, -1 for no piece."""

    def __init__(self, pieces: list[str]) -> None:
        # beginnings of pieces that are none themselves have -1, so that a search ends early
        self.ids = dict.fromkeys((p[:k] for p in pieces for k in range(1, len(p))), -1)
        self.ids.update((p, i) for i, p in enumerate(pieces))
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)

    def groups(self, words: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions of the words, ids by word, start and length) for each word length."""
        by_length: dict[int, list[int]] = {}
        marked = [MARK + w for w in words]
        for at, word in enumerate(marked):
            by_length.setdefault(len(word), []).append(at)
        get = self.ids.get
        for m, places in by_length.items():
            width = min(m, self.longest)
            for cut in range(0, len(places), 4096):
                chosen = places[cut : cut + 4096]
                flat, value = [], []
                for row, at in enumerate(chosen):
                    word = marked[at]
                    for j in range(m):
                        base = (row * m + j) * width - 1
                        for k in range(1, min(width, m - j) + 1):
                            found = get(word[j : j + k])
                            if found is None:
                                break
                            if found >= 0:
                                flat.append(base + k)
                                value.append(found)
                ids = np.full(len(chosen) * m * width, self.none, np.int32)
                ids[flat] = value
                ids = ids.reshape(len(chosen), m, width)
                ids[:, :, 0][ids[:, :, 0] == self.none] = self.unknown
                yield np.array(chosen), ids


def forward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability of the first i characters, for every i, summed over all segmentations."""
    n, m, width = ids.shape
    out = np.zeros((n, m + 1, table.shape[1]))
    out[:, 0] = 1.0
    for i in range(1, m + 1):
        for k in range(1, min(width, i) + 1):
            out[:, i] += out[:, i - k] * table[ids[:, i - k, k - 1]]
    return out


def backward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    n, m, width = ids.shape
    out = np.zeros((n, m + 1, table.shape[1]))
    out[:, m] = 1.0
    for j in range(m - 1, -1, -1):
        for k in range(1, min(width, m - j) + 1):
            out[:, j] += table[ids[:, j, k - 1]] * out[:, j + k]
    return out


def expected(words: list[str], counts: np.ndarray, lattice: Lattice, table: np.ndarray | None) -> np.ndarray:
    """Expected uses of each piece (rows) by language (columns); without a table, all occurrences."""
    total = np.zeros((lattice.none + 1, counts.shape[1]))
    for places, ids in lattice.groups(words):
        weight = counts[places]
        ahead, behind = (forward(ids, table), backward(ids, table)) if table is not None else (None, None)
        for j in range(ids.shape[1]):
            for k in range(1, min(ids.shape[2], ids.shape[1] - j) + 1):
                at = ids[:, j, k - 1]
                share = weight
                if table is not None:
                    share = weight * ahead[:, j] * table[at] * behind[:, j + k] / ahead[:, -1]
                np.add.at(total, at, share)
    total[lattice.unknown :] = 0
    return total


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # probabilities by piece and language, then the unknown and the empty row


def _table(counts: np.ndarray) -> np.ndarray:
    table = counts + SMOOTHING
    table[-2:] = 0
    table /= table.sum(axis=0)
    table[-2] = UNKNOWN
    return table


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words, n = np.unique(np.array(words_of(text), dtype=object).astype(str), return_counts=True)
            rows.append(pd.DataFrame({"lang": lang, "word": words.astype(object), "n": n}))
        if rows:
            yield pd.concat(rows).groupby(["lang", "word"], as_index=False)["n"].sum()


def _expect(shared, vocabulary):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        languages, table = shared.value
        lattice = Lattice(vocabulary.value)
        place = {name: i for i, name in enumerate(languages)}
        total = np.zeros((lattice.none + 1, len(languages)))
        for batch in batches:
            counts = np.zeros((len(batch), len(languages)))
            counts[np.arange(len(batch)), batch["lang"].map(place)] = batch["n"]
            total += expected(batch["word"].tolist(), counts, lattice, table)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

    return run


def fit(labelled: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model:
    """Fit on ``labelled`` (text, lang and doc_id, of which a hash draws the sample)."""
    spark = labelled.sparkSession
    bound_batches(spark)
    known = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages, pieces = sorted(sizes), pieces_of(vocabulary)
    lattice = Lattice(pieces)
    table = np.zeros((lattice.none + 1, len(languages)))
    if not languages:
        return Model([], pieces, table)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample_docs / sizes[name]))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    words = (
        known.where(draw < F.element_at(share, F.col("lang")))
        .select("lang", "text")
        .mapInPandas(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .repartition(12, "word")
        .persist()
    )
    shared_pieces = spark.sparkContext.broadcast(pieces)
    state = None
    for _ in range(rounds + 1):
        step = spark.sparkContext.broadcast((languages, state))
        sums = (
            words.mapInPandas(_expect(step, shared_pieces), "piece int, lang int, n double")
            .groupBy("piece", "lang")
            .agg(F.sum("n").alias("n"))
            .toPandas()  # at most one row for each piece and language
        )
        table = np.zeros((lattice.none + 1, len(languages)))
        table[sums["piece"], sums["lang"]] = sums["n"]
        state = table = _table(table)
    words.unpersist()
    return Model(languages, pieces, table)


def letters_of(model: Model) -> list[str]:
    """The letters of all pieces that the fit met in any language."""
    table = model.table[: len(model.pieces)]
    # a piece that was not met has the least probability, that of smoothing
    met = (table > table.min(axis=0) * (1 + 1e-9)).any(axis=1)
    return sorted({c for piece, seen in zip(model.pieces, met, strict=True) if seen for c in piece if c.isalpha()})


class Scorer:
    """Log probabilities of words, remembered up to a bound."""

    def __init__(self, languages: list[str], pieces: list[str], table: np.ndarray) -> None:
        self.lattice, self.table = Lattice(pieces), table
        self.known: dict[str, int] = {}
        self.logs = np.empty((0, len(languages)))

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        fresh = list(dict.fromkeys(w for words in texts for w in words if w not in self.known))
        if fresh:
            logs = np.empty((len(fresh), self.logs.shape[1]))
            for places, ids in self.lattice.groups(fresh):
                logs[places] = np.log(forward(ids, self.table)[:, -1])
            first, last = len(self.known), len(self.known) + len(fresh)
            if last > len(self.logs):
                self.logs = np.concatenate((self.logs, np.empty((last, self.logs.shape[1]))))
            self.logs[first:last] = logs
            self.known.update(zip(fresh, range(first, last), strict=True))
        get = self.known.__getitem__
        return np.array([self.logs[np.fromiter(map(get, w), np.int64, len(w))].sum(axis=0) for w in texts])


def predictor(model: Model, spark) -> Column:
    """A function of a text column that gives a struct (lang, score)."""
    # the dict is a worker's own: what one task has scored serves the next
    shared = spark.sparkContext.broadcast(((model.languages, model.pieces, model.table), {}))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, kept = shared.value
        languages = own[0]
        scorer = None
        if languages:
            scorer = kept["scorer"] = kept.get("scorer") or Scorer(*own)
        for batch in batches:
            names, scores = [], []
            for at in range(0, len(batch), 256):
                texts = [words_of(t) for t in batch.iloc[at : at + 256]]
                totals = scorer.totals(texts) if scorer else None
                for i, words in enumerate(texts):
                    if not words or totals is None:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(totals[i]))
                    names.append(languages[best])
                    scores.append(float(1 / np.exp(totals[i] - totals[i][best]).sum()))
            yield pd.DataFrame({"lang": names, "score": scores})

    # so that a filter on the prediction does not make Spark evaluate it twice
    return predict.asNondeterministic()


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with lang_pred and score from the text alone."""
    bound_batches(docs.sparkSession)
    predict = predictor(model, docs.sparkSession)
    return (
        docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), predict("text").alias("p"))
        .select("row", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
    )
