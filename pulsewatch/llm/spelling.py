"""Grouping of spelling variants with k-d trees over letter counts.

A word is a run of letters of Basic Latin and Latin-1, A-Z lowered; before counting, one code point
goes from the runs that a hash picks. The vocabulary holds words of ``least_length`` code points and
``least_count`` occurrences or more. Two words are near if one inserted, deleted or replaced code
point tells them apart. Their letter counts then lie within an L1 distance of two: a replacement
takes one letter and adds one, an insertion adds one. Each word asks the words of its own length and
those one longer: a k-d tree over the counts of each length gives the cells whose boxes lie in
reach, a second tree inside the cell gives the words in reach, and the order of the letters decides.

Scale: only the vocabulary moves, never the texts. The upper trees are fitted on a bounded sample of
the vocabulary (SAMPLE words a cell, at most MAX_CELLS cells a length), which decides how words are
dealt and never what is found. A word goes to the few cells in its reach; a task holds the words of
one cell and reads those that ask batch by batch. Words with equal counts (anagrams) are one point of
the tree, and are checked by a hash on (place, rest), so their number costs no square. A word has at
most some 90 times its length near words, which bounds every group behind.

Edge cases: null and empty texts have no words; repeated rows each count; a null doc_id counts as an
empty one in the hash; long texts and long words are taken whole; of near words with equal counts the
first in code-point order is the form; an empty table gives an empty result. Other columns of the
documents are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, stored

MODULUS = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
CELL = 32768  # words of a cell that the upper trees aim at
SAMPLE = 64  # words of the sample for each cell
MAX_CELLS = 1024  # cells of one length
MAX_LENGTHS = 1024  # lengths with more than one cell
LEAF = 64  # points of a leaf of the inner trees
ASKED = 16384  # words that ask at once
ANAGRAMS = 2048  # word pairs of two letter counts that are compared one by one; more meet by a hash
HELD = 1 << 18  # words that a task counts before it hands the counts on

#: Bytes of Latin-1: A-Z lowered, letters kept, all else blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_DIMS = 26 + 64
_DIM = np.zeros(256, np.int64)
_DIM[97:123] = np.arange(26)
_DIM[0xC0:] = np.arange(26, _DIMS)


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each letter occurs in each word."""
    if not words:
        return np.zeros((0, _DIMS), np.int8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = _DIM[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    rows = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(rows * _DIMS + letters, minlength=len(words) * _DIMS).reshape(len(words), _DIMS)
    return counts.astype(np.int8 if lengths.max() < 120 else np.int32)


class Codes:
    """Letter counts as bits: one for each letter and each count up to the highest that it has here.

    The letters that one vector has beyond another are then the bits of ``this & ~other``.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.highest = counts.max(0) if len(counts) else np.zeros(_DIMS, np.int8)
        self.dims = np.repeat(np.arange(_DIMS), self.highest)
        self.levels = np.concatenate([np.zeros(0, np.int64), *[np.arange(1, h + 1) for h in self.highest if h]])
        self.words = max(1, -(-len(self.dims) // 64))

    def packed(self, bits: np.ndarray) -> np.ndarray:
        full = np.zeros((len(bits), self.words * 64), bool)
        full[:, : bits.shape[1]] = bits
        return np.packbits(full, axis=1, bitorder="little").view(np.uint64)

    def encode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each vector, and how many letters it has beyond them."""
        beyond = np.maximum(counts.astype(np.int64) - self.highest, 0).sum(1)
        return self.packed(counts[:, self.dims] >= self.levels), beyond

    def from_level(self, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """The bits of the same letter up to this one, and from this one on."""
        same = self.dims == self.dims[bit]
        upto = same & (self.levels <= self.levels[bit])
        return self.packed(upto[None])[0], self.packed((same & (self.levels >= self.levels[bit]))[None])[0]


def beyond(these: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Letters that ``these`` have beyond ``others``."""
    return np.bitwise_count(these & ~others).sum(-1, dtype=np.int64)


class KdTree:
    """Boxes over letter counts, each cut where a count of a letter halves its points most evenly.

    Tight boxes hold the given points; else they fill the space, so that each vector has one leaf.
    """

    def __init__(self, codes: Codes, points: np.ndarray, leaf: int, tight: bool) -> None:
        self.codes, self.points = codes, points
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.below: list[list[int]] = []
        self.members: list[np.ndarray] = []
        self.leaf_of: list[int] = []
        self.leaves = 0
        none, all_of = np.zeros(codes.words, np.uint64), np.full(codes.words, ~np.uint64(0))
        todo = [(np.arange(len(points)), none, all_of, -1)]
        while todo:
            rows, low, high, parent = todo.pop()
            node = len(self.low)
            if parent >= 0:
                self.below[parent].append(node)
            if tight and len(rows):
                low, high = np.bitwise_and.reduce(points[rows]), np.bitwise_or.reduce(points[rows])
            self.low.append(low)
            self.high.append(high)
            self.below.append([])
            bit = self._cut(points[rows]) if len(rows) > leaf else None
            self.leaf_of.append(self.leaves if bit is None else -1)
            self.leaves += bit is None
            self.members.append(rows if bit is None else rows[:0])
            if bit is None:
                continue
            has = (points[rows, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
            upto, onward = codes.from_level(bit)
            todo.append((rows[has], low | upto, high, node))
            todo.append((rows[~has], low, high & ~onward, node))

    @staticmethod
    def _cut(held: np.ndarray) -> int | None:
        share = np.unpackbits(np.ascontiguousarray(held).view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        bit = int(np.argmin(np.abs(2 * share - len(held))))
        return bit if 0 < share[bit] < len(held) else None

    def reach(self, asked: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes of leaves and the rows of ``asked`` that come into their box by ``more`` letters
        added and ``less`` taken away at most."""
        todo = [(0, np.arange(len(asked)))]
        while todo:
            node, rows = todo.pop()
            held = asked[rows]
            rows = rows[(beyond(self.low[node], held) <= more) & (beyond(held, self.high[node]) <= less)]
            if not len(rows):
                continue
            if self.below[node]:
                todo += [(below, rows) for below in self.below[node]]
            else:
                yield node, rows


def alike(codes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first row of each different vector; all rows vector by vector, and where those of each start."""
    keys = np.ascontiguousarray(np.column_stack([codes, more.astype(np.uint64)]))
    whole = keys.view(np.dtype((np.void, keys.dtype.itemsize * keys.shape[1]))).ravel()
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    return first, np.argsort(which, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(which))))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), len(words[0]))


class Cell:
    """The words of one cell, all of one length, asked for their near words."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.n = dict(zip(words, counts, strict=True))
        self.words, self.letters = words, letters(words)
        vectors = letter_counts(words)
        self.codes = Codes(vectors)
        points, over = self.codes.encode(vectors)
        first, self.rows, self.starts = alike(points, over)
        self.points, self.vectors = points[first], vectors[first]
        self.tree = KdTree(self.codes, self.points, LEAF, tight=True)

    def near(self, asked: list[str], longer: bool) -> Iterator[tuple[str, str]]:
        """(word asked for, near word): words of its length behind it in order, or words one longer."""
        vectors = letter_counts(asked)
        less = 0 if longer else 1
        codes, over = self.codes.encode(vectors)
        able = np.flatnonzero(over <= less)
        if not len(able):
            return
        first, rows, starts = alike(codes[able], over[able])
        rows, codes, over, vectors = able[rows], codes[able][first], over[able][first], vectors[able][first]
        own = letters(asked)
        for node, some in self.tree.reach(codes, 1, less):
            members = self.tree.members[node]
            points = self.points[members]
            step = max(1, (1 << 20) // (len(members) * self.codes.words))
            for at in range(0, len(some), step):
                part = some[at : at + step]
                added = beyond(points[None], codes[part][:, None])
                taken = beyond(codes[part][:, None], points[None]) + over[part][:, None]
                q, p = np.nonzero((added == 1) & (taken == less))
                q, p = part[q], members[p]
                wide = starts[q + 1] - starts[q]
                high = self.starts[p + 1] - self.starts[p]
                many = wide * high > ANAGRAMS
                for i, j in zip(q[many].tolist(), p[many].tolist(), strict=True):
                    gap = self.vectors[j].astype(np.int32) - vectors[i]
                    words = [asked[k] for k in rows[starts[i] : starts[i + 1]]]
                    others = [self.words[k] for k in self.rows[self.starts[j] : self.starts[j + 1]]]
                    yield from one_edit(words, others, None if longer else letter_at(int(gap.argmin())), letter_at(int(gap.argmax())))
                q, p, wide, high = q[~many], p[~many], wide[~many], high[~many]
                ends = np.cumsum(wide * high)
                todo = np.flatnonzero(np.diff(ends // max(1, (1 << 22) // own.shape[1]), append=-1))
                for cut, end in zip([0, *(todo + 1).tolist()], (todo + 1).tolist(), strict=False):
                    hit = slice(cut, end)
                    size = (wide * high)[hit]
                    which = np.repeat(np.arange(len(size)), size)
                    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                    x = rows[starts[q[hit]][which] + place // high[hit][which]]
                    y = self.rows[self.starts[p[hit]][which] + place % high[hit][which]]
                    good = one_longer(own[x], self.letters[y]) if longer else (own[x] != self.letters[y]).sum(1) == 1
                    for i, j in zip(x[good].tolist(), y[good].tolist(), strict=True):
                        if longer or asked[i] < self.words[j]:
                            yield asked[i], self.words[j]


def one_longer(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one with one letter put in: what both start and end with covers it."""
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= short.shape[1]


def letter_at(dim: int) -> str:
    return chr(97 + dim) if dim < 26 else chr(0xC0 + dim - 26)


def one_edit(words: list[str], others: list[str], minus: str | None, plus: str) -> Iterator[tuple[str, str]]:
    """Pairs in which ``plus`` in place of ``minus`` (or put in, if that is None) makes the other word."""
    rests: dict[tuple[int, str], list[str]] = {}
    for word in words:
        for at in (0,) if minus is None else places(word, minus):
            rests.setdefault((at, word if minus is None else word[:at] + word[at + 1 :]), []).append(word)
    for other in others:
        found = (rests.get((0 if minus is None else at, other[:at] + other[at + 1 :]), ()) for at in places(other, plus))
        for word in sorted({w for ws in found for w in ws if minus is None or w < other}):
            yield word, other


def places(word: str, letter: str) -> Iterator[int]:
    at = word.find(letter)
    while at >= 0:
        yield at
        at = word.find(letter, at + 1)


def counted_runs(doc_id: str, text: str, modulus: int) -> Counter[bytes]:
    """Runs of letters as Latin-1, one code point dropped from those that the hash picks."""
    found = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    out: Counter[bytes] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % modulus == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def _count(modulus: int):
    def handed(held: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                held.update(counted_runs(doc_id.as_py(), text.as_py(), modulus))
                if len(held) >= HELD:
                    yield handed(held)
                    held.clear()
        yield handed(held)

    return run


def word_counts(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """(word, n) over all runs of all texts; each task adds up what it has before the words move."""
    bound_batches(docs.sparkSession)
    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return texts.mapInArrow(_count(modulus), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def upper_trees(vocabulary: DataFrame, cell: int = CELL) -> dict[int, KdTree]:
    """A tree that fills the space for each length with more words than a cell is to hold."""
    sizes = (
        vocabulary.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
        .orderBy(F.desc("n"), "length").limit(MAX_LENGTHS).collect()
    )
    if not sizes:
        return {}
    cells = {r["length"]: min(MAX_CELLS, -(-r["n"] // cell)) for r in sizes}
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["length"], min(1.0, cells[r["length"]] * SAMPLE / r["n"]))])
    picked = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.get(F.array(share), F.lit(0))[F.col("length")] * (1 << 20)
    held: dict[int, list[str]] = {}
    for row in vocabulary.where(picked).select("length", "word").collect():
        held.setdefault(row["length"], []).append(row["word"])
    trees = {}
    for length, words in held.items():
        vectors = letter_counts(sorted(words))
        codes = Codes(vectors)
        trees[length] = KdTree(codes, codes.encode(vectors)[0], max(1, -(-len(words) // cells[length])), tight=False)
    return trees


def _dealt(trees: dict[int, KdTree]):
    """Each word to its own cell (kind 0) and to those in its reach: of its length (1), of the next (2)."""

    def leaves(length: int, words: list[str], more: int, less: int) -> Iterator[tuple[int, int]]:
        tree = trees.get(length)
        if tree is None:
            yield from ((0, i) for i in range(len(words)))
            return
        for node, rows in tree.reach(tree.codes.encode(letter_counts(words))[0], more, less):
            yield from ((tree.leaf_of[node], int(i)) for i in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            words = batch.column("word").to_pylist()
            for i, word in enumerate(words):
                by_length.setdefault(len(word), []).append(i)
            lengths, cells, kinds, rows = [], [], [], []
            for length, mine in by_length.items():
                some = [words[i] for i in mine]
                for kind, (of, more, less) in enumerate(((length, 0, 0), (length, 1, 1), (length + 1, 1, 0))):
                    for leaf, i in leaves(of, some, more, less):
                        lengths.append(of)
                        cells.append(leaf)
                        kinds.append(kind)
                        rows.append(mine[i])
            picked = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(cells, pa.int32()), pa.array(kinds, pa.int32()), picked.column("word"), picked.column("n")],
                names=["of", "leaf", "kind", "word", "n"],
            )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs; the rows of a cell come one after the other, its own words first."""
    at: tuple[int, int] | None = None
    words: list[str] = []
    counts: list[int] = []
    cell: Cell | None = None
    asked: dict[int, dict[str, int]] = {1: {}, 2: {}}

    def answered(kind: int) -> pa.RecordBatch:
        n = asked[kind]
        pairs = list(cell.near(list(n), kind == 2))
        asked[kind] = {}
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _ in pairs], pa.string()),
                pa.array([n[a] for a, _ in pairs], pa.int64()),
                pa.array([b for _, b in pairs], pa.string()),
                pa.array([cell.n[b] for _, b in pairs], pa.int64()),
            ],
            names=["a", "n_a", "b", "n_b"],
        )

    for batch in batches:
        for of, leaf, kind, word, n in zip(*[batch.column(c).to_pylist() for c in ("of", "leaf", "kind", "word", "n")], strict=True):
            if (of, leaf) != at:
                for k in (1, 2):
                    if asked[k]:
                        yield answered(k)
                at, words, counts, cell = (of, leaf), [], [], None
            if kind == 0:
                words.append(word)
                counts.append(n)
                continue
            if not words:  # a cell without words of its own
                continue
            if cell is None:
                cell = Cell(words, counts)
            asked[kind][word] = n
            if len(asked[kind]) >= ASKED:
                yield answered(kind)
    for k in (1, 2):
        if asked[k]:
            yield answered(k)


def near_pairs(vocabulary: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words once. ``vocabulary`` has distinct words, n and length."""
    dealt = vocabulary.select("word", "n").mapInArrow(
        _dealt(upper_trees(vocabulary, cell)), "of int, leaf int, kind int, word string, n long"
    )
    # dealt to a number of tasks that does not follow the bytes, which are few for the work
    tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = dealt.repartition(tasks, "of", "leaf").sortWithinPartitions("of", "leaf", "kind")
    return cells.mapInArrow(_meet, "a string, n_a long, b string, n_b long")


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    modulus: int = MODULUS,
    cell: int = CELL,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the vocabulary of ``docs`` (doc_id, text).

    The form is the near word with the most occurrences, if it has ``ratio`` times those of the word;
    the root is where the forms lead.
    """
    counted = word_counts(docs, modulus).withColumn("length", F.length("word"))
    vocabulary = stored(counted.where((F.col("length") >= least_length) & (F.col("n") >= least_count)), "vocabulary")
    pairs = stored(near_pairs(vocabulary, cell), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    nearest = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("top")
    )
    found = vocabulary.join(nearest, "word", "left")
    enough = -F.col("top.less") >= ratio * F.col("n")
    found = stored(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("top.form")).alias("form"), F.when(enough, -F.col("top.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """Follow steps to their ends by doubling; occurrences grow along them, so there is no way back."""
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        steps = stored(
            steps.join(further, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
            "roots",
        )
        if steps.where("moved").isEmpty():
            return steps.drop("moved")
        steps = steps.drop("moved")
