"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Words are runs of digits, a-z and everything beyond ASCII, after A-Z are lowered. An item gives
all its windows of ``window`` consecutive words, or one shorter window if it has fewer words. The
automaton holds the windows as bytes with single blanks between and around the words. It reads a
text once, in the same form; an end position in that form is mapped to a word, a word to bytes of
the original text, and those to code points.

Edge cases: a null text has no words and is never contaminated; null items or items without words
give no window; items with the same window are all counted; repeated rows of documents each give
a row; other columns of the documents are not read, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, widened

WINDOW = 13
#: Bytes of items in one automaton (some 30 bytes of memory for each byte of each window); what
#: lies beyond goes into further automata that the same pass asks one after the other.
AUTOMATON_BYTES = 500_000

# every byte that is no word byte becomes a blank, A-Z become a-z; bytes from 0x80 are words
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(text: str, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if not words:
        return set()
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def automaton(items: list[tuple[str, str]], window: int = WINDOW) -> ahocorasick.Automaton | None:
    """Window string to (its number of words, the items that hold it)."""
    held: dict[tuple[bytes, ...], list[str]] = {}
    for item_id, text in items:
        for words in windows_of(text, window):
            held.setdefault(words, []).append(item_id)
    if not held:
        return None
    machine = ahocorasick.Automaton()
    for words, ids in held.items():
        machine.add_word((b" " + b" ".join(words) + b" ").decode("latin-1"), (len(words), tuple(ids)))
    machine.make_automaton()
    return machine


def scan(text: str, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit word ranges [first, last], and items found in one text."""
    words = words_of(text)
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    ends = None
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    for at, (n, ids) in machine.iter(line):
        if ends is None:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        last = int(np.searchsorted(ends, at))
        ranges.append((last - n + 1, last))
        items.update(ids)
    return len(words), ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def spans_in(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges as [start, end) in code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    lowered = np.frombuffer(raw.translate(_TABLE), np.uint8)
    inside = np.concatenate(([False], lowered != 32, [False]))
    step = np.flatnonzero(inside[1:] != inside[:-1])
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(points[step[2 * a]]), "end": int(points[step[2 * b + 1]])} for a, b in ranges]


_SCHEMA = "n_words long, ranges array<struct<first:long,last:long>>, items array<string>"
_CONCLUDED = ", n_hit long, items_sha256 string, spans array<struct<start:long,end:long>>"


def _pass_over(shared, window: int, keep: list[str], last: bool):
    """One automaton over the batches; what earlier automata found is in ranges and items.

    The last one adds what follows from all that was found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value, window)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            n_words, ranges, items = [], [], []
            before = zip(batch.column("ranges").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (old, had) in zip(batch.column("text"), before, strict=True):
                text = text.as_py()
                if text is None or machine is None:
                    n, new, found = len(words_of(text or "")), [], set()
                else:
                    n, new, found = scan(text, machine)
                both = merged([*((r["first"], r["last"]) for r in old or []), *new])
                n_words.append(n)
                ranges.append([{"first": a, "last": b} for a, b in both])
                items.append(sorted(found | set(had or [])))
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(n_words, pa.int64()), pa.array(ranges, kind), pa.array(items, pa.list_(pa.string()))]
            names = [*keep, "n_words", "ranges", "items"]
            if last:
                columns += _concluded(batch.column("text"), ranges, items)
                names += ["n_hit", "items_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _concluded(texts: pa.Array, ranges: list, items: list[list[str]]) -> list[pa.Array]:
    spans = [spans_in(t.as_py(), [(r["first"], r["last"]) for r in rs]) if rs else [] for t, rs in zip(texts, ranges, strict=True)]
    hit = [sum(r["last"] - r["first"] + 1 for r in rs) for rs in ranges]
    sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [pa.array(hit, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, kind)]


def find_overlap(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """Overlap of every document with the test items.

    Returns doc_id, text, n_words, items, n_hit, items_sha256, spans (code points of the original
    text that test items cover), n_items, contaminated. A document is contaminated if its hit
    words are one word in twenty or more. The documents are mapped in place: no shuffle.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = (
        benchmark.where("text is not null")
        .select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
        .distinct()
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    shards = max(1, -(-int(size) // automaton_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(shards))
    out = docs.select(
        F.col("doc_id"),
        F.col("text"),
        F.lit(None).cast("array<struct<first:long,last:long>>").alias("ranges"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    kept = out.schema.fields[:2]
    for k in range(shards):
        rows = items.where(part == k).collect()  # at most about automaton_bytes of text
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in rows])
        last = k == shards - 1
        out = out.mapInArrow(
            _pass_over(shared, window, ["doc_id", "text"], last), widened(kept, _SCHEMA + _CONCLUDED * last)
        )
    return (
        out.drop("ranges")
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of ``docs`` for the documents that are not contaminated."""
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(c) for c in columns]).alias("doc_id"), "text")
    clean = find_overlap(whole, benchmark).where("not contaminated")
    return clean.select("doc_id.*")
