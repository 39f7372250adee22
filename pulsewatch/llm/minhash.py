"""Near-duplicate documents by min-max hashing.

A document's set is its distinct word shingles, hashed to 64 bits. Under each permutation both the
minimum and the maximum are kept, so a signature of 96 values costs 48 evaluations; both match with
the probability of the Jaccard similarity. The values are banded by four: at a similarity of 0.85
a pair shares no band with a probability of 0.478**24, about 2e-8.

Scale: equal sets collapse to one representative first. In a bucket nobody meets everybody: each
member is compared with the most central one (whose buckets hold most members, so in a group of
copies the text that the others were made from). What is left are buckets with several components.
A shingle that only one document has can be in no intersection, and the overlap with the bucket's
hub is known; both bound the overlap of a pair from above, exactly. Only pairs that these bounds
allow and that no link joins yet are compared. Every link is confirmed on the full sets.

Edge cases: null or blank texts have an empty set and link with nothing; very long texts are taken whole;
an empty table gives an empty result. Rows that repeat a doc_id with different texts are a node for each
text, tied to each other afterwards; each row is returned. A null doc_id links with nothing, has a null
component and is kept. The smallest doc_id names a component, so there are no ties. Other columns of the
documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import bound_batches, spread, stored
from pulsewatch.llm.components import components

SHINGLE = 3
BANDS, ROWS = 24, 4
NUMER, DENOM = 85, 100
SEGMENT = 1 << 18  # bytes hashed at once

_U = np.uint64
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(n, base, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


def word_hashes(data: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of blank-separated, lowered bytes."""
    hashes, starts, at = [np.empty(0, _U)], [np.empty(0, np.int64)], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        if end < len(data):
            piece = np.frombuffer(data, np.uint8, end - at, at)
            blanks = np.flatnonzero(_SPACE[piece])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:  # one word beyond the segment: up to its end
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        piece = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.concatenate(([False], ~_SPACE[piece], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edge[::2], edge[1::2]
        up, down = powers.upto(len(piece) + 1)
        total = np.concatenate((np.zeros(1, _U), np.cumsum((piece.astype(_U) + _U(1)) * up[:-1])))
        h = (total[last] - total[first]) * down[first]
        hashes.append(mix(h ^ (last - first).astype(_U) * _U(0x9E3779B97F4A7C15)))
        starts.append(first + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str | None], k: int, powers: Powers) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    group: list[bytes] = []

    def flush() -> None:
        if not group:
            return
        offsets = np.cumsum([0] + [len(x) + 1 for x in group])
        h, starts = word_hashes(b" ".join(group), powers)
        cut = np.searchsorted(starts, offsets)
        rolled = np.full(max(0, len(h) - k + 1), k, _U)
        for j in range(k):
            rolled = mix(rolled * _U(0x9E3779B97F4A7C15) + h[j : j + len(rolled)])
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            n = b - a
            if n >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif n:
                one = np.full(1, n, _U)
                for j in range(a, b):
                    one = mix(one * _U(0x9E3779B97F4A7C15) + h[j])
                out.append(one)
            else:
                out.append(np.empty(0, _U))
        group.clear()

    size = 0
    for text in texts:
        group.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(group[-1])
        if size >= SEGMENT:
            flush()
            size = 0
    flush()
    return out


def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, n, dtype=_U) * _U(2) + _U(1)


def band_keys(items: np.ndarray, factors: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band over the minima and maxima of every permutation of a set."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, _U)
    high = np.zeros(len(factors), _U)
    for at in range(0, len(items), 4096):
        image = items[None, at : at + 4096] * factors[:, None]
        np.minimum(low, image.min(axis=1), out=low)
        np.maximum(high, image.max(axis=1), out=high)
    values = np.stack([low, high], axis=1).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=_U)
    for j in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + values[:, j])
    return key


def _sketch(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, factors = Powers(), multipliers(bands * rows // 2)
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), k, powers)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            one = np.fromiter((int(mix(s).sum()) for s in sets), _U, len(sets)).view(np.int64)
            two = np.fromiter((int(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum()) for s in sets), _U, len(sets)).view(np.int64)
            keys = [band_keys(s, factors, bands, rows) if len(s) else np.empty(0, _U) for s in sets]
            offsets = np.cumsum([0] + [len(x) for x in keys]).astype(np.int32)
            flat = np.concatenate([np.empty(0, _U), *keys]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(one), pa.array(two), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "n", "one", "two", "keys"],
            )

    return run


def _tokens(k: int):
    """A row for each document and shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            docs, texts = batch.column("doc"), batch.column("text")
            for at in range(0, len(docs), 256):
                sets = shingle_sets(texts.slice(at, 256).to_pylist(), k, powers)
                which = np.repeat(np.arange(at, at + len(sets)), [len(s) for s in sets])
                flat = np.concatenate([np.empty(0, _U), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([docs.take(pa.array(which)), pa.array(flat)], names=["doc", "token"])

    return run


def _confirm(k: int, numer: int, denom: int):
    """Size of the intersection of the full sets, and whether they are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left = shingle_sets(part.column("text_a").to_pylist(), k, powers)
                right = shingle_sets(part.column("text_b").to_pylist(), k, powers)
                common, similar = [], []
                for x, y in zip(left, right, strict=True):
                    both = np.sort(np.concatenate((x, y)))
                    n = int((both[1:] == both[:-1]).sum())
                    common.append(n)
                    similar.append(n > 0 and denom * n >= numer * (len(x) + len(y) - n))
                columns = [part.column("a"), part.column("b"), pa.array(common, pa.int64()), pa.array(similar, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "common", "similar"])

    return run


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    numer: int = NUMER,
    denom: int = DENOM,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Documents link if denom * |intersection| >= numer * |union|; the smallest doc_id that links
    reach names the component and stays.
    """
    bound_batches(docs.sparkSession)
    if not _ids_repeat(docs):
        return _nodes(docs.select("doc_id", "text"), shingle, bands, rows, numer, denom)
    # a node for each text of a doc_id; the smallest node of a component has its smallest doc_id
    keyed = docs.where("doc_id is not null").select(F.struct(F.col("doc_id").alias("id"), _part().alias("part")).alias("doc_id"), "text")
    nodes = stored(_nodes(keyed, shingle, bands, rows, numer, denom).drop("kept"), "text-nodes")
    texts = nodes.select(F.col("doc_id.id").alias("id"), "component_id").distinct()
    least = texts.groupBy("id").agg(F.min("component_id").alias("b"))
    tied = texts.join(least, "id").select(F.col("component_id").alias("a"), "b").where("a <> b")
    groups = components(tied, "same-id").withColumnRenamed("node", "component_id")
    found = nodes.join(groups, "component_id", "left").select(
        F.col("doc_id.id").alias("doc_id"), "n_shingles", F.coalesce("component", "component_id")["id"].alias("component_id")
    )
    found = found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return found.unionByName(_nodes(docs.where("doc_id is null").select("doc_id", "text"), shingle, bands, rows, numer, denom))


def _part() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def _ids_repeat(docs: DataFrame) -> bool:
    """Whether a doc_id stands at different texts."""
    ids = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"))
    bounds = ids.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return not bounds.where("low <> high").isEmpty()


def _nodes(source: DataFrame, shingle: int, bands: int, rows: int, numer: int, denom: int) -> DataFrame:
    """``near_duplicates`` where equal ids have equal texts."""
    kind = source.schema["doc_id"].dataType.simpleString()
    sketches = stored(
        source.mapInArrow(
            _sketch(shingle, bands, rows), f"doc_id {kind}, n long, one long, two long, keys array<long>"
        ),
        "sketches",
    )
    sets = sketches.where("n > 0 and doc_id is not null").withColumn("set", F.concat_ws(":", "one", "two", "n"))
    copies = stored(sets.groupBy("set").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("m")), "copies")
    placed = stored(
        spread(sets, copies.withColumnRenamed("m", "n").select("set", "rep", "n"), "set", sets.count()).select(
            "doc_id", "rep", "n", F.when(F.col("doc_id") == F.col("rep"), F.col("keys")).alias("keys")
        ),
        "placed",
    )
    links = _bucket_links(source, placed, shingle, numer, denom)
    groups = components(links, "near")
    found = placed.select("doc_id", "rep").distinct().join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    return (
        sketches.select("doc_id", F.col("n").alias("n_shingles"))
        .join(found, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _bucket_links(source: DataFrame, placed: DataFrame, shingle: int, numer: int, denom: int) -> DataFrame:
    """Confirmed links between representatives that join all that any link within a bucket joins."""
    rows = placed.where("keys is not null").select(F.col("rep").alias("doc"), F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    buckets = stored(rows.join(shared, "key"), "buckets")
    central = buckets.groupBy("doc").agg(F.sum("m").alias("weight"))
    weighed = buckets.join(central, "doc")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", "doc")).alias("h"))
    to_hub = _pairs(buckets.join(hubs.select("key", F.col("h.doc").alias("other")), "key"))

    sizes = placed.where("keys is not null").select(F.col("rep").alias("doc"), "n")
    texts = stored(
        source.withColumnRenamed("doc_id", "doc")
        .join(central.select("doc"), "doc", "left_semi")
        .groupBy("doc")
        .agg(F.min("text").alias("text")),
        "candidates",
    )
    compared = _confirmed(to_hub, texts, shingle, numer, denom, "hub-links")
    first = compared.where("similar").select("a", "b")

    # buckets in which the links found so far leave several components
    groups = components(first, "hub")
    member = (
        buckets.join(groups.withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn("component", F.coalesce("component", "doc"))
        .join(sizes, "doc")
    )
    split = _mixed(member)
    kind = source.schema["doc_id"].dataType.simpleString()
    open_docs = split.select("doc").distinct()
    tokens = texts.join(open_docs, "doc", "left_semi").mapInArrow(_tokens(shingle), f"doc {kind}, token long")
    lonely = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("doc").alias("doc")).where("m = 1")
    alone = lonely.groupBy("doc").agg(F.count(F.lit(1)).alias("alone"))
    # ``most``: shingles that can be in an intersection at all; ``on_hub`` of them are the hub's too,
    # ``off_hub`` are not. Two documents share at most the lesser of each.
    hub_of = split.join(hubs.select("key", F.col("h.doc").alias("hub")), "key")
    hub_of = hub_of.withColumn("a", F.least("doc", "hub")).withColumn("b", F.greatest("doc", "hub"))
    able = (
        hub_of.join(compared.drop("similar"), ["a", "b"], "left")
        .join(alone, "doc", "left")
        .withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
        .where(F.lit(denom) * F.col("most") >= F.lit(numer) * F.col("n"))
        .withColumn("on_hub", F.when(F.col("doc") == F.col("hub"), F.col("most")).otherwise(F.col("common")))
        .withColumn("off_hub", F.greatest(F.col("most") - F.col("on_hub"), F.lit(0)))
        .select("key", "doc", "component", "n", "on_hub", "off_hub")
    )
    every_key = placed.where("keys is not null").select(F.col("rep").alias("doc"), "keys")
    able = stored(_mixed(able).join(every_key, "doc"), "open-buckets")
    other = able.select("key", *[F.col(c).alias(f"{c}_2") for c in ("doc", "component", "n", "on_hub", "off_hub", "keys")])
    shared_most = F.least("on_hub", "on_hub_2") + F.least("off_hub", "off_hub_2")
    # a pair that shares several buckets is taken from the first of them
    rest = able.join(other, "key").where(
        (F.col("doc") < F.col("doc_2"))
        & (F.col("component") != F.col("component_2"))
        & (F.lit(numer + denom) * shared_most >= F.lit(numer) * (F.col("n") + F.col("n_2")))
        & (F.array_min(F.array_intersect("keys", "keys_2")) == F.col("key"))
    )
    second = _confirmed(rest.select(F.col("doc").alias("a"), F.col("doc_2").alias("b")), texts, shingle, numer, denom, "more-links")
    return first.unionByName(second.where("similar").select("a", "b"))


def _mixed(member: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    mixed = (
        member.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key")
    )
    return member.join(mixed, "key", "left_semi")


def _pairs(rows: DataFrame) -> DataFrame:
    return (
        rows.where("doc <> other").select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, numer: int, denom: int, label: str) -> DataFrame:
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    kind = texts.schema["doc"].dataType.simpleString()
    return stored(
        pairs.join(left, "a")
        .join(right, "b")
        .mapInArrow(_confirm(shingle, numer, denom), f"a {kind}, b {kind}, common long, similar boolean"),
        label,
    )


def deduplicated(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    numer: int = NUMER,
    denom: int = DENOM,
) -> DataFrame:
    """The columns of ``docs``: one row for each component, and all rows without a doc_id.

    Where a doc_id repeats with different texts, each of its texts is a document.
    """
    with_id = docs.where("doc_id is not null")
    if not _ids_repeat(docs):
        kept = _nodes(docs.select("doc_id", "text"), shingle, bands, rows, numer, denom).where("kept").select("doc_id").distinct()
        one = with_id.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    else:
        keyed = with_id.select(F.struct(F.col("doc_id").alias("id"), _part().alias("part")).alias("doc_id"), "text")
        kept = _nodes(keyed, shingle, bands, rows, numer, denom).where("kept").select("doc_id.id", "doc_id.part").distinct()
        named = with_id.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), _part().alias("part"))
        one = named.join(kept, ["id", "part"], "left_semi").dropDuplicates(["id", "part"]).select("row.*")
    return one.select(*docs.columns).unionByName(docs.where("doc_id is null"))
