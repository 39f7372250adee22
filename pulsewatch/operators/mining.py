"""Baskets, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.session import materialize


def _tagged(prefix: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(prefix), value.cast("string")))


def _item_columns(df: DataFrame, variant: str) -> list[Column]:
    """The items an incident can have, one nullable text column each."""
    if variant == "slots":
        return [
            _tagged("dow_", F.col("response_day_of_week")),
            _tagged("time_", V.time_slot(F.col("response_hour"))),
            _tagged("cat_", F.col("final_problem_category")),
        ]
    present = set(df.columns)
    found: list[Column] = []
    if "weather_category" in present:
        found.append(_tagged("Weather_", F.col("weather_category")))
    if "temp_category" in present:
        found.append(_tagged("Temp_", F.col("temp_category")))
    if "response_hour" in present:
        found.append(_tagged("Time_", V.part_of_day(F.col("response_hour"))))
    if "response_day_of_week" in present:
        day = F.col("response_day_of_week")
        found.append(F.when(day.isin("Sat", "Sun"), "Weekend").when(day.isNotNull(), "Weekday"))
    if "priority_level" in present:
        found.append(_tagged("Priority_", F.replace("priority_level", F.lit(" "), F.lit(""))))
    if "final_problem_category" in present:
        found.append(_tagged("Incident_", V.first_word(F.col("final_problem_category"))))
    if "is_festival_related" in present:
        found.append(F.when(F.col("is_festival_related"), "Festival_Related"))
    if "event_has_alcohol" in present:
        found.append(F.when(F.col("event_has_alcohol"), "Alcohol_Event"))
    return found


def _item_list(names: list[str]) -> Column:
    return F.sort_array(F.array_distinct(F.array_compact(F.array(*names))))


def _at_least(variant: str) -> int:
    return 3 if variant == "slots" else 2


def make_baskets(df: DataFrame, variant: str = "full", key: str = "incident_number") -> DataFrame:
    """One item list per incident.

    ``full`` uses weather, temperature, part of day, weekend, priority, first word
    of the category and event context, as far as the columns exist, and keeps lists
    of two or more. ``slots`` uses weekday, time slot and category and leaves out
    rows where one of them is missing.
    """
    found = _item_columns(df, variant)
    names = [f"_i{i}" for i in range(len(found))]
    tagged = df.select(key, *[c.alias(n) for c, n in zip(found, names)])
    return tagged.select(key, _item_list(names).alias("items")).where(
        F.size("items") >= _at_least(variant)
    )


def count_baskets(df: DataFrame, variant: str = "full") -> DataFrame:
    """Distinct baskets with their number of incidents.

    The rows are counted by their item columns before any list is built, so lists
    exist only once per distinct combination.
    """
    found = _item_columns(df, variant)
    names = [f"_i{i}" for i in range(len(found))]
    combos = df.select(*[c.alias(n) for c, n in zip(found, names)])
    counted = combos.groupBy(*names).agg(F.count("*").alias("n"))
    lists = counted.select(_item_list(names).alias("items"), "n")
    return (
        lists.where(F.size("items") >= _at_least(variant))
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )


def _subsets(items: str, last_mask: str, as_name: str) -> Column:
    """Explode of all bit-mask subsets of a sorted list, from mask 1 to ``last_mask``."""
    return F.expr(
        f"explode(transform(sequence(1L, {last_mask}), "
        f"m -> filter({items}, (x, i) -> getbit(m, i) = 1)))"
    ).alias(as_name)


# distinct baskets whose bits lie in one row; candidates that one pass counts
BLOCK = 1 << 16
CANDIDATES = 100_000
# a basket has 2^n - 1 subsets: beyond so many frequent items bitmaps are intersected instead
SHORT = 10


def _blocks(counted: DataFrame, items: list[str]) -> DataFrame:
    """Baskets as one bitmap an item: rows of up to BLOCK baskets with their counts.

    A basket's place is its rank in a range of baskets, so blocks need no global order.
    """
    position = {item: i for i, item in enumerate(items)}
    numbered = counted.select(
        F.transform(F.array_intersect("items", F.lit(items)), lambda x: F.array_position(F.lit(items), x) - 1).alias("at"), "n"
    )
    parts = 1 + counted.count() // BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[int], int]] = []

        def packed() -> pa.RecordBatch:
            bits = np.zeros((len(position), len(held)), bool)
            for row, (at, _) in enumerate(held):
                bits[at, row] = True
            maps = [np.packbits(line, bitorder="little").tobytes() for line in bits]
            counts = np.array([n for _, n in held], np.int64).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([maps], pa.list_(pa.binary())), pa.array([counts], pa.binary())], names=["maps", "counts"]
            )

        for batch in batches:
            for at, n in zip(batch.column("at").to_pylist(), batch.column("n").to_pylist()):
                held.append((at, n))
                if len(held) == BLOCK:
                    yield packed()
                    held.clear()
        if held:
            yield packed()

    return materialize(numbered.repartition(parts).mapInArrow(pack, "maps array<binary>, counts binary"))


def _supports(blocks: DataFrame, candidates: list[list[int]]) -> DataFrame:
    """(c, n): for each candidate, by its index, the incidents whose baskets hold all its items.

    Candidates come in order, so neighbours share the intersection of their first items.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for maps, counts in zip(batch.column("maps"), batch.column("counts")):
                bits = [np.frombuffer(m.as_buffer(), np.uint8) for m in maps.values]
                weights = np.frombuffer(counts.as_buffer(), np.int64)
                trail: list[tuple[int, np.ndarray]] = []
                for c, candidate in enumerate(candidates):
                    same = 0
                    while same < min(len(trail), len(candidate) - 1) and trail[same][0] == candidate[same]:
                        same += 1
                    del trail[same:]
                    for item in candidate[same:-1]:
                        trail.append((item, bits[item] & trail[-1][1] if trail else bits[item]))
                    both = bits[candidate[-1]] & trail[-1][1] if trail else bits[candidate[-1]]
                    hit = np.unpackbits(both, count=len(weights), bitorder="little").view(bool)
                    totals[c] += weights[hit].sum()
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some])], names=["c", "n"])

    return blocks.mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))


def _next_candidates(level: DataFrame, size: int) -> DataFrame:
    """Sets of ``size + 1`` whose subsets of ``size`` are all frequent (``level``: at, an ordered array)."""
    head, last = F.slice("at", 1, size - 1), F.element_at("at", -1)
    left = level.select(head.alias("head"), F.col("at"), last.alias("last"))
    right = level.select(head.alias("head"), last.alias("next"))
    joined = left.join(right, "head").where("last < next").select(F.concat("at", F.array("next")).alias("at"))
    if size == 1:
        return joined
    # the two sets it was made of are frequent; the others each lack one of the first items
    lacking = F.transform(
        F.sequence(F.lit(0), F.lit(size - 2)), lambda i: F.filter("at", lambda _, j: j != i)
    )
    each = joined.select("at", F.explode(lacking).alias("part"))
    met = each.join(level.withColumnRenamed("at", "part"), "part", "left_semi")
    return met.groupBy("at").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") == size - 1).select("at")


def _by_bitmaps(counted: DataFrame, singles: list[tuple[str, int]], least: float) -> DataFrame:
    """Frequent sets level by level: bitmaps of items are intersected, sets with a rare subset never.

    The work follows baskets times candidates, whatever the length of a basket. The driver
    holds one chunk of candidates at a time.
    """
    spark = counted.sparkSession
    items = [item for item, _ in singles]
    blocks = _blocks(counted, items)
    level = spark.createDataFrame([([i], n) for i, (_, n) in enumerate(singles)], "at array<long>, n long")
    levels = [level]
    size = 1
    while True:
        wanted = materialize(_next_candidates(level.select("at"), size))
        chunks = 1 + wanted.count() // CANDIDATES
        chunk = F.pmod(F.xxhash64(F.slice("at", 1, 1)), F.lit(chunks)) if size > 1 else F.pmod(F.xxhash64("at"), F.lit(chunks))
        found = []
        for k in range(chunks):
            candidates = sorted(r["at"] for r in wanted.where(chunk == k).collect())
            if candidates:
                counts = _supports(blocks, candidates).where(F.col("n") >= least)
                listed = spark.createDataFrame(list(enumerate(candidates)), "c long, at array<long>")
                found.append(materialize(counts.join(listed, "c").select("at", "n")))
        if not found:
            break
        level = reduce(DataFrame.unionByName, found)
        levels.append(level)
        size += 1
    names = F.transform("at", lambda i: F.get(F.lit(items), i.cast("int")))
    return reduce(DataFrame.unionByName, levels).select(names.alias("items"), "n")


def frequent_itemsets(
    baskets: DataFrame,
    min_support: float = 0.01,
    retry_support: float | None = 0.005,
    method: str = "auto",
) -> DataFrame:
    """Itemsets (sorted lists) with count and support.

    Takes baskets (``items``) or counted ones (``items``, ``n``). Equal baskets collapse to one
    counted row before anything else, then items below the threshold leave the baskets. Baskets
    that are short by then give all their subsets (``subsets``); if one keeps more than SHORT
    items, the bitmaps of items over the counted baskets are intersected level by level
    (``bitmaps``). ``auto`` picks by the longest basket; both give the same sets. The work
    follows the number of distinct baskets, not of incidents. If nothing reaches
    ``min_support`` the lower ``retry_support`` applies; the most frequent set is always a
    single item, so the choice needs only the item counts.
    """
    size = F.sum("n") if "n" in baskets.columns else F.count("*")
    counted = materialize(baskets.groupBy("items").agg(size.alias("n")))
    total = counted.agg(F.sum("n")).scalar()
    singles = (
        counted.select(F.explode("items").alias("item"), "n")
        .groupBy("item")
        .agg(F.sum("n").alias("n"))
        .withColumn("support", F.col("n") / total)
    )
    threshold: Column = F.lit(min_support)
    if retry_support is not None:
        best = singles.agg(F.max("support")).scalar()
        threshold = F.when(best >= min_support, min_support).otherwise(retry_support)

    # at most (basket length / support) items can be frequent, so this list is short
    kept = singles.where(F.col("support") >= threshold)
    pruned = (
        counted.withColumn("items", F.sort_array(F.array_intersect("items", kept.agg(F.collect_set("item")).scalar())))
        .where(F.size("items") > 0)
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )
    if method == "auto":
        pruned = materialize(pruned)
        longest = pruned.agg(F.max(F.size("items"))).first()[0] or 0
        method = "subsets" if longest <= SHORT else "bitmaps"
    if method == "bitmaps":
        frequent = [(r["item"], r["n"]) for r in kept.select("item", "n").collect()]
        rows = counted.agg(F.sum("n")).first()[0] or 0
        least = min((n for _, n in frequent), default=0)
        found = _by_bitmaps(pruned, sorted(frequent), _least_count(rows, min_support, retry_support, frequent)) if least else pruned
    else:
        found = (
            pruned.select(_subsets("items", "shiftleft(1L, size(items)) - 1", "items"), "n")
            .groupBy("items")
            .agg(F.sum("n").alias("n"))
        )
    return (
        found.withColumn("support", F.col("n") / total)
        .where(F.col("support") >= threshold)
        .withColumn("length", F.size("items"))
    )


def _least_count(rows: int, support: float, retry: float | None, singles: list[tuple[str, int]]) -> float:
    """The count that a frequent set has at least; the exact test is on the quotient."""
    enough = max((n for _, n in singles), default=0) / rows >= support
    return (support if enough or retry is None else retry) * rows * (1 - 1e-12)


def association_rules(
    itemsets: DataFrame, metric: str = "confidence", threshold: float = 0.3
) -> DataFrame:
    """Every split of every itemset into antecedents and consequents, best lift first."""
    splits = itemsets.where(F.size("items") >= 2).select(
        "items",
        "support",
        _subsets("items", "shiftleft(1L, size(items)) - 2", "antecedents"),
    )
    splits = splits.withColumn("consequents", F.array_except("items", "antecedents"))
    left = itemsets.select(
        F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support")
    )
    right = itemsets.select(
        F.col("items").alias("consequents"), F.col("support").alias("consequent_support")
    )
    a, c, s = (F.col(n) for n in ("antecedent_support", "consequent_support", "support"))
    rules = splits.join(left, "antecedents").join(right, "consequents").withColumns(
        {
            "confidence": s / a,
            "lift": s / a / c,
            "leverage": s - a * c,
            "conviction": F.when(s < a, (1 - c) / (1 - s / a)),
        }
    )
    return (
        rules.where(F.col(metric) >= threshold)
        .select("antecedents", "consequents", "antecedent_support", "consequent_support",
                "support", "confidence", "lift", "leverage", "conviction")
        .orderBy(F.desc("lift"), F.desc("support"), "antecedents", "consequents")
    )


def rules_with(rules: DataFrame, side: str, text: str) -> DataFrame:
    """Rules where some item of a side contains ``text``."""
    return rules.where(F.exists(side, lambda item: item.contains(text)))


def rules_as_text(rules: DataFrame) -> DataFrame:
    """Item lists joined by ', ' for flat files."""
    return rules.withColumns(
        {
            side: F.array_join(F.sort_array(side), ", ")
            for side in ("antecedents", "consequents")
        }
    )


def filter_rules(rules: DataFrame, min_confidence: float = 0.3, min_lift: float = 1.0) -> DataFrame:
    return rules.where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))


def top_rules(rules: DataFrame, n: int = 15) -> DataFrame:
    """Report of the ``n`` rules with the highest lift, with a short label."""
    text = rules_as_text(rules)
    label = F.concat(
        F.substring("antecedents", 1, 30), F.lit(" → "), F.substring("consequents", 1, 20)
    )
    return (
        text.withColumn("rule", label)
        .orderBy(F.desc("lift"), F.desc("support"), "antecedents", "consequents")
        .limit(n)
    )
