"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with weight w is to give total * w / (sum of weights) rows, so each of its n documents is
repeated at the rate of that number over n. A hash of the document's key and the seed is a uniform
number; inverting the Poisson distribution at it gives the copies of the document. A rate beyond
PIECE is split into equal parts, each with its own hash, whose counts add up (sums of Poisson
counts are Poisson). Copies are exploded and shuffled by another hash.

Edge cases: a null source is a source; a null doc_id is drawn by its text; repeated rows are
drawn alike; a source with a weight of 0, or without one when weights are given, gives nothing;
an empty table stays empty. Columns of any name pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import stored, unit

#: Without weights, sources get weight (number of documents) ** TEMPERATURE.
TEMPERATURE = 0.7
PIECE = 16.0
SEED = "mix"


def source_key(column: str | Column) -> Column:
    """Text that tells a null source from any other."""
    col = F.col(column) if isinstance(column, str) else column
    return F.when(col.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), col.cast("string")))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None) -> DataFrame:
    """(source_key, rate) for each source of ``docs``; the sum of rate * size is ``total``."""
    sizes = stored(docs.groupBy(source_key("source").alias("source_key")).agg(F.count(F.lit(1)).alias("n")), "sources")
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE))
    else:
        pairs = [F.lit(x) for k, w in weights.items() for x in ("null" if k is None else f"={k}", float(w))]
        given = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.element_at(given, F.col("source_key")), F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    # sums in one order, so that the last digit does not depend on partitions
    whole = sizes.agg(F.sum(F.col("weight").cast("decimal(28,10)")).cast("double").alias("w"), F.sum("n").alias("n")).head()
    goal = float(total if total is not None else whole["n"] or 0)
    scale = goal / whole["w"] if whole["w"] else 0.0
    return sizes.select("source_key", (F.col("weight") * F.lit(scale) / F.col("n")).alias("rate"))


def cumulative(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... until the tail is negligible."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("out"))
    last = F.ceil(rate + 10 * F.sqrt(rate) + 10).cast("int")

    def step(a: Column, k: Column) -> Column:
        p = a["p"] * rate / k
        return F.struct(p.alias("p"), (a["c"] + p).alias("c"), F.concat(a["out"], F.array(a["c"] + p)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["out"]


def mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: float | None = None,
    seed: str = SEED,
) -> DataFrame:
    """``row`` (all columns of a document), copy (1, 2, ...) and mix_key, in shuffled order."""
    plan = rates(docs, weights, total).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE).cast("int")))
    plan = plan.withColumn("steps", cumulative(F.col("rate") / F.col("parts")))
    drawn_by = F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col("row.text"), F.lit("")))))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    rows = rows.withColumn("source_key", source_key(F.col("row.source"))).withColumn("drawn_by", drawn_by)

    def draw(part: Column) -> Column:
        u = unit(F.col("drawn_by"), part, seed=f"{seed} count")
        return F.size(F.filter("steps", lambda c: c < u))

    copies = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("parts")), draw), F.lit(0), lambda a, x: a + x
    )
    return (
        rows.join(plan, "source_key")
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", "drawn_by", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .withColumn("mix_key", unit(F.col("drawn_by"), F.col("copy"), seed=f"{seed} order"))
        .select("row", "copy", "mix_key")
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )
