"""Connected components of a link table, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import stored


def components(links: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is its smallest node.

    Alternating stars: a large star ties the larger neighbours of a node to its smallest one, a
    small star ties its smaller neighbours to the smallest. The number of rounds grows with the
    logarithm of the longest chain. Only minima are aggregated, so a hub with many neighbours is
    summed on the map side first; nothing is collected. Self links and nulls are ignored.
    """
    edges = stored(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{label}-links",
    )
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        after = stored(small, f"{label}-stars")
        changed = after.join(edges, ["a", "b"], "left_anti").limit(1).count()
        changed = changed or edges.join(after, ["a", "b"], "left_anti").limit(1).count()
        edges = after
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    members = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = members.select(F.col("component").alias("a"), "component").distinct()
    return members.unionByName(roots).select(F.col("a").alias("node"), "component")
