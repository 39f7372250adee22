"""Exact quantiles, running totals and significance tests as distributed jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.functions.tails import t_p_value, u_p_value
from pulsewatch.session import materialize


# the sketch places a value within n / ACCURACY ranks; a bracket is MARGIN of a key's rows wide on either side
ACCURACY = 10_000
MARGIN = 3 / ACCURACY
RANGE_ROWS = 200_000


def running_totals(
    counts: DataFrame, keys: list[str], order: str, columns: list[str], parts: int | None = None
) -> DataFrame:
    """Add ``<c>_below`` (sum over smaller ``order`` values) and ``<c>_all`` per key.

    Rows are dealt to ranges of keys and values, as many as the rows need. Totals of the
    ranges give each range its offset, and a window inside the range does the rest, so no
    task ever sorts a whole key.
    """
    parts = parts or 1 + counts.count() // RANGE_ROWS
    dealt = counts.repartitionByRange(parts, *keys, order)
    split = materialize(dealt.withColumn("_part", F.spark_partition_id()))
    totals = split.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_part",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in columns],
        *[F.sum(f"_t_{c}").over(whole).alias(f"{c}_all") for c in columns],
    )
    inside = (
        Window.partitionBy(*keys, "_part")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = split.join(offsets, [*keys, "_part"])
    below = {
        f"{c}_below": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))
        for c in columns
    }
    return joined.withColumns(below).drop("_part", *[f"_o_{c}" for c in columns])


def distribution(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], margin: float = MARGIN
) -> DataFrame:
    """n, mean, std, min, max and exact linear-interpolated quantiles per key.

    The first pass sums moments and merges one quantile sketch a key, which brackets every
    wanted rank; the second counts the rows below each bracket and keeps those inside. Only
    these are sorted, a few ten-thousandths of a key. Ranks are exact, since they count rows:
    a bracket that misses its ranks is seen and its key ranked whole. Keys with few rows are
    ranked whole at once. Keys whose values are all NULL stay, with n = 0.
    """
    rows = df.na.drop(subset=keys) if keys else df
    rows = materialize(rows.select(*keys, F.col(value).alias("_v")))
    steps = [min(1.0, max(0.0, p + side)) for p in probs.values() for side in (-margin, margin)]
    sketch = F.percentile_approx("_v", steps, F.lit(ACCURACY))
    summary = rows.groupBy(*keys).agg(
        F.count("_v").alias("n_values"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        sketch.alias("_cuts"),
    )
    summary = materialize(summary)
    few = F.col("n_values") < 2 / margin
    cuts = [
        F.struct(F.get("_cuts", F.lit(2 * i)).alias("low"), F.get("_cuts", F.lit(2 * i + 1)).alias("high"))
        for i in range(len(probs))
    ]
    everything = F.struct(F.col("min").alias("low"), F.col("max").alias("high"))
    brackets = F.when(few, F.array(everything)).otherwise(F.array(*cuts))
    found = materialize(_ranked(rows, keys, summary.withColumn("_brackets", brackets), probs))
    missed = F.col("n_values") > 0
    for name in probs:
        missed = missed & F.col(name).isNotNull()
    unsure = found.where((F.col("n_values") > 0) & ~missed)
    if not unsure.isEmpty():
        wide = summary.withColumn("_brackets", F.array(everything))
        if keys:
            wide = wide.join(unsure.select(*keys), keys, "left_semi")
        found = found.where((F.col("n_values") == 0) | missed).unionByName(_ranked(rows, keys, wide, probs))
    return found.select(*keys, "n_values", "mean", "std", "min", "max", *probs)


def _ranked(rows: DataFrame, keys: list[str], summary: DataFrame, probs: dict[str, float]) -> DataFrame:
    """``summary`` with the quantiles that lie in its brackets (one for all, or one a quantile)."""
    bounds = summary.select(*keys, "_brackets")
    if keys:
        placed = rows.join(bounds, keys)
    else:
        placed = rows.withColumn("_brackets", bounds.select("_brackets").scalar())
    v = F.col("_v")
    places = range(len(probs))
    below = placed.groupBy(*keys).agg(
        F.array(*[F.count_if(v < F.get("_brackets", F.lit(i))["low"]) for i in places]).alias("_below")
    )
    hits = F.filter(
        F.transform("_brackets", lambda b, i: F.when((v >= b["low"]) & (v <= b["high"]), i)),
        lambda i: i.isNotNull(),
    )
    inside = placed.select(*keys, "_v", F.explode(hits).alias("_i")).groupBy(*keys, "_i", "_v").agg(
        F.count(F.lit(1)).alias("_n")
    )
    up_to = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_before", F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
    facts = summary.join(below, keys) if keys else summary.withColumn("_below", below.select("_below").scalar())
    facts = facts.select(*keys, "n_values", "_below", F.size("_brackets").alias("_size"))
    if keys:
        met = inside.join(facts, keys)
    else:
        fact = facts.select(F.struct("n_values", "_below", "_size")).scalar()
        met = inside.withColumn("_f", fact).select("*", "_f.*")
    start = F.get("_below", F.col("_i")) + F.col("_before")
    picks, results = [], []
    for k, (name, p) in enumerate(probs.items()):
        place = (F.col("n_values") - 1) * F.lit(float(p))
        here = F.col("_i") == F.when(F.col("_size") == 1, 0).otherwise(k)

        def at(position: Column, here: Column = here) -> Column:
            return F.max(F.when(here & (start <= position) & (position < start + F.col("_n")), v))

        picks += [
            at(F.floor(place)).alias(f"_lo_{name}"),
            at(F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_fr_{name}"),
        ]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((low + (high - low) * F.col(f"_fr_{name}")).alias(name))
    picked = met.groupBy(*keys).agg(*picks).select(*keys, *results)
    out = summary.drop("_cuts", "_brackets")
    if keys:
        return out.join(picked, keys, "left")
    return out.withColumn("_p", picked.select(F.struct(*probs)).scalar()).select("*", "_p.*").drop("_p")


def t_test(df: DataFrame, group: str, value: str, min_rows: int = 1) -> DataFrame:
    """Two-sample t-test with pooled variance; needs more than ``min_rows`` per group."""
    yes, no = F.when(F.col(group), F.col(value)), F.when(~F.col(group), F.col(value))
    moments = df.agg(
        F.count(yes).alias("n_yes"), F.avg(yes).alias("mean_yes"), F.var_samp(yes).alias("var_yes"),
        F.count(no).alias("n_no"), F.avg(no).alias("mean_no"), F.var_samp(no).alias("var_no"),
    )
    dof = F.col("n_yes") + F.col("n_no") - 2
    pooled = (
        (F.col("n_yes") - 1) * F.col("var_yes") + (F.col("n_no") - 1) * F.col("var_no")
    ) / dof
    spread = F.sqrt(pooled * (1 / F.col("n_yes") + 1 / F.col("n_no")))
    enough = (F.col("n_yes") > min_rows) & (F.col("n_no") > min_rows)
    tested = moments.select(
        "n_yes", "n_no", "mean_yes", "mean_no",
        F.when(enough, (F.col("mean_yes") - F.col("mean_no")) / F.nullif(spread, F.lit(0.0)))
        .alias("t_statistic"),
        F.when(enough, dof).alias("degrees_of_freedom"),
    )
    p = t_p_value(F.col("t_statistic"), F.col("degrees_of_freedom").cast("double"))
    return tested.withColumn("p_value", p).withColumn("stars", V.significance(F.col("p_value")))


def mann_whitney(df: DataFrame, group: str, value: str, min_rows: int = 1) -> DataFrame:
    """Two-sided Mann-Whitney U of the group against the rest, with tie correction.

    Needs more than ``min_rows`` rows per group, like the t-test.
    """
    counts = materialize(
        df.na.drop(subset=[group, value])
        .groupBy(value)
        .agg(
            F.count_if(F.col(group)).alias("n_yes"),
            F.count_if(~F.col(group)).alias("n_no"),
        )
    )
    ranked = running_totals(counts, [], value, ["n_no"])
    tied = (F.col("n_yes") + F.col("n_no")).cast("double")
    enough = (F.sum("n_yes") > min_rows) & (F.sum("n_no") > min_rows)
    wins = F.sum(F.col("n_yes") * (F.col("n_no_below") + F.col("n_no") / 2))
    result = ranked.agg(
        F.when(enough, wins).alias("u_statistic"),
        F.sum("n_yes").alias("n_yes"),
        F.sum("n_no").alias("n_no"),
        F.sum(tied * tied * tied - tied).alias("tie_sum"),
    )
    p = u_p_value(*[F.col(c) for c in ("u_statistic", "n_yes", "n_no", "tie_sum")])
    return result.withColumn("p_value", p).withColumn("stars", V.significance(F.col("p_value")))


def pearson(df: DataFrame, pairs: dict[str, tuple[str, str]], min_rows: int = 10) -> DataFrame:
    """Correlation of each named column pair, one row per name.

    All pairs share one pass; nothing is reported for ``min_rows`` rows or fewer.
    """
    aggs = []
    for name, (x, y) in pairs.items():
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggs += [F.corr(x, y).alias(f"r_{name}"), F.count_if(both).alias(f"n_{name}")]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("variable"),
                F.col(f"n_{name}").alias("n"),
                F.col(f"r_{name}").alias("r"),
            )
            for name in pairs
        ]
    )
    long = wide.select(F.inline(rows)).where(F.col("n") > min_rows)
    r = F.col("r")
    t = F.when(r * r < 1, r * F.sqrt((F.col("n") - 2) / (1 - r * r))).when(
        r.isNotNull(), F.lit(float("inf"))
    )
    p = t_p_value(t, (F.col("n") - 2).cast("double"))
    return long.withColumn("p_value", p).withColumn("stars", V.significance(F.col("p_value")))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row per column."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    long = df.select(F.inline(cells))
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    table = distribution(long, ["column_name"], "value", quartiles)
    return table.withColumnRenamed("n_values", "count")
