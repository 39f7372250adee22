"""Data-quality checks and dataset profiles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.operators.analysis import null_profile
from pulsewatch.operators.sampling import sample_rows


@dataclass
class Checks:
    """What a table must satisfy."""

    unique: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    positive: list[str] = field(default_factory=list)
    lengths: dict[str, int] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    dated: list[str] = field(default_factory=list)
    min_filled_pct: dict[str, float] = field(default_factory=dict)


def quality_checks(df: DataFrame, checks: Checks) -> DataFrame:
    """One row per check: name, measured value, passed.

    Everything but uniqueness is one pass without a shuffle. Each unique column is
    counted by itself, reading that column alone, since several distinct counts in
    one aggregate would multiply every row.

    The value is the row count for not_empty, a day span for dates, a percentage for
    filled, and otherwise the number of rows that break the rule.
    """
    measures = {"not_empty": (F.count("*"), lambda v: v > 0)}
    for c in checks.unique:
        measures[f"unique:{c}"] = (F.count(c), lambda v: v == 0)
    for c, (low, high) in checks.ranges.items():
        outside = F.count_if(~F.col(c).between(low, high))
        measures[f"range:{c}"] = (outside, lambda v: v == 0)
    for c in checks.positive:
        measures[f"positive:{c}"] = (F.count_if(F.col(c) <= 0), lambda v: v == 0)
    for c, n in checks.lengths.items():
        measures[f"length:{c}"] = (F.count_if(F.length(c) != n), lambda v: v == 0)
    for c in checks.required:
        missing = 0 if c in df.columns else 1
        measures[f"required:{c}"] = (F.max(F.lit(missing)), lambda v: v == 0)
    for c in checks.dated:
        span = F.datediff(F.max(c), F.min(c))
        measures[f"dates:{c}"] = (span, lambda v: v.isNotNull())
    for c, pct in checks.min_filled_pct.items():
        filled = F.count(c) / F.nullif(F.count("*"), F.lit(0)) * 100
        measures[f"filled:{c}"] = (filled, lambda v, pct=pct: v >= pct)

    wide = df.agg(*[m.cast("double").alias(f"m{i}") for i, (m, _) in enumerate(measures.values())])
    for i, name in enumerate(measures):
        if name.startswith("unique:"):
            c = name.removeprefix("unique:")
            distinct = df.select(c).where(F.col(c).isNotNull()).distinct()
            wide = wide.withColumn(
                f"m{i}", F.col(f"m{i}") - distinct.agg(F.count("*").cast("double")).scalar()
            )
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(f"m{i}").alias("value"),
            F.coalesce(test(F.col(f"m{i}")), F.lit(False)).alias("passed"),
        )
        for i, (name, (_, test)) in enumerate(measures.items())
    ]
    return wide.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, key: str | None = None, samples: int = 3) -> DataFrame:
    """Columns with type and NULL share, the row count, the distinct keys and values of sample rows.

    The sample rows are those with the smallest hashes of the key (without one, of the first
    column), the same rows for every column, in order of the key.
    """
    types = F.create_map(*[F.lit(x) for f in df.dtypes for x in f])
    shares = null_profile(df).withColumn("data_type", types[F.col("column_name")])
    totals = df.agg(
        F.count("*").alias("rows"),
        (F.countDistinct(key) if key else F.lit(None).cast("long")).alias("keys"),
    )
    named = key or df.columns[0]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    rows = sample_rows(df, samples, named).select(F.col(named).cast("string").alias("k"), *texts)
    listed = F.sort_array(F.collect_list(F.struct("*")))
    # the field of an array of structs is the array of its values
    values = [x for i, c in enumerate(df.columns) for x in (F.lit(c), F.array_join(F.col("rows")[f"c{i}"], "|"))]
    picked = rows.agg(listed.alias("rows")).select(F.create_map(*values).alias("m"))
    return shares.withColumns(
        {
            "row_count": totals.select("rows").scalar(),
            "distinct_keys": totals.select("keys").scalar(),
            "samples": picked.select("m").scalar()[F.col("column_name")],
        }
    )


def sample_head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
