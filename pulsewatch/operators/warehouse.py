"""Warehouse maintenance as set-based DataFrame operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import schemas
from pulsewatch.operators import key_summary
from pulsewatch.operators.clean import keep_first
from pulsewatch.operators.joins import nullify_missing_fk
from pulsewatch.session import materialize


def upsert(
    base: DataFrame,
    new: DataFrame,
    key: str,
    update_cols: list[str] | None = None,
    order_by: list[Column | str] | None = None,
) -> DataFrame:
    """Insert unknown keys, update known ones (all columns or ``update_cols``; [] for none).

    ``order_by`` puts the winning one of several incoming rows per key first; without
    it the smallest row wins, so that a rerun gives the same table. The increment is
    reduced to one row per key once, and one outer join decides every row: each side
    is read once and shuffled once, by the key. Rows without a key never match.
    """
    incoming = _one_per_key(new, key, order_by)
    changed = [c for c in base.columns if c != key] if update_cols is None else update_cols
    changed = [c for c in changed if c in new.columns]
    rest = [c for c in base.columns if c != key]
    patch = schemas.with_missing(incoming, base.schema).select(
        key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in rest]
    )
    both = base.withColumn("_old", F.lit(True)).join(patch, key, "full")

    def decided(c: str) -> Column:
        theirs = F.col("_old").isNull()
        if c in changed:
            theirs = theirs | F.coalesce("_new", F.lit(False))
        return F.when(theirs, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*[F.col(c) if c == key else decided(c) for c in base.columns])


def _one_per_key(new: DataFrame, key: str, order_by: list[Column | str] | None) -> DataFrame:
    sortable = [f.name for f in new.schema if not isinstance(f.dataType, T.MapType)]
    return keep_first(new, key, order_by or [c for c in sortable if c != key] or [key])


def insert_new(
    base: DataFrame, new: DataFrame, key: str, order_by: list[Column | str] | None = None
) -> DataFrame:
    """Add only rows with an unknown key; known rows stay as they are."""
    return upsert(base, new, key, [], order_by)


def incremental_rows(
    new: DataFrame,
    base: DataFrame,
    key: str = "incident_number",
    ts: str = "response_datetime",
    since: str | None = None,
) -> DataFrame:
    """Rows whose key is not loaded yet: late rows, equal times and rows without a time included.

    ``since`` limits the look into the base to loaded rows from that time on, or without
    a time, where older keys cannot come again.
    """
    loaded = base
    if since is not None:
        loaded = base.where(F.col(ts).isNull() | (F.col(ts) >= F.lit(since).cast(base.schema[ts].dataType)))
    return new.join(loaded.select(key), key, "left_anti").select(*new.columns)


def freshness(base: DataFrame, ts: str) -> DataFrame:
    return base.agg(F.count("*").alias("db_count"), F.max(ts).alias("last_load"))


def stored_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored table and when it was last written to, whatever times its rows carry."""
    stored = spark.read.parquet(path)
    return stored.select(F.col("_metadata.file_modification_time").alias("t")).agg(
        F.count("*").alias("db_count"), F.max("t").alias("last_load")
    )


def rebuild_plan(files: DataFrame, db_count: DataFrame, enough: int = 100) -> DataFrame:
    """Which extractions are due, from an inventory of (layer, path) and the row count.

    Calls are extracted when raw files exist, no enriched ones do, and the
    warehouse is nearly empty or nothing was transformed; events when raw files
    exist and nothing was transformed.
    """

    def has(layer: str, part: str) -> Column:
        hit = (F.col("layer") == layer) & F.lower("path").contains(part)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    seen = files.agg(
        has("raw", "911").alias("raw_calls"),
        has("raw", "event").alias("raw_events"),
        has("enriched", "911").alias("enriched_calls"),
        has("transformed", "911").alias("transformed_calls"),
        has("transformed", "event").alias("transformed_events"),
    )
    sparse = db_count.scalar() < enough
    calls_due = (
        F.col("raw_calls") & ~F.col("enriched_calls") & (sparse | ~F.col("transformed_calls"))
    )
    events_due = F.col("raw_events") & ~F.col("transformed_events")
    return seen.select(
        F.inline(
            F.array(
                F.struct(F.lit("extract_calls").alias("task"), calls_due.alias("is_due")),
                F.struct(F.lit("extract_events").alias("task"), events_due.alias("is_due")),
            )
        )
    )


def _text(name: str, limits: dict[str, int]) -> Column:
    whole = F.col(name).cast("string")
    return (F.substring(whole, 1, limits[name]) if name in limits else whole).alias(name)


def _cast(df: DataFrame, name: str, kind: str) -> Column:
    """Lenient cast; a column that already has the type is left alone."""
    present = df.schema[name].dataType
    if present.simpleString() == kind:
        return F.col(name)
    if isinstance(present, T.StringType) and kind == "int":
        # '7.0' is 7
        return F.col(name).try_cast("double").try_cast("int").alias(name)
    return F.col(name).try_cast(kind).alias(name)


def load_fact_calls(
    calls: DataFrame,
    geo: DataFrame,
    measures: tuple[str, ...] = (),
    limits: dict[str, int] | None = None,
) -> DataFrame:
    """The twelve warehouse columns with lenient casts and checked geo_id.

    ``measures`` are further numeric columns to carry along, where they exist. Texts
    stay whole; ``limits`` cuts descriptive columns to a length, but never a key.
    """
    limits = limits or {}
    if {"incident_number", "geo_id"} & set(limits):
        raise ValueError("keys are not cut")
    more = [c for c in measures if c in calls.columns]
    source = schemas.with_missing(calls, schemas.FACT_CALLS)
    rows = source.select(
        _text("incident_number", limits),
        _cast(source, "response_datetime", "timestamp_ntz"),
        _cast(source, "response_date", "date"),
        _cast(source, "response_hour", "int"),
        _text("response_day_of_week", limits),
        _text("priority_level", limits),
        _cast(source, "priority_numeric", "int"),
        _text("initial_problem_category", limits),
        _text("final_problem_category", limits),
        _text("geo_id", limits),
        _cast(source, "latitude_centroid", "double"),
        _cast(source, "longitude_centroid", "double"),
        *[_cast(source, c, "double") for c in more],
    )
    checked = nullify_missing_fk(rows, geo.select("geo_id"), "geo_id")
    return checked.select(*[f.name for f in schemas.FACT_CALLS], *more)


def load_dim_event(events: DataFrame) -> DataFrame:
    """Event dimension: all events under their own id, with defaults."""
    source = schemas.with_missing(
        events,
        schemas.struct(
            "event_name string, event_type string, start_date date, end_date date, "
            "has_alcohol boolean, has_amplified_sound boolean"
        ),
    )
    return source.select(
        "event_id",
        F.coalesce("event_name", F.concat(F.lit("Event_"), F.col("event_id") - 1)).alias("event_name"),
        F.coalesce("event_type", F.lit("Festival")).alias("event_type"),
        "start_date",
        "end_date",
        F.coalesce("has_alcohol", F.lit(False)).alias("has_alcohol"),
        F.coalesce("has_amplified_sound", F.lit(False)).alias("has_amplified_sound"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    frames = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    counts = frames[0]
    for frame in frames[1:]:
        counts = counts.unionByName(frame)
    return counts


def upsert_partitions(
    path: str,
    new: DataFrame,
    key: str,
    partition_by: list[str],
    update_cols: list[str] | None = None,
    order_by: list[Column | str] | None = None,
    within: Column | str | None = None,
    after: Callable[[Column | None], None] | None = None,
) -> dict[str, int]:
    """Upsert into a partitioned Parquet table, rewriting only partitions it touches.

    ``within`` is a condition on partition columns beyond which no incoming key is
    stored; only partitions inside are looked through for the keys, and of those only
    the ones that may hold a key by the summaries beside the table (``key_summary``).
    The number of partitions looked through and rewritten is returned. ``after`` is called
    with the condition that selects the partitions written, None if the table is new.

    Touched are the partitions of the incoming rows and those of stored rows with the
    same key; both lists have one entry per partition. Partition columns of a stored
    row never change, so no key can end up in two partitions.
    """
    spark = new.sparkSession
    incoming = _one_per_key(new, key, order_by)
    try:
        base = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        incoming.write.partitionBy(*partition_by).parquet(path)
        key_summary.summarise_keys(spark, path, key, partition_by)
        if after:
            after(None)
        return {"looked": 0, "rewritten": 0}
    incoming = materialize(incoming)
    keys = incoming.select(F.col(key).cast(base.schema[key].dataType).alias(key))
    open_ = key_summary.may_hold(path, keys, key, partition_by)
    looked = (open_ if within is None else open_.where(within)).collect()
    stored = base.where(_inside(looked, partition_by)).select(key, *partition_by)
    stored = stored.join(incoming.select(key), key, "left_semi")
    touched = (
        incoming.select(*partition_by).union(stored.select(*partition_by)).distinct().collect()
    )
    if not touched:
        return {"looked": len(looked), "rewritten": 0}
    inside = _inside(touched, partition_by)
    fixed = {key, *partition_by}
    changed = update_cols or [c for c in base.columns if c not in fixed]
    merged = upsert(base.where(inside), incoming, key, changed)
    (
        merged.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    key_summary.summarise_keys(spark, path, key, partition_by, inside)
    if after:
        after(inside)
    return {"looked": len(looked), "rewritten": len(touched)}


def _inside(rows: list[Row], partition_by: list[str]) -> Column:
    """Whether a row lies in one of the partitions; a condition that prunes the scan."""
    if len(partition_by) == 1:
        (c,) = partition_by
        values = [r[c] for r in rows if r[c] is not None]
        inside = F.col(c).isin(values) if values else F.lit(False)
        return inside | F.col(c).isNull() if len(values) < len(rows) else inside
    inside = F.lit(False)
    for row in rows:
        match = F.lit(True)
        for c in partition_by:
            match = match & F.col(c).eqNullSafe(F.lit(row[c]))
        inside = inside | match
    return inside
