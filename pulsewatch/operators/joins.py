"""Joins: geography, weather, event flags and the spatio-temporal join.

Dimension joins carry no hint. Spark broadcasts a side whose size is known to be
below its threshold, at planning or from run-time measurement, and otherwise sorts
and merges, where adaptive execution splits partitions of crowded keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch import schemas
from pulsewatch.functions.geo import Grid, bounding_box, haversine_km
from pulsewatch.operators.clean import keep_first
from pulsewatch.session import at_most, materialize

# Event copies (day x cell) that are broadcast at most; about 100 bytes each.
BROADCAST_COPIES = 200_000
# Events met by moments that are broadcast in place of a copy: listed without keys, a cell or a node.
LISTED = 5
# Events in one list, as a power of two.
LIST_BITS = 10
# Calls of one (day, cell) that one task takes before the cell is spread over sub-keys.
SALT_ROWS = 100_000


def enrich_geo(calls: DataFrame, geo: DataFrame) -> DataFrame:
    """Left join of the block-group centroid and area."""
    columns = ["geo_id", "latitude_centroid", "longitude_centroid", "area_sq_km"]
    return calls.join(geo.select(*columns), "geo_id", "left")


def unmatched_geo(calls: DataFrame, geo: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent ids without a block group."""
    missing = calls.join(geo.select("geo_id"), "geo_id", "left_anti")
    counts = missing.groupBy("geo_id").agg(F.count("*").alias("call_count"))
    return counts.orderBy(F.desc("call_count"), "geo_id").limit(top)


def match_rate(enriched: DataFrame) -> DataFrame:
    matched = F.count("latitude_centroid")
    return enriched.agg(
        F.count("*").alias("total"),
        matched.alias("matched"),
        (matched / F.nullif(F.count("*"), F.lit(0)) * 100).alias("match_rate"),
    )


def join_weather(calls: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join on the hour of the call; only the weather columns used later."""
    kept = ["temperature_f", "precipitation_mm", "weather_category", "is_raining",
            "temp_category", "humidity_pct"]
    hours = weather.select(F.date_trunc("hour", "datetime").alias("join_hour"), *kept)
    keyed = calls.withColumn("join_hour", F.date_trunc("hour", "response_datetime"))
    return keyed.join(hours, "join_hour")


def flag_festival(calls: DataFrame, fact: DataFrame) -> DataFrame:
    """Add is_festival_related: whether the incident occurs in the fact."""
    linked = fact.select("incident_number").distinct().withColumn("_hit", F.lit(True))
    flagged = calls.join(linked, "incident_number", "left")
    return flagged.withColumn(
        "is_festival_related", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def flag_event_context(calls: DataFrame, fact: DataFrame) -> DataFrame:
    """Add is_festival_related and event_has_alcohol (any linked event serves it; NULL without one)."""
    linked = fact.groupBy("incident_number").agg(
        F.bool_or(F.coalesce("event_has_alcohol", F.lit(False))).alias("event_has_alcohol")
    )
    joined = calls.drop("event_has_alcohol").join(
        linked.withColumn("_hit", F.lit(True)), "incident_number", "left"
    )
    return joined.withColumn("is_festival_related", F.coalesce("_hit", F.lit(False))).drop("_hit")


def nullify_missing_fk(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Set ``key`` to NULL where the dimension has no such row."""
    known = dim.select(key).distinct().withColumn("_known", F.lit(True))
    joined = df.join(known, key, "left")
    return joined.withColumn(key, F.when(F.col("_known"), F.col(key))).drop("_known")


def valid_events(events: DataFrame) -> DataFrame:
    """Events with place and period, one row per id."""
    complete = events.na.drop(subset=["event_lat", "event_lon", "start_date", "end_date"])
    return keep_first(complete, "event_id", ["start_date", "end_date", "event_name"])


def call_span(calls: DataFrame) -> Column:
    """First and last call time, read once and then used as values."""
    when = F.col("response_datetime")
    row = calls.agg(F.min(when).cast("string"), F.max(when).cast("string")).head()
    first, last = (F.lit(v).cast("timestamp_ntz") for v in row)
    return F.struct(first.alias("first"), last.alias("last"))


def events_in_range(
    events: DataFrame,
    calls: DataFrame,
    end_inclusive_day: bool = False,
    span: Column | None = None,
) -> DataFrame:
    """Events whose period overlaps the calls (or ``span``, if it is known already).

    The end date counts as its midnight unless ``end_inclusive_day``.
    """
    span = call_span(calls) if span is None else span
    end = F.col("end_date") + F.expr("INTERVAL 1 DAY" if end_inclusive_day else "INTERVAL 0 DAY")
    return events.where(
        (end.cast("timestamp_ntz") >= span["first"])
        & (F.col("start_date").cast("timestamp_ntz") <= span["last"])
    )


# days are grouped by fours, those by fours, and so on: an event covers few nodes, however long it lasts
RADIX_BITS, LEVELS = 2, 10


def _time_nodes(first: Column, last: Column) -> Column:
    """The fewest whole nodes (level, node) that make up the days ``first`` to ``last``.

    Nodes of one event are disjoint, at most six a level, and a day lies in one at most.
    """

    def between(level: int) -> tuple[Column, Column]:
        size = 1 << (RADIX_BITS * level)
        return F.ceil(first / size).cast("long"), F.floor((last + 1) / size).cast("long")

    def nodes(level: int, start: Column, end: Column) -> Column:
        places = F.when(start < end, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(places, lambda node: F.struct(F.lit(level).alias("_level"), node.alias("_node")))

    found = []
    for level in range(LEVELS):
        (start, end), (up, over) = between(level), between(level + 1)
        radix = 1 << RADIX_BITS
        # where whole nodes of the next level fit in, only what sticks out on either side is left here
        left = F.when(up < over, up * radix).otherwise(end)
        right = F.when(up < over, over * radix).otherwise(end)
        found += [nodes(level, start, left), nodes(level, right, end)]
    return F.flatten(F.array(*found))


def _node_of(day: Column, levels: list[int]) -> Column:
    """The nodes of ``levels`` that a day lies in."""
    return F.array(*[
        F.struct(F.lit(n).alias("_level"), F.shiftright(day, RADIX_BITS * n).cast("long").alias("_node")) for n in levels
    ])


def _event_cells(events: DataFrame, grid: Grid) -> DataFrame:
    """Every (level, node, band, cell) an event can meet a call in."""
    timed = events.where(F.col("_from") <= F.col("_to")).select("*", F.inline(_time_nodes(F.col("_from"), F.col("_to"))))
    banded = timed.withColumn("_band", F.explode(grid.bands_around(F.col("event_lat"))))
    return banded.withColumn(
        "_cell",
        F.explode(grid.cells_around(F.col("event_lat"), F.col("event_lon"), F.col("_band"))),
    )


def _salted(
    calls: DataFrame, copies: DataFrame, keys: list[str], salt_rows: int, by: tuple[str, ...] = ("incident_number",)
) -> tuple[DataFrame, DataFrame]:
    """Spread the calls of crowded keys over sub-keys, by a hash of ``by``, and repeat the other side for each.

    A key gets a sub-key for every ``salt_rows`` calls; the other side is repeated only
    where there are several. The merge hint keeps the planner from broadcasting the
    copies by an estimate that does not know how far they were exploded.
    """
    crowded = (
        calls.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > salt_rows)
        .select(*keys, F.ceil(F.col("_n") / salt_rows).alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    spread = calls.join(crowded, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*by), parts)
    )
    every = copies.join(crowded, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    )
    return spread.drop("_parts"), every.drop("_parts").hint("merge")


# What of a call decides which events it meets: its place, its day, and whether it came at midnight sharp.
PLACE = ["latitude_centroid", "longitude_centroid"]
MOMENT = [*PLACE, "_day", "_sharp"]


def _with_moment(calls: DataFrame, span: Column) -> DataFrame:
    """Calls with a place and a time, and their moment."""
    day = F.to_date("response_datetime")
    return calls.na.drop(subset=[*PLACE, "response_datetime"]).withColumns(
        {
            # days count from the first call
            "_day": F.date_diff(day, F.to_date(span["first"])),
            "_sharp": F.col("response_datetime") <= day.cast("timestamp_ntz"),
        }
    )


def events_by_moment(
    moments: DataFrame,
    events: DataFrame,
    radius_km: float,
    end_inclusive_day: bool,
    span: Column,
    salt_rows: int = SALT_ROWS,
    broadcast_rows: int = BROADCAST_COPIES,
) -> DataFrame:
    """Each of the distinct ``moments`` with the events in whose period and radius it lies.

    A moment has one day and one grid cell; an event is copied to the time nodes that make up
    its days (logarithmically many) and the cells it can reach. A moment looks at the node of its
    day on each level that some event uses; short events use the lowest only. The two meet on
    equal keys, none is tested or produced twice, and the exact time and distance conditions
    are checked on the match.
    """
    grid = Grid(radius_km)
    band = grid.band(F.col("latitude_centroid"))
    keyed = moments.withColumns({"_band": band, "_cell": grid.cell(F.col("longitude_centroid"), band)})
    # an event covers only days that calls can have
    first = F.to_date(span["first"])
    clipped = events.withColumns(
        {
            "_from": F.greatest(F.date_diff("start_date", first), F.lit(0)),
            "_to": F.least(F.date_diff("end_date", first), F.date_diff(F.to_date(span["last"]), first)),
        }
    )
    # few bytes an event, but nodes and cells take a while; written, as the planner would work them out before the deal
    dealt = materialize(clipped.repartition(clipped.sparkSession.sparkContext.defaultParallelism, "event_id"))
    copies = materialize(_event_cells(dealt, grid).drop("_from", "_to"))
    levels = sorted(r["_level"] for r in copies.select("_level").distinct().collect())  # LEVELS at most
    keyed = keyed.select("*", F.inline(_node_of(F.col("_day"), levels or [0])))
    keys = ["_level", "_node", "_band", "_cell"]
    if at_most(copies, broadcast_rows):
        copies = F.broadcast(copies)
    else:
        keyed, copies = _salted(keyed, copies, keys, salt_rows, tuple(MOMENT))
        keys.append("_salt")

    met = keyed.join(copies, keys).withColumn(
        "distance_km",
        haversine_km(
            F.col("latitude_centroid"), F.col("longitude_centroid"),
            F.col("event_lat"), F.col("event_lon"),
        ),
    )
    inside = F.col("distance_km") <= radius_km
    if not end_inclusive_day:
        # the end date counts as midnight, so its day holds only the first instant
        inside = inside & (F.col("_sharp") | (F.col("_day") < F.date_diff("end_date", first)))
    return met.where(inside).drop(*keys)


def pair_calls_with_events(
    calls: DataFrame,
    events: DataFrame,
    radius_km: float,
    end_inclusive_day: bool,
    span: Column,
    salt_rows: int = SALT_ROWS,
    broadcast_rows: int = BROADCAST_COPIES,
    render: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All (call, event) pairs inside the period and the radius.

    Calls share the centroids of their block groups, so distances and conditions are settled
    once for each moment (``events_by_moment``), and a pair costs no more than its row.
    ``render`` gives columns another form; it is applied to each side before the two meet.

    The events of a moment are kept as lists. Up to ``LISTED`` times ``broadcast_rows`` events in
    them (counted once for each moment) they are broadcast, and calls are dealt evenly to tasks. Beyond,
    both sides shuffle; calls of a crowded moment are spread over sub-keys and its lists repeated for
    those, so it is not one task.
    """
    keyed = _with_moment(calls, span)
    moments = keyed.select(*MOMENT).distinct()
    near = materialize(
        events_by_moment(moments, events, radius_km, end_inclusive_day, span, salt_rows, broadcast_rows)
    )
    # joined under other names, as the columns of a place are part of the result
    names = {c: c if c.startswith("_") else f"_{c}" for c in MOMENT}
    keys = list(names.values())
    keyed = keyed.withColumns({k: F.col(c) for c, k in names.items() if c != k})
    keyed = _rendered(calls.columns, keyed, keys, render)
    found = [c for c in near.columns if c not in MOMENT]
    lists = _listed(found, _rendered(found, near.withColumnsRenamed(names), keys, render), keys)
    by = "incident_number" if "incident_number" in calls.columns else calls.columns[0]
    if at_most(near, broadcast_rows * LISTED):
        lists = F.broadcast(lists)
        # pairs are what costs, not calls: many tasks alike, however the calls were stored. Calls of one
        # moment lie together in each, so that the events they meet stay in the processor's cache
        keyed = keyed.repartition(_tasks(keyed), by, *keys).sortWithinPartitions(*keys)
    else:
        keyed, lists = _salted(materialize(keyed), lists, keys, salt_rows, (by,))
        keys.append("_salt")
    return keyed.join(lists, keys).select(*calls.columns, F.inline("_found"))


def _tasks(df: DataFrame) -> int:
    """Tasks for a step that takes long for its bytes: several a core, and no fewer than a shuffle has."""
    spark = df.sparkSession
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _listed(columns: list[str], df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a key as lists of ``columns``, of up to two to the power of ``LIST_BITS`` each.

    A call that meets lists looks up a few rows, not one for every event, and pairs come from a
    plain loop over each list.
    """
    row = F.struct(*columns)
    parts = df.sortWithinPartitions(*keys).withColumn("_part", F.shiftright(F.monotonically_increasing_id(), LIST_BITS))
    return parts.groupBy(*keys, "_part").agg(F.collect_list(row).alias("_found")).drop("_part")


def _rendered(
    columns: list[str], df: DataFrame, keys: list[str], render: Callable[[DataFrame], DataFrame] | None
) -> DataFrame:
    """``columns`` in their rendered form, the keys as they are."""
    if render is None:
        return df.select(*columns, *keys)
    held = df.select(*columns, *[F.struct(k).alias(k) for k in keys])
    shown = render(held)
    return shown.select(*columns, *[F.col(k)[k].alias(k) for k in keys])


def _prepared_events(calls: DataFrame, events: DataFrame, end_inclusive_day: bool, span: Column) -> DataFrame:
    """Events that calls can meet, with their flags filled."""
    kept = ["event_id", "event_name", "start_date", "end_date", "event_lat", "event_lon"]
    prepared = events_in_range(valid_events(events), calls, end_inclusive_day, span)
    flags = [c for c in EVENT_FLAGS if c in prepared.columns]
    return schemas.with_missing(
        prepared.select(*kept, *flags),
        schemas.struct("has_alcohol boolean, has_amplified_sound boolean"),
    ).na.fill(False, EVENT_FLAGS)


EVENT_FLAGS = ["has_alcohol", "has_amplified_sound"]
FACT_NAMES = {
    "start_date": "event_start_date",
    "end_date": "event_end_date",
    "has_alcohol": "event_has_alcohol",
    "has_amplified_sound": "event_has_amplified_sound",
}


def festival_incidents(
    calls: DataFrame,
    events: DataFrame,
    radius_km: float = 1.5,
    end_inclusive_day: bool = False,
    salt_rows: int = SALT_ROWS,
    broadcast_rows: int = BROADCAST_COPIES,
    render: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Fact of incidents that happened during an event and near it."""
    span = call_span(calls)
    prepared = _prepared_events(calls, events, end_inclusive_day, span)
    clash = [c for c in prepared.columns if c in events.columns]
    wanted = schemas.select_existing(calls.drop("distance_km", *clash), schemas.FESTIVAL_FACT_COLUMNS)
    pairs = pair_calls_with_events(
        wanted, prepared, radius_km, end_inclusive_day, span, salt_rows, broadcast_rows, render
    )
    return schemas.select_existing(pairs.withColumnsRenamed(FACT_NAMES), schemas.FESTIVAL_FACT_COLUMNS)


def festival_incident_counts(
    calls: DataFrame,
    events: DataFrame,
    measures: dict[str, Column],
    by: tuple[str, ...] = (),
    radius_km: float = 1.5,
    end_inclusive_day: bool = False,
    salt_rows: int = SALT_ROWS,
    broadcast_rows: int = BROADCAST_COPIES,
) -> DataFrame:
    """The fact of ``festival_incidents`` with calls alike counted, not listed.

    A row has an event, a moment of calls, their columns ``by`` and the ``measures`` over them. It has as
    many rows as events meet moments, however many calls each has, where the fact has the product.
    """
    span = call_span(calls)
    prepared = _prepared_events(calls, events, end_inclusive_day, span)
    counts = materialize(_with_moment(calls, span).groupBy(*MOMENT, *by).agg(*[m.alias(n) for n, m in measures.items()]))
    near = events_by_moment(
        counts, prepared, radius_km, end_inclusive_day, span, salt_rows, broadcast_rows
    )
    return near.withColumnsRenamed(FACT_NAMES)


def linked_calls(calls: DataFrame, counts: DataFrame) -> DataFrame:
    """Calls that occur in the fact, given its ``festival_incident_counts`` from the same calls."""
    return _with_moment(calls, call_span(calls)).join(counts.select(*MOMENT).distinct(), MOMENT, "left_semi").drop("_day", "_sharp")


def nearby_incidents(calls: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """Calls within a radius of one point, nearest first, distance in metres.

    The bounding box is a plain range filter, so it reaches the Parquet scan when
    the coordinates are stored columns.
    """
    lat_low, lat_high, lon_low, lon_high = bounding_box(lat, lon, radius_km)
    boxed = calls.where(F.col("latitude_centroid").between(lat_low, lat_high))
    if -180 <= lon_low and lon_high <= 180:
        boxed = boxed.where(F.col("longitude_centroid").between(lon_low, lon_high))
    distance = haversine_km(
        F.col("latitude_centroid"), F.col("longitude_centroid"), F.lit(lat), F.lit(lon)
    )
    found = boxed.withColumn("distance_km", distance).where(F.col("distance_km") <= radius_km)
    return found.select(
        "incident_number",
        (F.col("distance_km") * 1000).alias("distance_m"),
        "priority_level",
        "response_datetime",
    ).orderBy("distance_m", "incident_number")


def nearby_batch(
    calls: DataFrame, points: DataFrame, radius_km: float, salt_rows: int = SALT_ROWS,
    broadcast_rows: int = BROADCAST_COPIES,
) -> DataFrame:
    """Radius lookup for many points (point_id, lat, lon) in one grid join.

    All matches are the result, so it grows with the calls around each point.
    """
    grid = Grid(radius_km)
    located = calls.na.drop(subset=["latitude_centroid", "longitude_centroid"])
    band = grid.band(F.col("latitude_centroid"))
    keyed = located.withColumns(
        {"_band": band, "_cell": grid.cell(F.col("longitude_centroid"), band)}
    )
    copies = points.withColumn("_band", F.explode(grid.bands_around(F.col("lat"))))
    copies = copies.withColumn(
        "_cell", F.explode(grid.cells_around(F.col("lat"), F.col("lon"), F.col("_band")))
    )
    keys = ["_band", "_cell"]
    if at_most(copies, broadcast_rows):
        copies = F.broadcast(copies)
    else:
        keyed, copies = _salted(keyed, copies, keys, salt_rows)
        keys.append("_salt")
    distance = haversine_km(
        F.col("latitude_centroid"), F.col("longitude_centroid"), F.col("lat"), F.col("lon")
    )
    met = keyed.join(copies, keys).withColumn("distance_km", distance)
    return met.where(F.col("distance_km") <= radius_km).select(
        "point_id", "incident_number", (F.col("distance_km") * 1000).alias("distance_m"),
        "priority_level", "response_datetime",
    )
