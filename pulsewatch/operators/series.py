"""Daily workload series: lags, rolling statistics, calendar features, splits.

Windows here are ordered over one row per calendar day. That table has a few
thousand rows per decade whatever the number of calls, so one task orders it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.functions import values as V

LAGS = (1, 7, 14, 28)
WINDOWS = (7, 14, 30)


def daily_calls(calls: DataFrame) -> DataFrame:
    """Call count, mean priority and mean response time per day."""
    day = F.to_date("response_datetime").alias("date")
    return (
        calls.where(F.col("response_datetime").isNotNull())
        .groupBy(day)
        .agg(
            F.count("incident_number").alias("call_count"),
            F.avg("priority_numeric").alias("avg_priority"),
            F.avg("response_time").alias("avg_response_time"),
        )
    )


def fill_days(daily: DataFrame) -> DataFrame:
    """Add the days without calls between the first and the last, with count 0."""
    span = daily.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return calendar.join(daily, "date", "left").na.fill(0, ["call_count"])


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Weekday (Monday 0), month, day, weekend flag and their cyclic encodings."""
    df = df.withColumns(
        {
            "day_of_week": F.weekday(date),
            "month": F.month(date),
            "day_of_month": F.dayofmonth(date),
            "is_weekend": (F.weekday(date) >= 5).cast("int"),
        }
    )
    return df.withColumns(
        {
            "dow_sin": V.cycle_sin(F.col("day_of_week"), 7),
            "dow_cos": V.cycle_cos(F.col("day_of_week"), 7),
            "month_sin": V.cycle_sin(F.col("month"), 12),
            "month_cos": V.cycle_cos(F.col("month"), 12),
        }
    )


def add_lags(df: DataFrame, column: str, lags: Sequence[int], order: str = "date") -> DataFrame:
    """Value ``k`` rows earlier; by position, so a missing day shifts the meaning."""
    by_day = Window.orderBy(order)
    return df.withColumns({f"{column}_lag_{k}": F.lag(column, k).over(by_day) for k in lags})


def add_rolling(
    df: DataFrame,
    column: str,
    windows: Sequence[int],
    order: str = "date",
    exclude_current: bool = False,
) -> DataFrame:
    """Rolling mean and sample deviation, NULL until the window is full.

    By default the window ends with the row itself; ``exclude_current`` moves it
    one row back so that the target is not among its own features.
    """
    shift = 1 if exclude_current else 0
    updates = {}
    for n in windows:
        frame = Window.orderBy(order).rowsBetween(-(n - 1) - shift, -shift)
        full = F.count(column).over(frame) == n
        updates[f"{column}_rolling_mean_{n}"] = F.when(full, F.avg(column).over(frame))
        updates[f"{column}_rolling_std_{n}"] = F.when(full, F.stddev_samp(column).over(frame))
    return df.withColumns(updates)


def daily_features(
    daily: DataFrame,
    weather: DataFrame | None = None,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    exclude_current: bool = False,
    fill_calendar: bool = False,
    complete_only: bool = True,
) -> DataFrame:
    """Feature table of the workload forecast."""
    base = fill_days(daily) if fill_calendar else daily
    df = add_lags(calendar_features(base), "call_count", lags)
    df = add_rolling(df, "call_count", windows, exclude_current=exclude_current)
    if weather is not None:
        df = df.join(weather, "date", "left")
    return df.na.drop() if complete_only else df


def time_split(df: DataFrame, order: str = "date", share: float = 0.8) -> DataFrame:
    """Mark the first ``share`` of the days as training rows."""
    whole = Window.orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    place = F.row_number().over(Window.orderBy(order))
    total = F.count("*").over(whole)
    return df.withColumn("is_train", place <= F.floor(total * F.lit(share)))


def recent_levels(daily: DataFrame) -> DataFrame:
    """Last day, recent lags and means; short series fall back to the overall mean."""
    ranked = daily.withColumn("_back", F.row_number().over(Window.orderBy(F.desc("date"))))
    mean = F.avg("call_count")
    n = F.count("*")

    def back(k: int):
        return F.coalesce(
            F.max(F.when(F.col("_back") == k, F.col("call_count"))).cast("double"), mean
        )

    def recent_mean(k: int):
        return F.when(n >= k, F.avg(F.when(F.col("_back") <= k, F.col("call_count")))).otherwise(
            mean
        )

    return ranked.agg(
        F.max("date").alias("last_date"),
        mean.alias("avg_calls"),
        back(1).alias("call_count_lag_1"),
        back(7).alias("call_count_lag_7"),
        back(14).alias("call_count_lag_14"),
        back(28).alias("call_count_lag_28"),
        recent_mean(7).alias("call_count_rolling_mean_7"),
        recent_mean(14).alias("call_count_rolling_mean_14"),
    )


def next_week(daily: DataFrame) -> DataFrame:
    """Feature rows of the seven days after the last; all share the frozen lags."""
    recent = recent_levels(daily)
    days = recent.withColumn(
        "date",
        F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", 7))),
    )
    return calendar_features(days)


def outlook_7d(daily: DataFrame, model=None) -> DataFrame:
    """Whole calls per day for the next week: the model's, or the mean without one."""
    week = next_week(daily)
    if model is None:
        return week.select("date", F.col("avg_calls").cast("int").alias("predicted_calls"))
    predicted = model.transform(week)
    whole = F.greatest(F.lit(0), F.col("prediction").cast("int"))
    return predicted.select("date", whole.alias("predicted_calls"))
