import datetime as dt

import numpy as np
import pandas as pd
import pytest

from pulsewatch.operators import forecast, series
from pulsewatch.sources import sinks

DAY = dt.date(2024, 1, 1)


def daily(spark, n, skip=()):
    rng = np.random.default_rng(4)
    rows = [
        (DAY + dt.timedelta(days=i), int(50 + 10 * np.sin(i / 7 * 6.28) + rng.integers(0, 9)), 2.0, 60.0)
        for i in range(n)
        if i not in skip
    ]
    return spark.createDataFrame(
        rows, "date date, call_count long, avg_priority double, avg_response_time double"
    )


def test_lags_and_rolling_equal_pandas(spark):
    df = daily(spark, 60, skip=(10, 11))
    got = series.daily_features(df, complete_only=False).orderBy("date").toPandas()
    base = df.orderBy("date").toPandas()
    for k in series.LAGS:
        want = base["call_count"].shift(k)
        np.testing.assert_allclose(got[f"call_count_lag_{k}"].astype(float), want)
    for n in series.WINDOWS:
        roll = base["call_count"].rolling(n)
        np.testing.assert_allclose(got[f"call_count_rolling_mean_{n}"].astype(float), roll.mean())
        np.testing.assert_allclose(got[f"call_count_rolling_std_{n}"].astype(float), roll.std())
    dates = pd.to_datetime(base["date"])
    assert list(got["day_of_week"]) == list(dates.dt.dayofweek)
    np.testing.assert_allclose(got["dow_sin"], np.sin(2 * np.pi * dates.dt.dayofweek / 7))
    assert list(got["is_weekend"]) == list((dates.dt.dayofweek >= 5).astype(int))


def test_options(spark):
    df = daily(spark, 20, skip=(5,))
    filled = series.fill_days(df)
    assert filled.count() == 20
    assert filled.where("call_count = 0").first()["date"] == DAY + dt.timedelta(days=5)
    shifted = series.add_rolling(df, "call_count", (3,), exclude_current=True).orderBy("date")
    values = [r["call_count"] for r in shifted.collect()]
    means = [r["call_count_rolling_mean_3"] for r in shifted.collect()]
    assert means[:3] == [None, None, None]
    assert means[3] == pytest.approx(sum(values[:3]) / 3)


def test_daily_calls_ignore_undated(spark, ts):
    calls = spark.createDataFrame(
        [("a", ts("2024-01-01 00:00"), 1, 10.0), ("b", ts("2024-01-01 23:59"), 3, None),
         ("c", None, 1, 1.0)],
        "incident_number string, response_datetime timestamp_ntz, priority_numeric int, "
        "response_time double",
    )
    (row,) = series.daily_calls(calls).collect()
    assert (row["call_count"], row["avg_priority"], row["avg_response_time"]) == (2, 2.0, 10.0)


def test_split_is_by_time(spark):
    marked = series.time_split(daily(spark, 11)).orderBy("date").collect()
    assert [r["is_train"] for r in marked] == [True] * 8 + [False] * 3


def test_outlook_mean_and_frozen_lags(spark):
    df = daily(spark, 9)
    counts = [r["call_count"] for r in df.orderBy("date").collect()]
    week = series.outlook_7d(df).orderBy("date").collect()
    assert [r["date"] for r in week] == [DAY + dt.timedelta(days=9 + i) for i in range(7)]
    assert {r["predicted_calls"] for r in week} == {int(sum(counts) / 9)}
    inputs = series.next_week(df).collect()
    assert {r["call_count_lag_1"] for r in inputs} == {float(counts[-1])}
    assert {r["call_count_lag_7"] for r in inputs} == {float(counts[-7])}
    mean = sum(counts) / 9
    assert inputs[0]["call_count_lag_14"] == pytest.approx(mean)
    assert inputs[0]["call_count_rolling_mean_14"] == pytest.approx(mean)
    assert inputs[0]["call_count_rolling_mean_7"] == pytest.approx(sum(counts[-7:]) / 7)


@pytest.mark.parametrize("scale_on", ["train", "all"])
def test_ridge_equals_closed_form(spark, scale_on):
    features = series.daily_features(daily(spark, 150))
    columns = forecast.feature_columns(features)
    (fit,) = forecast.fit_models(features, which=("ridge",), scale_on=scale_on)
    pdf = features.orderBy("date").toPandas()
    cut = int(len(pdf) * 0.8)
    x, y = pdf[columns].to_numpy(float), pdf["call_count"].to_numpy(float)
    base = x if scale_on == "all" else x[:cut]
    spread = base.std(axis=0)
    spread[spread == 0] = 1.0
    z = (x - base.mean(axis=0)) / spread
    xt, yt = z[:cut], y[:cut]
    xc, yc = xt - xt.mean(axis=0), yt - yt.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(len(columns)), xc.T @ yc)
    want = (z[cut:] - xt.mean(axis=0)) @ w + yt.mean()
    got = forecast.forecast_table(fit).toPandas()
    np.testing.assert_allclose(got["predicted"], want, rtol=1e-6)
    assert list(got["actual"]) == list(y[cut:])


def test_best_model_needs_strictly_better_fit(spark):
    a = forecast.Fitted("ridge", None, {"r2": 0.5}, None)
    b = forecast.Fitted("gbt", None, {"r2": 0.5}, None)
    c = forecast.Fitted("gbt", None, {"r2": 0.6}, None)
    assert forecast.best_model([a, b]).name == "ridge"
    assert forecast.best_model([a, c]).name == "gbt"


def test_saved_model_predicts_the_same(spark, tmp_path):
    features = series.daily_features(daily(spark, 120))
    (fit,) = forecast.fit_models(features, which=("ridge",))
    sinks.save_model(fit.model, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m")).transform(features).orderBy("date")
    want = fit.model.transform(features).orderBy("date")
    assert [r["prediction"] for r in again.collect()] == [r["prediction"] for r in want.collect()]


def test_model_outlook_is_whole_and_not_negative(spark):
    df = daily(spark, 120)
    features = series.daily_features(df)
    (fit,) = forecast.fit_models(features, which=("gbt",), trees=3, columns=forecast.FEATURES)
    week = series.outlook_7d(df, fit.model).collect()
    assert len(week) == 7 and all(isinstance(r["predicted_calls"], int) for r in week)
    assert all(r["predicted_calls"] >= 0 for r in week)
