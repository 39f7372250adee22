"""Daily workload forecast: ridge regression against gradient boosting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.operators.series import time_split
from pulsewatch.session import materialize

FEATURES = [
    "day_of_week", "month", "is_weekend",
    "dow_sin", "dow_cos", "month_sin", "month_cos",
    "call_count_lag_1", "call_count_lag_7", "call_count_lag_14",
    "call_count_rolling_mean_7", "call_count_rolling_mean_14",
]
WEATHER_FEATURES = ["temp_avg_f", "precipitation_total_mm", "humidity_avg_pct"]
TARGET = "call_count"


@dataclass
class Fitted:
    """A fitted model with its hold-out measures and predictions."""

    name: str
    model: PipelineModel
    metrics: dict[str, float]
    predictions: DataFrame


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in FEATURES + WEATHER_FEATURES if c in features.columns]


def _scaler(rows: DataFrame, columns: list[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return PipelineModel(stages=[assembler, scaler.fit(assembler.transform(rows))])


def ridge(train: DataFrame, alpha: float, scaled_rows: int) -> LinearRegression:
    """Estimator equal to min |y - Xw|^2 + alpha |w|^2 on population-scaled X.

    The scaler divides by the sample deviation, which shrinks X by sqrt((n-1)/n);
    the penalty is shrunk to match. The regression divides the penalty by the
    label's deviation internally, hence the factor sigma / n.
    """
    row = train.agg(F.stddev_pop(TARGET).alias("sigma"), F.count("*").alias("n")).first()
    adjusted = alpha * (scaled_rows - 1) / scaled_rows
    return LinearRegression(
        featuresCol="scaled",
        labelCol=TARGET,
        regParam=adjusted * (row["sigma"] or 0.0) / row["n"],
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def _judge(predictions: DataFrame) -> dict[str, float]:
    judge = RegressionEvaluator(labelCol=TARGET, predictionCol="prediction")
    return {m: judge.setMetricName(m).evaluate(predictions) for m in ("mae", "rmse", "r2")}


def fit_models(
    features: DataFrame,
    columns: list[str] | None = None,
    alpha: float = 1.0,
    trees: int = 100,
    depth: int = 5,
    share: float = 0.8,
    scale_on: str = "train",
    seed: int = 42,
    which: tuple[str, ...] = ("ridge", "gbt"),
) -> list[Fitted]:
    """Fit the models on the first ``share`` of days and judge them on the rest.

    ``scale_on='all'`` fits the scaler on all days, as a one-table script would.
    """
    columns = columns or feature_columns(features)
    split = materialize(time_split(features, share=share))
    train, test = split.where("is_train"), split.where("NOT is_train")
    base = split if scale_on == "all" else train
    scaler = _scaler(base, columns)
    scaled_train = materialize(scaler.transform(train))
    estimators = {
        "ridge": lambda: ridge(scaled_train, alpha, base.count()),
        "gbt": lambda: GBTRegressor(
            featuresCol="scaled", labelCol=TARGET, maxIter=trees, maxDepth=depth,
            stepSize=0.1, seed=seed,
        ),
    }
    fitted = []
    for name in which:
        model = PipelineModel(stages=[*scaler.stages, estimators[name]().fit(scaled_train)])
        predictions = model.transform(test)
        fitted.append(Fitted(name, model, _judge(predictions), predictions))
    return fitted


def best_model(fitted: list[Fitted]) -> Fitted:
    """The first model unless a later one has strictly better R squared."""
    best = fitted[0]
    for other in fitted[1:]:
        if other.metrics["r2"] > best.metrics["r2"]:
            best = other
    return best


def forecast_table(fitted: Fitted) -> DataFrame:
    return fitted.predictions.select(
        "date",
        F.col(TARGET).cast("double").alias("actual"),
        F.col("prediction").alias("predicted"),
        F.lit(fitted.name).alias("model"),
    ).orderBy("date")


def forecast(features: DataFrame, **options) -> DataFrame:
    """Date, actual and predicted calls on the held-out days, by the better model."""
    return forecast_table(best_model(fit_models(features, **options)))


def metric_rows(spark: SparkSession, fitted: list[Fitted]) -> DataFrame:
    rows = [(f.name, *[float(f.metrics[m]) for m in ("mae", "rmse", "r2")]) for f in fitted]
    return spark.createDataFrame(rows, "model string, mae double, rmse double, r2 double")
