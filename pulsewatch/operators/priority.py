"""Priority prediction with random forests."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.functions import values as V
from pulsewatch.operators.knn import incident_features
from pulsewatch.session import materialize

# Training rows beyond which a forest is grown in several tasks, up to the number of cores.
TASK_ROWS = 25_000
# Row and tree pairs up to which the node of each is kept (4 bytes each), not found from the root again for each level.
NODE_IDS = 1_000_000_000


def encode_category(df: DataFrame, column: str, out: str) -> DataFrame:
    """Label encoding in alphabetical order; NULL counts as 'Unknown'."""
    filled = df.withColumn("_c", F.coalesce(F.col(column), F.lit("Unknown")))
    indexer = StringIndexer(inputCol="_c", outputCol=out, stringOrderType="alphabetAsc")
    return indexer.fit(filled).transform(filled).drop("_c").withColumn(out, F.col(out).cast("int"))


def priority_features(
    df: DataFrame, key: str = "incident_number"
) -> tuple[DataFrame, list[str]]:
    """Feature rows of calls with a known priority, and the feature names."""
    known = df.withColumn("priority_class", V.priority_class(F.col("priority_level"))).where(
        F.col("priority_class").isNotNull()
    )
    featured, columns = incident_features(known.drop("priority_numeric"))
    if "response_hour" in df.columns:
        columns.insert(columns.index("hour_cos") + 1, "response_hour")
    if "initial_problem_category" in df.columns:
        featured = encode_category(featured, "initial_problem_category", "category_encoded")
        columns.append("category_encoded")
    rows = featured.select(key, *columns, "priority_class")
    return rows.na.drop(subset=columns), columns


def balance(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class), so every class weighs the same in total."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    weights = counts.select(label, (total / (classes * F.col("_n"))).alias(out))
    # one row per class
    return df.join(F.broadcast(weights), label)


def forest_pipeline(
    columns: list[str],
    label: str = "priority_class",
    trees: int = 100,
    depth: int = 15,
    min_leaf: int = 5,
    seed: int = 42,
    weight: str | None = "weight",
) -> Pipeline:
    """Scaled features into a random forest."""
    forest = RandomForestClassifier(
        featuresCol="scaled",
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
            forest,
        ]
    )


def dealt(train: DataFrame, rows: int) -> DataFrame:
    """Training rows over as many tasks as they are worth; a forest grows in the tasks its rows lie in."""
    tasks = min(-(-rows // TASK_ROWS), train.sparkSession.sparkContext.defaultParallelism)
    return train if train.rdd.getNumPartitions() >= tasks else materialize(train.repartition(tasks))


def kept_nodes(pipeline: Pipeline, rows: int) -> Pipeline:
    """The pipeline, its forest keeping the node of each row where that is small; the forest is the same."""
    forest = pipeline.getStages()[-1]
    forest.setCacheNodeIds(rows * forest.getNumTrees() <= NODE_IDS)
    return pipeline


def train_priority(train: DataFrame, columns: list[str], **options) -> PipelineModel:
    rows = train.count()
    pipeline = kept_nodes(forest_pipeline(columns, **options), rows)
    return pipeline.fit(balance(dealt(train, rows), "priority_class"))


def predict(model: PipelineModel, df: DataFrame, key: str, label: str) -> DataFrame:
    scored = model.transform(df)
    return scored.select(
        key, F.col(label).cast("int").alias("label"), F.col("prediction").cast("int")
        .alias("prediction")
    )


def cross_validate(
    train: DataFrame, columns: list[str], folds: int = 5, seed: int = 42, **options
) -> float:
    """Mean accuracy over the folds."""
    rows = train.count()
    balanced = balance(dealt(train, rows), "priority_class").withColumn("_fold", F.floor(F.rand(seed) * folds))
    balanced = materialize(balanced)
    pipeline = kept_nodes(forest_pipeline(columns, seed=seed, **options), rows)
    judge = MulticlassClassificationEvaluator(labelCol="priority_class", metricName="accuracy")
    found = []
    for fold in range(folds):
        # only the accuracy is asked for, so no forest is grown on all rows
        model = pipeline.fit(balanced.where(F.col("_fold") != fold))
        found.append(judge.evaluate(model.transform(balanced.where(F.col("_fold") == fold))))
    return sum(found) / folds


def feature_importance(
    spark: SparkSession, model: PipelineModel, columns: list[str]
) -> DataFrame:
    """Features of the fitted forest, most important first (one row per feature)."""
    forest: RandomForestClassificationModel = model.stages[-1]
    weights = forest.featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(columns, weights)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def small_forest(calls: DataFrame, trees: int = 10, depth: int = 3, seed: int = 42) -> DataFrame:
    """Fallback model on hour and weekday code; predicts the numeric priority."""
    coded = encode_category(calls, "response_day_of_week", "dow_num").withColumn(
        "hour", F.coalesce("response_hour", F.lit(12)).cast("double")
    )
    known = coded.where(F.col("priority_numeric").isNotNull())
    model = forest_pipeline(
        ["hour", "dow_num"], "priority_numeric", trees, depth, 1, seed, weight=None
    ).fit(known)
    return predict(model, coded, "incident_number", "priority_numeric")
