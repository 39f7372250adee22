"""Classification reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classification_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and averages.

    The rows collapse to the confusion counts first; the rest is arithmetic on them.
    """
    counts = predictions.groupBy(
        F.col(label).cast("string").alias("actual"), F.col(prediction).cast("string").alias("guess")
    ).agg(F.count("*").alias("n"))
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class_name"),
                    F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(0).alias("hit"),
                    F.col("n").alias("real"),
                    F.lit(0).cast("long").alias("said"),
                ),
                F.struct(
                    F.col("guess").alias("class_name"),
                    F.lit(0).cast("long").alias("hit"),
                    F.lit(0).cast("long").alias("real"),
                    F.col("n").alias("said"),
                ),
            )
        )
    )
    sums = sides.groupBy("class_name").agg(
        F.sum("hit").alias("hit"), F.sum("real").alias("support"), F.sum("said").alias("said")
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    scored = sums.withColumns(
        {
            "precision": ratio(F.col("hit"), F.col("said")),
            "recall": ratio(F.col("hit"), F.col("support")),
        }
    )
    both = F.col("precision") + F.col("recall")
    scored = scored.withColumn("f1_score", ratio(2 * F.col("precision") * F.col("recall"), both))
    measures = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    accuracy = F.sum("hit") / F.nullif(total, F.lit(0))
    summary = scored.agg(
        accuracy.alias("accuracy"),
        *[F.avg(m).alias(f"m_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"w_{m}") for m in measures],
        total.alias("support"),
    )
    averages = summary.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class_name"),
                    *[F.col("accuracy").alias(m) for m in measures],
                    F.col("support"),
                ),
                *[
                    F.struct(
                        F.lit(name).alias("class_name"),
                        *[F.col(f"{p}_{m}").alias(m) for m in measures],
                        F.col("support"),
                    )
                    for name, p in (("macro avg", "m"), ("weighted avg", "w"))
                ],
            )
        )
    )
    return scored.select("class_name", *measures, "support").unionByName(averages)
