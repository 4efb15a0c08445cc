"""Evaluation: every metric is a table, computed by aggregates over the predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.ordering import with_running_totals


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row of MSE, RMSE, MAE, r2 and explained variance from a single pass."""
    y, p = F.col(label), F.col(prediction)
    error = y - p
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("label_variance"),
        F.avg(y).alias("label_mean"),
        F.var_pop(p).alias("prediction_variance"),
        F.avg(p).alias("prediction_mean"),
    )
    shift = F.col("prediction_mean") - F.col("label_mean")
    return stats.select(
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (1 - F.try_divide("mse", "label_variance")).alias("r2"),
        (F.col("prediction_variance") + shift * shift).alias("explained_variance"),
    )


def rmse_evaluator(label: str = "label", prediction: str = "prediction") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


def auc_evaluator(label: str = "label", score: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under the exact ROC curve: ``numBins=0`` merges no thresholds."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right, and the test error ``1 - accuracy``."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy")).select(
        "n", "accuracy", (1 - F.col("accuracy")).alias("test_error")
    )


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    area = auc_evaluator(label, score).evaluate(df)
    return df.sparkSession.createDataFrame([(float(area),)], "auc double")


def threshold_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Confusion rates at every distinct score used as a threshold (``score >= threshold``).

    Scores are counted first and accumulated from high to low in sorted
    partitions, so neither the rows nor the curve pass through one task.
    """
    positive = F.col(label) == 1
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    reached = with_running_totals(
        counts, [F.desc("threshold")], {"tp": "positives", "fp": "negatives"}
    )
    total = reached.agg(F.max("tp"), F.max("fp")).first()
    all_positive, all_negative = int(total[0] or 0), int(total[1] or 0)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.try_divide("tp", F.lit(all_positive))
    return reached.select(
        "threshold",
        "tp",
        "fp",
        F.try_divide("fp", F.lit(all_negative)).alias("fpr"),
        recall.alias("tpr"),
        precision.alias("precision"),
        (F.lit(2.0) * F.col("tp") / (F.col("tp") + F.col("fp") + F.lit(all_positive))).alias("f1"),
    )


def best_threshold(table: DataFrame) -> DataFrame:
    """The threshold with the largest F-measure; the highest one on a tie."""
    best = F.max_by("threshold", F.struct("f1", "threshold"))
    return table.agg(best.alias("threshold"), F.max("f1").alias("f1"))


def silhouette(df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums."""
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=prediction)
    value = evaluator.evaluate(df)
    return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")
