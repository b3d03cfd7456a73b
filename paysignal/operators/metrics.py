"""Binary classification metrics."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 (0 where undefined) with the class sizes; one row."""
    hit, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(hit & guess).alias("tp"),
        F.count_if(~hit & guess).alias("fp"),
        F.count_if(hit & ~guess).alias("fn"),
        F.count_if(~hit & ~guess).alias("tn"),
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("positives"),
        (fp + tn).alias("negatives"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, score: str) -> dict[str, float]:
    """The reported metrics; ``roc_auc`` only when both classes occur.

    The area is exact (ties count half): scores are grouped and sorted over the
    cluster, only the final numbers reach the driver.
    """
    row = confusion(df, label, prediction).head()
    result = {name: row[name] for name in ("accuracy", "precision", "recall", "f1")}
    if row["positives"] > 0 and row["negatives"] > 0:
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="_score", labelCol="_label", metricName="areaUnderROC", numBins=0
        )
        scored = df.select(F.col(score).cast("double").alias("_score"), F.col(label).cast("double").alias("_label"))
        result["roc_auc"] = evaluator.evaluate(scored)
    return result
