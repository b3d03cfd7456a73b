"""Dashboard queries over the Bronze, Silver and alert tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.schemas import FEATURE_COLUMNS


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer: ``metric``, ``total``."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(metric).alias("metric"), "total")
        for metric, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def alerts_per_hour(alerts: DataFrame, first: int = 0) -> DataFrame:
    """Alert count per hour in time order; only the ``first`` hours if given."""
    hours = (
        alerts.groupBy(F.date_trunc("hour", "event_time").alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("total_alerts"))
        .orderBy("hour_bucket")
    )
    return hours.limit(first) if first > 0 else hours


def riskiest(alerts: DataFrame, entity: str, top: int = 20) -> DataFrame:
    """Entities by mean alert score, then by number of alerts."""
    return (
        alerts.groupBy(entity)
        .agg(F.avg("risk_score").alias("avg_risk_score"), F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("avg_risk_score"), F.desc("alert_count"), entity)
        .limit(top)
    )


def top_alerts(alerts: DataFrame, top: int = 20) -> DataFrame:
    return alerts.orderBy(F.desc("risk_score"), "payment_id").limit(top)


def recent_features(silver: DataFrame, top: int = 20) -> DataFrame:
    """Newest payments with their behaviour features."""
    return (
        silver.select("payment_id", "card_id", "event_time", *FEATURE_COLUMNS)
        .orderBy(F.desc("event_time"), "payment_id")
        .limit(top)
    )
