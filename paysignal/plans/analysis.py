"""Risk analyses over the consolidated table, in two variants each.

The first variant of an analysis is the job version, the ``*_sql`` one the
query-service version; they differ in filters and columns on purpose.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.functions.columns import code_list
from paysignal.schemas import CONSOLIDATED_COLUMNS
from paysignal.sinks.files import write_result

# Fixed value: score from which a payment counts as high risk.
HIGH_RISK = 70.0


@dataclass(frozen=True)
class AnalysisLimits:
    score: float = HIGH_RISK
    min_high_risk: int = 2
    tx_5m: int = 8
    card_countries: int = 2
    countries_1h: int = 2
    countries: str = "RU,NG,KP,IR"


_PLAIN_COLUMNS = [c for c in CONSOLIDATED_COLUMNS if not c.startswith("source_")]


def typed(consolidated: DataFrame) -> DataFrame:
    types = {"risk_score": "double", "tx_5m": "int", "merchants_10m": "int", "countries_1h": "int"}
    return consolidated.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def _is_high(threshold: float) -> Column:
    return F.col("risk_score") >= F.lit(float(threshold))


def high_risk_tx(base: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    reason = F.when(_is_high(threshold), "high_risk_score").otherwise("declined_status")
    return base.filter(_is_high(threshold) | (F.col("status") == "declined")).select(
        *_PLAIN_COLUMNS, reason.alias("risk_reason")
    )


def high_risk_tx_sql(base: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    return base.filter(_is_high(threshold) | (F.lower("status") == "declined")).select(*_PLAIN_COLUMNS)


def _cards(base: DataFrame, threshold: float, min_high_risk: int, max_tx: int, countries: int, extra: list[Column]) -> DataFrame:
    return (
        base.groupBy("card_id")
        .agg(
            F.count(F.lit(1)).alias("total_tx"),
            F.count_if(_is_high(threshold)).alias("high_risk_tx"),
            F.avg("risk_score").alias("avg_risk_score"),
            F.max("tx_5m").alias("max_tx_5m"),
            *extra,
            F.count_distinct("country").alias("distinct_countries"),
        )
        .filter(
            (F.col("high_risk_tx") >= min_high_risk)
            | (F.col("max_tx_5m") >= max_tx)
            | (F.col("distinct_countries") >= countries)
        )
    )


def suspicious_cards(base: DataFrame, threshold: float = HIGH_RISK, min_high_risk: int = 2, max_tx: int = 8,
                     countries: int = 2) -> DataFrame:
    extra = [F.max("merchants_10m").alias("max_merchants_10m")]
    return _cards(base, threshold, min_high_risk, max_tx, countries, extra)


def suspicious_cards_sql(base: DataFrame, threshold: float = HIGH_RISK, min_high_risk: int = 2, max_tx: int = 8,
                         countries: int = 2) -> DataFrame:
    return _cards(base, threshold, min_high_risk, max_tx, countries, [])


def _geography(base: DataFrame, threshold: float, extra: list[Column]) -> DataFrame:
    return base.groupBy("country", F.date_trunc("hour", "event_time").alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("total_tx"),
        F.count_if(_is_high(threshold)).alias("high_risk_tx"),
        *extra,
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_distinct("card_id").alias("distinct_cards"),
    )


def geo_patterns(base: DataFrame, threshold: float = HIGH_RISK, countries_1h: int = 2,
                 countries: str | Iterable[str] = "RU,NG,KP,IR") -> DataFrame:
    extra = [
        F.count_if(F.col("status") == "declined").alias("declined_tx"),
        F.max("countries_1h").alias("max_countries_1h"),
    ]
    listed = F.when(F.col("country").isin(code_list(countries)), 1).otherwise(0)
    return (
        _geography(base, threshold, extra)
        .withColumn("is_suspicious_country", listed)
        .filter(
            (F.col("high_risk_tx") > 0)
            | (F.col("declined_tx") > 0)
            | (F.col("max_countries_1h") >= countries_1h)
            | (F.col("is_suspicious_country") == 1)
        )
    )


def geo_patterns_sql(base: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    return (
        _geography(base, threshold, [])
        .filter(F.col("high_risk_tx") > 0)
        .orderBy(F.desc("high_risk_tx"), F.desc("avg_risk_score"), "country", "hour_bucket")
    )


def write_analyses(spark: SparkSession, base: DataFrame, root: str, file_format: str = "parquet",
                   mode: str = "overwrite", limits: AnalysisLimits = AnalysisLimits()) -> DataFrame:
    """Write the three analyses and a summary of where they went; returns the summary."""
    results = {
        "high_risk_transactions": high_risk_tx(base, limits.score),
        "suspicious_cards": suspicious_cards(base, limits.score, limits.min_high_risk, limits.tx_5m, limits.card_countries),
        "geo_fraud_patterns": geo_patterns(base, limits.score, limits.countries_1h, limits.countries),
    }
    written = [(name, write_result(df, root, name, file_format, mode)) for name, df in results.items()]
    summary = spark.createDataFrame(written, "dataset string, output_path string")
    write_result(summary, root, "summary", file_format, mode)
    return summary
