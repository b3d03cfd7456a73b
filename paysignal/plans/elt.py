"""Merging two payment sources into one consolidated, risk-filtered table."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.functions import normalize
from paysignal.functions.columns import code_list, not_blank, pick
from paysignal.operators.dedup import latest_per_key
from paysignal.schemas import CANONICAL_COLUMNS, CONSOLIDATED_COLUMNS


@dataclass(frozen=True)
class RiskThresholds:
    """The default limits of the risk filter."""

    score: float = 60
    tx_5m: int = 5
    merchants_10m: int = 4
    countries_1h: int = 3
    countries: str | Iterable[str] = "RU,NG,KP,IR"


def canonical(df: DataFrame, source: str) -> DataFrame:
    """One source in the common 11-column form, valid rows only, one per payment."""

    def feature(names: list[str], type_name: str) -> Column:
        return F.coalesce(pick(df, names, type_name), F.lit(0).cast(type_name))

    columns = {
        "payment_id": F.trim(pick(df, ["payment_id"])),
        "card_id": F.upper(F.trim(pick(df, ["card_id"]))),
        "amount": pick(df, ["amount", "amt"], "double"),
        "event_time": normalize.event_time(df),
        "country": normalize.country_code(pick(df, ["country", "country_code", "pais"])),
        "status": normalize.payment_status(pick(df, ["status", "payment_status"])),
        "risk_score": feature(["risk_score"], "double"),
        "tx_5m": feature(["tx_5m", "tx_by_card_5m"], "int"),
        "merchants_10m": feature(["merchants_10m", "distinct_merchants_10m"], "int"),
        "countries_1h": feature(["countries_1h", "distinct_countries_1h"], "int"),
        "source": F.lit(source),
    }
    valid = (
        df.select(*[columns[c].alias(c) for c in CANONICAL_COLUMNS])
        .filter(not_blank(F.col("payment_id")) & not_blank(F.col("card_id")))
        .filter((F.col("amount") >= 0) & F.col("event_time").isNotNull())
    )
    return latest_per_key(valid, "payment_id", ["event_time"])


def merge(store: DataFrame, database: DataFrame) -> DataFrame:
    """Full join on the payment id; the object-store side wins field by field.

    Both sides are already hash-partitioned by payment id from the
    de-duplication, so the join adds no shuffle, and every key is unique.
    """
    s, r = store.alias("s"), database.alias("r")
    fields = [c for c in CANONICAL_COLUMNS if c not in ("payment_id", "source")]
    merged = s.join(r, "payment_id", "full").select(
        "payment_id",
        *[F.coalesce(f"s.{c}", f"r.{c}").alias(c) for c in fields],
        F.col("s.source").alias("source_s3"),
        F.col("r.source").alias("source_rds"),
    )
    return (
        merged.filter(not_blank(F.col("card_id")) & (F.col("amount") >= 0))
        .withColumn("event_date", F.to_date("event_time"))
        .select(*CONSOLIDATED_COLUMNS)
    )


def is_risky(limits: RiskThresholds = RiskThresholds()) -> Column:
    """High score, high frequency or suspicious geography."""
    frequent = (F.col("tx_5m") >= limits.tx_5m) | (F.col("merchants_10m") >= limits.merchants_10m)
    geography = (F.col("countries_1h") >= limits.countries_1h) | F.col("country").isin(code_list(limits.countries))
    return (F.col("risk_score") >= F.lit(float(limits.score))) | frequent | geography


def consolidate(store: DataFrame, database: DataFrame, limits: RiskThresholds = RiskThresholds()) -> DataFrame:
    """Both raw sources to the consolidated table of risky payments."""
    return merge(canonical(store, "s3"), canonical(database, "rds")).filter(is_risky(limits))


def stage_counts(merged: DataFrame, limits: RiskThresholds = RiskThresholds()) -> DataFrame:
    """Rows per stage in one pass: provenance tells how many rows each side gave."""
    counts = merged.agg(
        F.count("source_s3").alias("s3_clean"),
        F.count("source_rds").alias("rds_clean"),
        F.count(F.lit(1)).alias("merged"),
        F.count_if(is_risky(limits)).alias("filtered"),
    )
    return counts.unpivot([], ["s3_clean", "rds_clean", "merged", "filtered"], "stage", "row_count")
