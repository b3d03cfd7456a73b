"""Bronze to Silver: typing, filtering, de-duplication and behaviour features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.functions.columns import is_timestamp
from paysignal.operators.dedup import latest_per_key
from paysignal.operators.joins import attach, attach_to_hubs
from paysignal.operators.trailing import Trailing, trailing_features
from paysignal.schemas import FEATURE_COLUMNS, SHORT_SILVER_COLUMNS

# Trailing ranges of the behaviour features.
CARD_WINDOWS = [
    Trailing("tx_by_card_5m", "count", "payment_id", 300),
    Trailing("distinct_merchants_10m", "distinct", "merchant_id", 600),
    Trailing("distinct_countries_1h", "distinct", "country", 3600),
    Trailing("declined_ratio_1h", "mean", "declined", 3600),
]
REQUIRED_KEYS = ("payment_id", "card_id", "device_id")


def clean(bronze: DataFrame, order: str = "ingestion_ts", strict: bool = True) -> DataFrame:
    """Typed rows with a valid event time, one per payment.

    ``order`` names the time that decides which copy is the latest
    (``ingestion_ts`` or ``event_time``). ``strict=False`` keeps rows whose
    required keys are null.
    """
    moment = F.col("event_time") if is_timestamp(bronze, "event_time") else F.try_to_timestamp("event_time")
    types = {"amount": "double", "attempt_number": "int", "status": "string", "mcc": "string"}
    typed = bronze.withColumns(
        {
            "event_time": moment.cast("timestamp"),
            **{c: F.col(c).try_cast(t) for c, t in types.items() if c in bronze.columns},
        }
    ).filter(F.col("event_time").isNotNull())
    if strict:
        typed = typed.dropna(subset=list(REQUIRED_KEYS))
    times = ["ingestion_ts", "event_time"] if order == "ingestion_ts" else ["event_time", "ingestion_ts"]
    return latest_per_key(typed, "payment_id", [c for c in times if c in typed.columns])


def device_card_counts(rows: DataFrame) -> DataFrame:
    """Distinct cards per device over all time (later rows count as well)."""
    return rows.groupBy("device_id").agg(
        F.count_distinct("card_id").cast("int").alias("distinct_cards_per_device")
    )


def features(
    cleaned: DataFrame,
    windows: list[Trailing] | None = None,
    bucket_seconds: int | None = None,
    strict: bool = True,
) -> DataFrame:
    """Cleaned payments with the five behaviour features.

    The wide rows are shuffled once, for the last join on the payment id; all
    other joins and aggregates run on narrow projections. Pass a staged table:
    the branches then scan just their own columns.
    """
    nulls_match = not strict
    windows = windows or CARD_WINDOWS
    narrow = cleaned.withColumns(
        {
            "second": F.unix_seconds("event_time"),
            "declined": F.coalesce(F.col("status") == "declined", F.lit(False)).cast("int"),
        }
    )
    per_card_second = trailing_features(narrow, "card_id", "second", windows, bucket_seconds)
    per_device = device_card_counts(narrow)
    per_payment = narrow.select("payment_id", "card_id", "device_id", "second")
    per_payment = attach(per_payment, per_card_second, ["card_id", "second"], nulls_match)
    per_payment = attach_to_hubs(per_payment, per_device, "device_id", nulls_match)
    per_payment = per_payment.withColumn("declined_ratio_1h", F.round("declined_ratio_1h", 4))
    return attach(
        cleaned, per_payment.select("payment_id", *FEATURE_COLUMNS), ["payment_id"], nulls_match
    ).select(*cleaned.columns, *FEATURE_COLUMNS)


def short_silver(silver: DataFrame) -> DataFrame:
    """The 17-column variant."""
    return silver.select(*SHORT_SILVER_COLUMNS)
