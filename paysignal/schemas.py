"""Declared schemas and column orders of every layer (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("payment_id", T.StringType()),
        T.StructField("payment_group_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("attempt_number", T.IntegerType()),
        T.StructField("scenario", T.StringType()),
    ]
)

# The short event variant has neither grouping, attempt nor scenario.
EXTENDED_ONLY = ("payment_group_id", "attempt_number", "scenario")
SHORT_EVENT_SCHEMA = T.StructType([f for f in EVENT_SCHEMA if f.name not in EXTENDED_ONLY])

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()
SHORT_EVENT_COLUMNS = SHORT_EVENT_SCHEMA.fieldNames()

INGESTION_FIELD = T.StructField("ingestion_ts", T.TimestampType())
BRONZE_SCHEMA = T.StructType([*EVENT_SCHEMA, INGESTION_FIELD])
SHORT_BRONZE_SCHEMA = T.StructType([*SHORT_EVENT_SCHEMA, INGESTION_FIELD])

FEATURE_COLUMNS = [
    "tx_by_card_5m",
    "distinct_merchants_10m",
    "distinct_countries_1h",
    "distinct_cards_per_device",
    "declined_ratio_1h",
]
SILVER_COLUMNS = [*EVENT_COLUMNS, "ingestion_ts", *FEATURE_COLUMNS]
SHORT_SILVER_COLUMNS = [*SHORT_EVENT_COLUMNS, *FEATURE_COLUMNS]

SCORE_COLUMNS = ["risk_score", "reasons", "reasons_text"]
ALERT_COLUMNS = [
    "payment_id", "event_time", "customer_id", "card_id", "merchant_id", "device_id",
    "country", "amount", "currency", "status", *FEATURE_COLUMNS, *SCORE_COLUMNS,
]
# The wider alert variant carries the merchant category as well.
ALERT_COLUMNS_WITH_MCC = [
    "payment_id", "event_time", "customer_id", "card_id", "merchant_id", "device_id",
    "country", "amount", "currency", "status", "mcc", *FEATURE_COLUMNS, *SCORE_COLUMNS,
]
GRAPH_PAYMENT_COLUMNS = [
    "payment_id", "payment_group_id", "event_time", "customer_id", "card_id", "merchant_id",
    "device_id", "ip", "country", "amount", "currency", "status", "mcc", "scenario",
    *SCORE_COLUMNS, "is_alert",
]
RELATION_COLUMNS = [
    "payment_id", "event_time", "customer_id", "card_id", "merchant_id", "device_id", "ip",
    "country", "amount", "currency", "status", "mcc", *FEATURE_COLUMNS, *SCORE_COLUMNS, "is_alert",
]

CANONICAL_COLUMNS = [
    "payment_id", "card_id", "amount", "event_time", "country", "status", "risk_score",
    "tx_5m", "merchants_10m", "countries_1h", "source",
]
CONSOLIDATED_COLUMNS = [
    *CANONICAL_COLUMNS[:-1], "source_s3", "source_rds", "event_date",
]
