"""Payment messages derived from the ``events`` test table.

Event time is compressed so that trailing windows hold several rows; some
messages are repeated later and some carry a time that does not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.schemas import EVENT_COLUMNS

# Fixed values of the derivation.
EPOCH_START = 1704067200  # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 144
COUNTRIES = ("ES", "PT", "FR", "IT", "DE", "GB", "US", "MX")
CATEGORY_CODES = ("5411", "5732", "5812", "4111", "4900", "5999", "5651", "5942")


def _padded(prefix: str, number, width: int):
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def payments_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Bronze rows (event time still text) with an ingestion time.

    A Parquet file is read by as many tasks as it has row groups, often one. The narrow
    events are therefore spread before the payments are derived from them.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition("event_id")
    event_id, user_id = F.col("event_id"), F.col("user_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - EPOCH_START * 1_000_000
    base = events.select(
        "event_id", "user_id", "value", "event_type",
        F.from_json("props", "k int")["k"].alias("k"),
        (F.lit(EPOCH_START) + F.floor(micros / (TIME_COMPRESSION * 1_000_000))).alias("s"),
    ).withColumn(
        "country",
        F.get(
            F.array(*[F.lit(c) for c in COUNTRIES]),
            F.when(event_id % 5 != 0, user_id % 5).otherwise(event_id % 8).cast("int"),
        ),
    )
    country, k = F.col("country"), F.col("k")
    clock = F.concat(F.date_format(F.timestamp_seconds("s"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))

    def copy(condition, prefix: str, parses: bool, delay: int):
        made = F.array(F.struct(F.lit(prefix).alias("prefix"), F.lit(parses).alias("parses"), F.lit(delay).alias("delay")))
        return made if condition is None else F.when(condition, made).otherwise(F.slice(made, 1, 0))

    copies = F.concat(
        copy(None, "", True, 5),
        copy(event_id % 50 == 0, "", True, 65),
        copy(event_id % 97 == 0, "bad-", False, 5),
    )
    shared_device = F.when(event_id % 5 == 0, user_id % 20).otherwise(100 + F.floor(user_id / 3))
    return base.select("*", F.inline(copies)).select(
        F.when(F.col("parses"), clock).otherwise("not-a-date").alias("event_time"),
        F.concat("prefix", _padded("pay-", event_id, 12)).alias("payment_id"),
        _padded("grp-", F.floor(event_id / 2), 12).alias("payment_group_id"),
        _padded("cust-", F.floor(user_id / 2), 5).alias("customer_id"),
        _padded("card-", user_id, 5).alias("card_id"),
        _padded("merchant-", k + 1, 4).alias("merchant_id"),
        _padded("device-", shared_device, 5).alias("device_id"),
        F.concat_ws(".", F.lit("10"), user_id % 256, k, event_id % 254 + 1).alias("ip"),
        "country",
        (F.col("value") * 10).alias("amount"),
        F.when(country == "GB", "GBP").when(country == "US", "USD").when(country == "MX", "MXN")
        .otherwise("EUR").alias("currency"),
        F.when(F.col("event_type") == "error", "declined").otherwise("approved").alias("status"),
        F.get(F.array(*[F.lit(c) for c in CATEGORY_CODES]), k % 8).alias("mcc"),
        (1 + event_id % 2).cast("int").alias("attempt_number"),
        F.when(event_id % 5 == 0, "suspicious").when(event_id % 7 == 0, "retry").otherwise("normal")
        .alias("scenario"),
        F.timestamp_seconds(F.col("s") + F.col("delay")).alias("ingestion_ts"),
    )


def payment_message() -> Column:
    """A payment row as one raw JSON message."""
    return F.to_json(F.struct(*EVENT_COLUMNS))
