"""Number formatting and the feature text of the training set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even_2(column: Column) -> Column:
    """Two decimals, halves to even on the scaled value."""
    return F.rint(column * 100) / 100


def plain_decimal(column: Column) -> Column:
    """Text of a double rounded to two decimals, without an exponent below 1e16:
    ``12.5``, ``100.0``, ``12345678.25``."""
    rounded = round_half_even_2(column)
    fixed = F.regexp_replace(F.format_string("%.2f", rounded), "0$", "")
    return F.when(F.abs(rounded) < 1e7, rounded.cast("string")).otherwise(fixed)


def feature_text() -> Column:
    """One line per payment, ``name=value`` fields joined by `` | ``."""
    fields = {
        "amount": plain_decimal(F.col("amount")),
        "card": F.col("card_id"),
        "country": F.col("country"),
        "status": F.col("status"),
        "risk_score": plain_decimal(F.col("risk_score")),
        "tx_5m": F.col("tx_5m").cast("long").cast("string"),
        "merchants_10m": F.col("merchants_10m").cast("long").cast("string"),
        "countries_1h": F.col("countries_1h").cast("long").cast("string"),
    }
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}="), v) for k, v in fields.items()])
