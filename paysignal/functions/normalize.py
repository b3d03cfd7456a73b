"""Normalisers for country, status and event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.functions.columns import is_timestamp, pick

# Country names and codes accepted per ISO-2 code (accents folded).
COUNTRY_SYNONYMS = {
    "ES": ("es", "espana", "spain"),
    "PT": ("pt", "portugal"),
    "FR": ("fr", "france"),
    "IT": ("it", "italy", "italia"),
    "DE": ("de", "germany", "alemania"),
    "GB": ("gb", "uk", "united kingdom", "reino unido"),
    "US": ("us", "usa", "united states", "estados unidos"),
    "MX": ("mx", "mexico"),
}
# Spellings of the two known payment outcomes.
STATUS_SYNONYMS = {
    "approved": ("approved", "approve", "ok", "success"),
    "declined": ("declined", "deny", "denied", "rejected", "fail", "failed"),
}
# Event-time column names, in order of preference.
EVENT_TIME_NAMES = ("event_time", "event_ts", "timestamp")
EVENT_TIME_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss")

# The documented intent is that accented spellings match too, so the tilde is
# folded along with the acute accents.
ACCENTED, PLAIN = "áéíóúñ", "aeioun"


def _map_synonyms(key: Column, synonyms: dict[str, tuple[str, ...]], otherwise: Column) -> Column:
    mapped = None
    for value, spellings in synonyms.items():
        hit = key.isin(*spellings)
        mapped = F.when(hit, value) if mapped is None else mapped.when(hit, value)
    return mapped.otherwise(otherwise)


def country_code(column: Column) -> Column:
    text = F.trim(column.cast("string"))
    folded = F.translate(F.lower(text), ACCENTED, PLAIN)
    return _map_synonyms(folded, COUNTRY_SYNONYMS, F.upper(text))


def payment_status(column: Column) -> Column:
    text = F.lower(F.trim(column.cast("string")))
    return _map_synonyms(text, STATUS_SYNONYMS, text)


def event_time(df: DataFrame) -> Column:
    """Timestamp from the first known time column; text goes through several
    parse attempts and the first success counts."""
    for name in EVENT_TIME_NAMES:
        if name in df.columns and is_timestamp(df, name):
            return F.col(name).cast("timestamp")
        if name in df.columns:
            break
    text = pick(df, EVENT_TIME_NAMES)
    spaced = F.translate(F.replace(text, F.lit("T"), F.lit(" ")), "Z", "")
    attempts = [F.try_to_timestamp(text), F.try_to_timestamp(spaced)]
    attempts += [F.try_to_timestamp(text, F.lit(p)) for p in EVENT_TIME_PATTERNS]
    return F.coalesce(*attempts)
