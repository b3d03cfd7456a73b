"""Silver to Gold: explainable risk score, alerts and the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.functions.rules import DEFAULT_RULES, Rule, reasons, risk_score
from paysignal.schemas import ALERT_COLUMNS, ALERT_COLUMNS_WITH_MCC, GRAPH_PAYMENT_COLUMNS, RELATION_COLUMNS


def score(silver: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Silver plus ``reasons``, ``risk_score``, ``reasons_text`` and ``is_alert``."""
    return (
        silver.withColumns({"reasons": reasons(rules), "risk_score": risk_score(rules)})
        .withColumns({"reasons_text": F.concat_ws(", ", "reasons"), "is_alert": F.size("reasons") > 0})
    )


def alerts(scored: DataFrame, with_mcc: bool = False) -> DataFrame:
    columns = ALERT_COLUMNS_WITH_MCC if with_mcc else ALERT_COLUMNS
    return scored.filter("is_alert").select(*columns)


def graph_payments(scored: DataFrame) -> DataFrame:
    return scored.select(*GRAPH_PAYMENT_COLUMNS)


def payment_relations(scored: DataFrame) -> DataFrame:
    return scored.select(*RELATION_COLUMNS)
