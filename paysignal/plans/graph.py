"""The payment graph as node and edge tables, and its investigation queries."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.functions.columns import in_periods, in_time_range, is_timestamp
from paysignal.operators.joins import attach_to_hubs, keep_known
from paysignal.operators.reach import members, reach_count
from paysignal.session import stage

# Staging columns with type and default (no default: required).
REQUIRED = ("payment_id", "event_time", "customer_id", "card_id", "merchant_id", "device_id")
STAGING_TYPES = {
    "payment_id": "string",
    "payment_group_id": "string",
    "event_time": "timestamp",
    "customer_id": "string",
    "card_id": "string",
    "merchant_id": "string",
    "device_id": "string",
    "ip": "string",
    "country": "string",
    "amount": "double",
    "currency": "string",
    "status": "string",
    "mcc": "string",
    "risk_score": "int",
    "reasons_text": "string",
    "is_alert": "boolean",
}
DEFAULTS = {"string": "", "double": 0.0, "int": 0, "boolean": False}

# Edge tables: (name, source label, source key, target label, target key).
EDGE_TYPES = (
    ("owns_card", "customers", "customer_id", "cards", "card_id"),
    ("used_on", "cards", "card_id", "devices", "device_id"),
    ("authorized", "cards", "card_id", "payments", "payment_id"),
    ("at_merchant", "payments", "payment_id", "merchants", "merchant_id"),
)
NODE_KEYS = {
    "customers": "customer_id",
    "cards": "card_id",
    "devices": "device_id",
    "merchants": "merchant_id",
    "payments": "payment_id",
}


@dataclass(frozen=True)
class Graph:
    """Node tables by label and edge tables by name."""

    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]


def staging(source: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """16 typed columns of an optional half-open time range.

    Missing required columns are an error, missing optional ones get a default.
    """
    missing = sorted(set(REQUIRED) - set(source.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")

    def column(name: str, type_name: str):
        if name not in source.columns:
            return F.lit(DEFAULTS[type_name]).cast(type_name)
        if name == "event_time" and not is_timestamp(source, name):
            return F.try_to_timestamp(name)
        return F.col(name).try_cast(type_name)

    rows = source
    if is_timestamp(source, "event_time") and (start or end):
        # filter the source column itself, so that the scan can skip row groups
        rows = source.filter(in_time_range(F.col("event_time"), start, end) & in_periods(source, start, end))
    typed = rows.select(*[column(n, t).alias(n) for n, t in STAGING_TYPES.items()])
    if not is_timestamp(source, "event_time") and (start or end):
        typed = typed.filter(in_time_range(F.col("event_time"), start, end))
    return typed


def _distinct_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys).dropna().distinct()


def nodes(rows: DataFrame, graph_name: str) -> dict[str, DataFrame]:
    """The five node tables of a staged snapshot, one row per key.

    Attributes of merchants and payments come from their latest row. All
    aggregates combine per map task, so a hub key stays one row per task.
    """
    merchants = (
        rows.filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.max(F.struct("event_time", "payment_id", "country", "mcc")).alias("last"))
        .select("merchant_id", "last.country", "last.mcc")
    )
    attributes = {
        "payment_group_id": F.coalesce("payment_group_id", F.lit("")),
        "event_time": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"),
        "amount": F.col("amount"),
        "currency": F.col("currency"),
        "status": F.col("status"),
        "country": F.col("country"),
        "risk_score": F.col("risk_score"),
        "reasons": F.coalesce("reasons_text", F.lit("")),
        "is_alert": F.coalesce("is_alert", F.lit(False)),
        "ip": F.col("ip"),
    }
    row = F.struct(F.col("event_time").alias("_at"), F.struct(*[c.alias(n) for n, c in attributes.items()]).alias("row"))
    payments = (
        rows.filter(F.col("payment_id").isNotNull())
        .groupBy("payment_id")
        .agg(F.max(row).alias("last"))
        .select("payment_id", "last.row.*", F.lit(graph_name).alias("graph_name"))
    )
    return {
        "customers": _distinct_keys(rows, "customer_id"),
        "cards": _distinct_keys(rows, "card_id"),
        "devices": _distinct_keys(rows, "device_id"),
        "merchants": merchants,
        "payments": payments,
    }


def edges(rows: DataFrame) -> dict[str, DataFrame]:
    """The four edge tables of a staged snapshot, distinct key pairs."""
    return {name: _distinct_keys(rows, source, target) for name, _, source, _, target in EDGE_TYPES}


def resolve_edges(edge_tables: dict[str, DataFrame], node_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Drop edges whose endpoints do not both exist."""
    resolved = {}
    for name, source_label, source, target_label, target in EDGE_TYPES:
        from_known = keep_known(edge_tables[name], node_tables[source_label], source)
        resolved[name] = keep_known(from_known, node_tables[target_label], target).select(source, target)
    return resolved


def snapshot(rows: DataFrame, graph_name: str) -> Graph:
    """Graph of one staged snapshot. Node and edge keys come from the same rows, so
    an edge without null ends has both endpoints; loaded files go through ``resolve_edges``."""
    return Graph(nodes(rows, graph_name), edges(rows))


def _replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def load_snapshot(store: Graph, new: Graph, graph_name: str) -> Graph:
    """The store after loading snapshot ``graph_name``.

    Its earlier payments and their edges go first. A payment id is unique over
    all snapshots: a loaded payment replaces any other of the same id, which
    keeps its edges. Everything else accumulates.
    """
    others = F.col("graph_name").isNull() | (F.col("graph_name") != graph_name)
    kept = store.nodes["payments"].filter(others)
    payments = _replace_by_key(kept, new.nodes["payments"], "payment_id")
    merged_nodes = {
        label: store.nodes[label].unionByName(new.nodes[label]).distinct()
        for label in ("customers", "cards", "devices")
    }
    merged_nodes["merchants"] = _replace_by_key(store.nodes["merchants"], new.nodes["merchants"], "merchant_id")
    merged_nodes["payments"] = payments
    kept_ids = kept.select("payment_id")
    merged_edges = {}
    for name, _, source, _, target in EDGE_TYPES:
        old = store.edges[name]
        if "payment_id" in (source, target):
            old = old.join(kept_ids, "payment_id", "left_semi").select(source, target)
        merged_edges[name] = old.unionByName(new.edges[name].select(source, target)).distinct()
    return Graph(merged_nodes, merged_edges)


def export_counts(rows: DataFrame) -> DataFrame:
    """Rows and distinct nodes of a staged snapshot: ``dataset``, ``total``."""
    names = ["rows", *NODE_KEYS]
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_distinct(key).alias(label) for label, key in NODE_KEYS.items()],
    )
    return counts.unpivot([], names, "dataset", "total")


def key_violations(graph: Graph) -> DataFrame:
    """Node keys that occur more than once (must be empty): ``label``, ``id``, ``copies``."""
    found = [
        graph.nodes[label]
        .groupBy(F.col(key).alias("id"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select(F.lit(label).alias("label"), "id", "copies")
        for label, key in NODE_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, found)


# --- investigation queries ---------------------------------------------------


def _payments_of(graph: Graph, graph_name: str | None) -> DataFrame:
    payments = graph.nodes["payments"]
    return payments if graph_name is None else payments.filter(F.col("graph_name") == graph_name)


def _alert_cards(graph: Graph, graph_name: str | None) -> DataFrame:
    """(card_id, payment_id) of alert payments."""
    alerts = _payments_of(graph, graph_name).filter("is_alert").select("payment_id")
    return graph.edges["authorized"].join(alerts, "payment_id", "left_semi")


def shared_devices(graph: Graph, graph_name: str | None = None, min_cards: int = 3) -> DataFrame:
    """Devices used by several cards, one row per card. With a snapshot name, only cards that
    have a payment in it count; their device links may come from any snapshot."""
    used = graph.edges["used_on"]
    if graph_name is not None:
        seen = (
            graph.edges["authorized"]
            .join(_payments_of(graph, graph_name).select("payment_id"), "payment_id", "left_semi")
            .select("card_id")
            .distinct()
        )
        used = keep_known(used, seen, "card_id")
    return members(used, "device_id", "card_id", "total_cards", min_cards).orderBy(
        F.desc("total_cards"), "device_id", "card_id"
    )


def multi_country_cards(graph: Graph, graph_name: str | None = None, min_countries: int = 3) -> DataFrame:
    """Cards with payments in several countries, one row per country."""
    payments = _payments_of(graph, graph_name).select("payment_id", "country").dropna()
    pairs = graph.edges["authorized"].join(payments, "payment_id").select("card_id", "country").distinct()
    return members(pairs, "card_id", "country", "total_countries", min_countries).orderBy(
        F.desc("total_countries"), "card_id", "country"
    )


def risky_merchants(graph: Graph, graph_name: str | None = None, min_customers: int = 2,
                    min_cards: int = 3) -> DataFrame:
    """Merchants reached by alert payments of several customers or cards.

    Starts from the alert payments, the most selective step, and reduces to
    distinct (merchant, card) pairs before owners are looked at.
    """
    owners = graph.edges["owns_card"]
    reached = (
        _alert_cards(graph, graph_name)
        .join(graph.edges["at_merchant"], "payment_id")
        .select("merchant_id", "card_id")
        .distinct()
    )
    links = stage(keep_known(reached, owners.select("card_id").distinct(), "card_id"), "merchant_cards")
    cards = links.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("suspicious_cards"))
    customers = reach_count(links, owners, "merchant_id", "card_id", "customer_id", "suspicious_customers")
    return (
        customers.join(cards, "merchant_id")
        .filter((F.col("suspicious_customers") >= min_customers) | (F.col("suspicious_cards") >= min_cards))
        .select("merchant_id", "suspicious_customers", "suspicious_cards")
        .orderBy(F.desc("suspicious_customers"), F.desc("suspicious_cards"), "merchant_id")
    )


def device_clusters(graph: Graph, graph_name: str | None = None) -> DataFrame:
    """Devices shared by cards: one row per card on them that has alert payments,
    with the number of alert payments of all these cards.

    On a device with two or more cards every card has another one next to it, so
    pairing cards is not needed.
    """
    used = graph.edges["used_on"]
    shared = used.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 2").select("device_id")
    alert_cards = stage(_alert_cards(graph, graph_name), "alert_cards")
    links = keep_known(used, alert_cards.select("card_id").distinct(), "card_id")
    links = stage(keep_known(links, shared, "device_id").select("device_id", "card_id"), "device_cards")
    payments = reach_count(links, alert_cards, "device_id", "card_id", "payment_id", "alert_payments")
    return (
        attach_to_hubs(links, payments, "device_id")
        .select("device_id", "card_id", "alert_payments")
        .orderBy(F.desc("alert_payments"), "device_id", "card_id")
    )
