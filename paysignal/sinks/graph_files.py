"""Snapshot files of the payment graph: nine CSV folders with headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.plans.graph import EDGE_TYPES, NODE_KEYS, Graph, resolve_edges

# File name per edge table, and columns per node file.
EDGE_FILES = {
    "owns_card": "rel_customer_card",
    "used_on": "rel_card_device",
    "authorized": "rel_card_payment",
    "at_merchant": "rel_payment_merchant",
}
NODE_COLUMNS = {
    "customers": ["customer_id"],
    "cards": ["card_id"],
    "devices": ["device_id"],
    "merchants": ["merchant_id", "country", "mcc"],
    "payments": [
        "payment_id", "payment_group_id", "event_time", "amount", "currency", "status", "country",
        "risk_score", "reasons", "is_alert", "ip", "graph_name",
    ],
}
_CSV = {"header": True, "escape": '"', "multiLine": True}


_NODE_TYPES = {"amount": "double", "risk_score": "int", "is_alert": "boolean"}


def empty_graph(spark: SparkSession) -> Graph:
    """No rows, with the columns that ``read_graph`` gives."""
    nodes = {
        label: spark.createDataFrame([], ", ".join(f"{c} {_NODE_TYPES.get(c, 'string')}" for c in columns))
        for label, columns in NODE_COLUMNS.items()
    }
    return Graph(nodes, {name: spark.createDataFrame([], f"{s} string, {t} string") for name, _, s, _, t in EDGE_TYPES})


def write_graph(graph: Graph, root: str, mode: str = "overwrite") -> None:
    """Values may hold line breaks. Booleans are written as ``True`` / ``False``."""
    for label, columns in NODE_COLUMNS.items():
        table = graph.nodes[label].select(*columns)
        if "is_alert" in columns:
            table = table.withColumn("is_alert", F.when(F.col("is_alert"), "True").otherwise("False"))
        table.write.mode(mode).options(**_CSV).csv(f"{root}/{label}")
    for name, file_name in EDGE_FILES.items():
        graph.edges[name].write.mode(mode).options(**_CSV).csv(f"{root}/{file_name}")


def _scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Text columns taken by their names in the header, in whatever order the files hold them."""
    return spark.read.options(**_CSV).csv(path).select(*columns)


def _one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per non-null key, the greatest by the remaining columns in their order."""
    known = rows.filter(F.col(key).isNotNull())
    rest = [c for c in rows.columns if c != key]
    if not rest:
        return known.distinct()
    return known.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(*rows.columns)


def read_graph(spark: SparkSession, root: str) -> Graph:
    """Typed node tables, one row per key, and distinct edges with both endpoints present."""
    nodes = {label: _scan(spark, f"{root}/{label}", columns) for label, columns in NODE_COLUMNS.items()}
    nodes["payments"] = nodes["payments"].withColumns(
        {
            "amount": F.col("amount").try_cast("double"),
            "risk_score": F.col("risk_score").try_cast("int"),
            "is_alert": F.coalesce(F.col("is_alert") == "True", F.lit(False)),
            "payment_group_id": F.coalesce("payment_group_id", F.lit("")),
            "reasons": F.coalesce("reasons", F.lit("")),
        }
    )
    nodes = {label: _one_per_key(rows, NODE_KEYS[label]) for label, rows in nodes.items()}
    edges = {
        name: _scan(spark, f"{root}/{EDGE_FILES[name]}", [source, target]).distinct()
        for name, _, source, _, target in EDGE_TYPES
    }
    return Graph(nodes, resolve_edges(edges, nodes))
