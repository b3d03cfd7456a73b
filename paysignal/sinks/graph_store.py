"""The accumulated payment graph in files, loaded snapshot by snapshot.

Folders are written once and never changed. A manifest lists the folders of all nine tables; a load writes its
folders first and the next manifest last, so readers see all tables before or after a load, and a load that stops half-way
changes nothing. Payments and their edges are parted by snapshot, merchants by a hash of their key; cards, customers, devices
and their links only grow. So a load writes its own snapshot, what it takes over from others, the changed merchant parts and
the new keys; all other folders are carried over as they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.plans.graph import EDGE_TYPES, NODE_KEYS, Graph
from paysignal.session import stage

MERCHANT_PARTS = 16
BY_SNAPSHOT = ("payments", "authorized", "at_merchant")
KEYS = {**{label: (key,) for label, key in NODE_KEYS.items()}, **{n: (s, t) for n, _, s, _, t in EDGE_TYPES}}
_MANIFEST = "name string, part string, folder string"


@dataclass(frozen=True)
class Entry:
    """A folder with rows of table ``name``; ``part`` is the snapshot, or the hash part of merchants."""

    name: str
    part: str
    folder: str


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished manifests, rising."""
    store, place = _files(spark, f"{root}/manifests")
    if not store.exists(place):
        return []
    done = [f.getPath() for f in store.listStatus(place)]
    done = [p.getName() for p in done if store.exists(_files(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(n) for n in done)


def entries(spark: SparkSession, root: str, version: int | None = None) -> list[Entry]:
    """The folders of a version (the last unless given): a few per table, snapshot and load."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if not version:
        return []
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/{version}").collect()
    return sorted((Entry(**r.asDict()) for r in rows), key=lambda e: (e.name, e.part, e.folder))


def _schema(like: Graph, name: str) -> T.StructType:
    table = like.nodes[name] if name in like.nodes else like.edges[name]
    fields = [T.StructField(f.name, f.dataType) for f in table.schema]
    if name in BY_SNAPSHOT and "graph_name" not in table.columns:
        fields.append(T.StructField("graph_name", T.StringType()))
    return T.StructType(fields)


def _rows(spark: SparkSession, found: list[Entry], schema: T.StructType) -> DataFrame:
    folders = [e.folder for e in found]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_store(spark: SparkSession, root: str, like: Graph, version: int | None = None) -> Graph:
    """The stored graph, with the columns of ``like``."""
    found = entries(spark, root, version)

    def table(name: str, own: DataFrame) -> DataFrame:
        return _rows(spark, [e for e in found if e.name == name], _schema(like, name)).select(*own.columns)

    return Graph({n: table(n, df) for n, df in like.nodes.items()}, {n: table(n, df) for n, df in like.edges.items()})


def write_manifest(spark: SparkSession, root: str, version: int, found: list[Entry]) -> None:
    """The switch: fails if somebody else made this version."""
    rows = [(e.name, e.part, e.folder) for e in found]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifests/{version}")


def load(spark: SparkSession, root: str, new: Graph, graph_name: str) -> int:
    """Load snapshot ``graph_name`` as ``plans.graph.load_snapshot`` does; returns the number of the new version."""
    version = max(versions(spark, root), default=0)
    old = entries(spark, root, version)

    def stored(name: str, parts: set[str] | None = None) -> DataFrame:
        own = [e for e in old if e.name == name and (parts is None or e.part in parts)]
        return _rows(spark, own, _schema(new, name))

    def written(df: DataFrame, name: str, part: str) -> Entry:
        folder = f"{root}/data/{name}/{uuid.uuid4().hex}"
        df.select(*_schema(new, name).fieldNames()).write.parquet(folder)
        return Entry(name, part, folder)

    # payments that this snapshot takes over from others, and the parts that lose them
    others = {e.part for e in old if e.name == "payments"} - {graph_name}
    ids = new.nodes["payments"].select("payment_id")
    taken = stage(stored("payments", others).select("payment_id", "graph_name").join(ids, "payment_id", "left_semi"), "taken")
    touched = {r.graph_name for r in taken.select("graph_name").distinct().collect()}  # names of snapshots
    taken = taken.select("payment_id")
    result: list[Entry] = []
    for name in BY_SNAPSHOT:
        result += [e for e in old if e.name == name and e.part not in touched | {graph_name}]
        own = new.nodes[name] if name in new.nodes else new.edges[name].unionByName(
            stored(name, touched).join(taken, "payment_id", "left_semi").select(*new.edges[name].columns)).distinct()
        result.append(written(own.withColumn("graph_name", F.lit(graph_name)), name, graph_name))
        for part in sorted(touched):
            result.append(written(stored(name, {part}).join(taken, "payment_id", "left_anti"), name, part))

    for name in ("customers", "cards", "devices", "owns_card", "used_on"):
        own = new.nodes[name] if name in new.nodes else new.edges[name]
        keys = list(KEYS[name])
        added = stage(own.select(*keys).distinct().join(stored(name).select(*keys), keys, "left_anti"), "added")
        result += [e for e in old if e.name == name]
        if not added.isEmpty():
            result.append(written(added, name, ""))

    merchants = new.nodes["merchants"]
    part = F.pmod(F.xxhash64("merchant_id"), F.lit(MERCHANT_PARTS)).cast("string")
    changed = stage(merchants.subtract(stored("merchants").select(*merchants.columns)).withColumn("_part", part), "changed")
    changed_parts = {r._part for r in changed.select("_part").distinct().collect()}  # at most MERCHANT_PARTS
    result += [e for e in old if e.name == "merchants" and e.part not in changed_parts]
    for p in sorted(changed_parts):
        ahead = changed.filter(F.col("_part") == p).drop("_part")
        kept = stored("merchants", {p}).join(ahead.select("merchant_id"), "merchant_id", "left_anti")
        result.append(written(kept.select(*merchants.columns).unionByName(ahead), "merchants", p))

    write_manifest(spark, root, version + 1, result)
    return version + 1


def drop_old(spark: SparkSession, root: str, keep: int) -> int:
    """Remove all but the ``keep`` last versions, and the folders that no remaining one lists. Returns how many folders
    went. No load may run meanwhile, as its folders are not listed yet."""
    numbers = versions(spark, root)
    kept = numbers[-max(keep, 1) :]
    listed = {e.folder.rstrip("/").rpartition("/")[2] for v in kept for e in entries(spark, root, v)}
    for v in numbers[: -len(kept)] if kept else []:
        store, place = _files(spark, f"{root}/manifests/{v}")
        store.delete(place, True)
    gone = 0
    for name in KEYS:
        store, place = _files(spark, f"{root}/data/{name}")
        for found in store.listStatus(place) if store.exists(place) else []:
            if found.getPath().getName() not in listed:
                store.delete(found.getPath(), True)
                gone += 1
    return gone
