"""Tables by day, streams that may deliver twice, and the graph store: which files are read, kept and rewritten."""

from __future__ import annotations

import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from paysignal import jobs, schemas
from paysignal.plans import graph
from paysignal.sinks import files, graph_files, graph_store, tables
from paysignal.streaming import ingest
from tests.conftest import at

DAY = 86400
EVENT = {"event_time": "2024-01-01T00:00:00+00:00", "payment_id": "p1", "card_id": "c1", "amount": 2.5, "attempt_number": 1}


def name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def files_read(df) -> set[str]:
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def pruned(df) -> str:
    plan = df._jdf.queryExecution().toString()
    return max(re.findall(r"PartitionFilters: \[[^\]]*\]", plan), key=len)


@pytest.fixture
def days(spark):
    rows = [(f"p{i}", at(i * DAY // 4), i) for i in range(40)] + [("none", None, 40)]
    return spark.createDataFrame(rows, "payment_id string, event_time timestamp, n int")


def test_a_range_reads_the_files_of_its_days(spark, days):
    table = name("dated")
    stored = tables.replace_by_period(days, table)
    assert stored.columns == ["payment_id", "event_time", "n", "event_date"] and stored.count() == 41
    picked = files.select_export(stored, start="2024-01-03T06:00:00Z", end="2024-01-04T00:00:00Z")
    assert picked.columns == days.columns
    assert sorted(r.n for r in picked.collect()) == [9, 10, 11]
    assert "event_date" in pruned(picked)
    inside = stored.filter("event_date between '2024-01-03' and '2024-01-04'")
    assert len(files_read(picked)) <= len(files_read(inside)) < len(files_read(stored)) == 11
    staged = graph.staging(
        stored.select("*", *[F.lit("x").alias(c) for c in graph.REQUIRED if c not in ("payment_id", "event_time")]), "2024-01-05T00:00:00Z")
    assert "event_date" in pruned(staged) and staged.count() == 24
    # sorted within its files
    for path in files_read(stored):
        times = [r.event_time for r in spark.read.parquet(path).collect()]
        assert times == sorted(times, key=str)


def test_only_the_days_given_are_overwritten(spark, days):
    table = name("dated")
    stored = tables.replace_by_period(days, table)
    before = files_read(stored)
    changed = stored.filter("event_date = '2024-01-02'").withColumn("n", F.col("n") + 100)
    after = tables.overwrite_periods(changed, table)
    assert len(before - files_read(after)) == 1 and len(before & files_read(after)) == 10
    expected = [i + 100 if 4 <= i < 8 else i for i in range(41)]
    assert sorted(r.n for r in after.collect()) == sorted(expected)


def test_old_versions_go_and_readers_of_kept_ones_stay(spark, days):
    table = name("kept")
    for k in range(4):
        tables.replace_by_period(days.filter(F.col("n") > k), table, keep_versions=2 if k == 3 else 0)
        if k == 2:
            reader = spark.read.parquet(tables.table_location(spark, table))
    assert reader.count() == 38 and spark.table(table).count() == 37
    assert tables.drop_versions(spark, table, 1) == 1 and tables.drop_versions(spark, table, 0) == 0
    assert spark.table(table).count() == 37
    # from dated to plain and back
    assert tables.replace_table(days, table).columns == days.columns
    assert tables.replace_by_period(days, table, unit="hour").columns[-1] == "event_hour"
    assert spark.table(table).count() == 41


def test_tables_by_day_are_compacted(spark, days):
    table = name("scattered")
    tables.replace_by_period(days, table)
    location = tables.table_location(spark, table)
    spark.table(table).repartition(6).write.mode("overwrite").partitionBy("event_date").parquet(location)
    spark.catalog.refreshTable(table)
    before = len(files_read(spark.table(table)))
    assert before > 25 and tables.compact_table(spark, table)
    assert len(files_read(spark.table(table))) == 11 and spark.table(table).count() == 41
    assert "event_date" in pruned(spark.table(table).filter("event_date = '2024-01-03'"))


def drop(folder, *messages):
    folder.mkdir(exist_ok=True)
    (folder / f"{uuid.uuid4().hex}.txt").write_text("\n".join(messages) + "\n")


def test_a_batch_delivered_twice_is_stored_once(spark, tmp_path):
    table, inbox, checkpoint = name("bronze"), tmp_path / "in", str(tmp_path / "cp")
    parts = ("event_date", tables.BATCH_COLUMN)
    tables.ensure_table(spark, table, ingest.by_day_schema(schemas.BRONZE_SCHEMA), str(tmp_path / "t"), partition_by=parts)

    def run() -> list[str]:
        stream = ingest.message_stream(spark, "text", path=str(inbox), max_per_trigger=1)
        query = ingest.start_ingest_by_day(ingest.bronze_rows(stream), table, checkpoint, drain=True, query_name=name("q"))
        ingest.supervise(query)
        return sorted(r.payment_id for r in spark.table(table).collect())

    drop(inbox, json.dumps(EVENT), json.dumps({**EVENT, "payment_id": "p2", "event_time": "2024-01-02T01:00:00+00:00"}), "{bad")
    drop(inbox, json.dumps({**EVENT, "payment_id": "p3", "event_time": "soon"}))
    assert run() == ["p1", "p2", "p3"] == run()
    found = {r.payment_id: (str(r.event_date), r.ingest_batch) for r in spark.table(table).collect()}
    assert found["p2"][0] == "2024-01-02" and found["p3"][0] == "None" and {b for _, b in found.values()} == {0, 1}
    last = tables.stage(spark.table(table).filter("ingest_batch = 1").drop(*parts), "last")
    ingest.append_batch(last, 1, table)
    assert spark.table(table).count() == 3
    # the next batch goes to where compaction has moved the table; only the last batch keeps its number
    assert tables.compact_table(spark, table) and str(tmp_path / "t") not in tables.table_location(spark, table)
    assert {r.ingest_batch for r in spark.table(table).collect()} == {-1, 1}
    ingest.append_batch(last, 1, table)
    drop(inbox, json.dumps({**EVENT, "payment_id": "p4"}))
    assert run() == ["p1", "p2", "p3", "p4"]


def test_progress_of_batches(spark, tmp_path):
    table, inbox = name("bronze"), tmp_path / "in"
    tables.ensure_table(spark, table, schemas.BRONZE_SCHEMA, str(tmp_path / "t"))
    for k in range(3):
        drop(inbox, *[json.dumps({**EVENT, "payment_id": f"p{k}{i}"}) for i in range(k + 1)])
    stream = ingest.message_stream(spark, "text", path=str(inbox), max_per_trigger=1)
    query = ingest.start_ingest(ingest.bronze_rows(stream), table, str(tmp_path / "cp"), drain=True, query_name=name("q"))
    ingest.supervise(query)
    assert sorted(ingest.batch_sizes(query).values()) == [1, 2, 3]


def test_gold_job_by_day(spark, bronze):
    source, alerts, relations = name("silver"), name("alerts"), name("relations")
    from paysignal.plans import silver

    rows = bronze([{"second": i * 30000, "amount": 9000.0, "status": "declined"} for i in range(20)])
    tables.replace_table(silver.features(silver.clean(rows)), source)
    for _ in range(3):
        jobs.main(["gold", "--source", source, "--alerts", alerts, "--relations", relations, "--by-day", "--keep-versions", "1"])
    assert spark.table(relations).count() == 20 and tables.partition_columns(spark, relations) == ("event_date",)
    assert tables.drop_versions(spark, relations, 1) == 0


# --- graph store --------------------------------------------------------------


def snapshot(spark, graph_name: str, payments: list[tuple], merchants: dict[str, str] | None = None) -> graph.Graph:
    """From (payment, customer, card, device, merchant)."""
    schema = "payment_id string, customer_id string, card_id string, device_id string, merchant_id string"
    rows = spark.createDataFrame(payments, schema)
    nodes = {label: rows.select(key).distinct() for label, key in graph.NODE_KEYS.items()}
    countries = F.create_map(*[F.lit(x) for pair in (merchants or {"-": "-"}).items() for x in pair])
    nodes["merchants"] = nodes["merchants"].select("merchant_id", countries["merchant_id"].alias("country"), F.lit("1").alias("mcc"))
    columns = [f for f in graph_files.empty_graph(spark).nodes["payments"].schema]
    nodes["payments"] = nodes["payments"].select(
        *[F.col("payment_id") if f.name == "payment_id" else F.lit(graph_name if f.name == "graph_name" else None).cast(f.dataType).alias(f.name)
          for f in columns])
    edges = {n: rows.select(s, t).distinct() for n, _, s, _, t in graph.EDGE_TYPES}
    return graph.Graph(nodes, edges)


def content(found: graph.Graph) -> dict:
    return {n: sorted(map(str, df.collect())) for n, df in {**found.nodes, **found.edges}.items()}


LOADS = [
    ("a", [("p1", "u1", "c1", "d1", "m1"), ("p2", "u1", "c1", "d1", "m2"), ("p3", "u2", "c2", "d1", "m1")], {"m1": "ES", "m2": "FR"}),
    ("b", [("p3", "u2", "c2", "d2", "m3"), ("p4", "u3", "c3", "d2", "m2")], {"m2": "DE", "m3": "IT"}),
    ("c", [("p5", "u3", "c3", "d2", "m3")], {"m3": "IT"}),
    ("a", [("p1", "u1", "c1", "d1", "m1")], {"m1": "ES"}),
    ("c", [], None),
]


def test_store_holds_what_the_tables_hold(spark, tmp_path):
    root = str(tmp_path / "store")
    expected = graph_files.empty_graph(spark)
    assert content(graph_store.read_store(spark, root, expected)) == content(expected)
    for i, (graph_name, payments, merchants) in enumerate(LOADS):
        new = snapshot(spark, graph_name, payments, merchants)
        expected = graph.load_snapshot(expected, new, graph_name)
        assert graph_store.load(spark, root, new, graph_name) == i + 1
        assert content(graph_store.read_store(spark, root, new)) == content(expected)
    assert graph_store.versions(spark, root) == [1, 2, 3, 4, 5]


def test_untouched_parts_keep_their_folders(spark, tmp_path):
    root = str(tmp_path / "store")
    for graph_name, payments, merchants in LOADS[:2]:
        graph_store.load(spark, root, snapshot(spark, graph_name, payments, merchants), graph_name)
    before = graph_store.entries(spark, root)
    graph_store.load(spark, root, snapshot(spark, *LOADS[2]), "c")
    after = graph_store.entries(spark, root)
    # nothing is taken over, and every merchant, customer, card and device is known already: only the own parts are new
    assert set(before) <= set(after) and {(e.name, e.part) for e in set(after) - set(before)} == {(n, "c") for n in graph_store.BY_SNAPSHOT}
    # one taken payment touches the two snapshots, and no third
    graph_store.load(spark, root, snapshot(spark, "d", [("p4", "u3", "c3", "d2", "m2")], {"m2": "DE"}), "d")
    last = graph_store.entries(spark, root)
    assert {(e.name, e.part) for e in set(last) - set(after)} == {(n, p) for n in graph_store.BY_SNAPSHOT for p in "bd"}


def test_a_load_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    graph_store.load(spark, root, snapshot(spark, *LOADS[0]), "a")
    like = graph_files.empty_graph(spark)
    before = content(graph_store.read_store(spark, root, like))

    def broken(*_):
        raise OSError("stopped")

    monkeypatch.setattr(graph_store, "write_manifest", broken)  # all folders are written, the switch is not
    with pytest.raises(OSError):
        graph_store.load(spark, root, snapshot(spark, *LOADS[1]), "b")
    monkeypatch.undo()
    assert content(graph_store.read_store(spark, root, like)) == before
    graph_store.load(spark, root, snapshot(spark, *LOADS[1]), "b")
    assert content(graph_store.read_store(spark, root, like, version=1)) == before
    with pytest.raises(Exception, match="exist"):
        graph_store.write_manifest(spark, root, 2, [])  # somebody else was first
    assert graph_store.drop_old(spark, root, 1) > 0 and graph_store.versions(spark, root) == [2]
    expected = graph.load_snapshot(graph.load_snapshot(like, snapshot(spark, *LOADS[0]), "a"), snapshot(spark, *LOADS[1]), "b")
    assert content(graph_store.read_store(spark, root, like)) == content(expected)


def test_store_through_the_jobs(spark, tmp_path):
    out, root = str(tmp_path / "files"), str(tmp_path / "store")
    for graph_name, payments, merchants in LOADS[:2]:
        graph_files.write_graph(snapshot(spark, graph_name, payments, merchants), f"{out}/{graph_name}")
        jobs.main(["load-graph", "--input", out, "--graph-name", graph_name, "--store", root, "--keep-versions", "1"])
    jobs.main(["investigate", "--store", root, "--output", str(tmp_path / "found")])
    assert graph_store.versions(spark, root) == [2]
    assert spark.read.parquet(str(tmp_path / "found" / "shared_devices")).count() == 0
