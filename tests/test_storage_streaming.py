from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from paysignal import schemas
from paysignal.sinks import files, tables
from paysignal.sources import jdbc
from paysignal.sources.files import read_bounded, read_table_or_path
from paysignal.streaming import ingest
from tests.conftest import at

EVENT = {"event_time": "2024-01-01T00:00:00+00:00", "payment_id": "p1", "card_id": "c1", "amount": 2.5, "attempt_number": 1}


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


def drop(folder, *messages):
    folder.mkdir(exist_ok=True)
    (folder / f"{uuid.uuid4().hex}.txt").write_text("\n".join(messages) + "\n")


def test_corrupt_and_wrongly_typed_messages(spark):
    wrong = json.dumps({**EVENT, "payment_id": "p2", "amount": "much"})
    raw = spark.createDataFrame([(json.dumps(EVENT),), ("{bad json",), (wrong,), (json.dumps({"card_id": "c"}),)], "value string")
    strict = {r.payment_id: r for r in ingest.parse_messages(raw).collect()}
    assert set(strict) == {"p1", "p2"} and strict["p2"].amount is None and strict["p2"].card_id == "c1"
    lenient = ingest.parse_messages(raw, strict=False).collect()
    assert len(lenient) == 4 and any(all(v is None for v in r) for r in lenient)
    assert ingest.parse_messages(raw, schemas.SHORT_EVENT_SCHEMA).columns == schemas.SHORT_EVENT_COLUMNS
    binary = raw.select(F.col("value").cast("binary").alias("value"))
    assert ingest.parse_messages(binary).count() == 2


def test_drain_stop_and_resume(spark, tmp_path):
    table, inbox, checkpoint = name("bronze"), tmp_path / "in", str(tmp_path / "cp")
    tables.ensure_table(spark, table, schemas.BRONZE_SCHEMA, str(tmp_path / "table"))
    tables.ensure_table(spark, table, schemas.BRONZE_SCHEMA, str(tmp_path / "table"))  # no effect

    def run():
        stream = ingest.message_stream(spark, "text", path=str(inbox), max_per_trigger=1)
        query = ingest.start_ingest(ingest.bronze_rows(stream), table, checkpoint, drain=True, query_name=name("q"))
        ingest.supervise(query)
        return sorted(r.payment_id for r in spark.table(table).collect())

    drop(inbox, json.dumps(EVENT), "{bad")
    drop(inbox, json.dumps({**EVENT, "payment_id": "p2"}))
    assert run() == ["p1", "p2"]
    assert run() == ["p1", "p2"]
    drop(inbox, json.dumps({**EVENT, "payment_id": "p3"}))
    assert run() == ["p1", "p2", "p3"]
    assert spark.table(table).filter("ingestion_ts is null").count() == 0
    assert tables.compact_table(spark, table) is False  # its stream may run again


def test_micro_batches_until_a_timeout(spark, tmp_path):
    table, inbox = name("bronze"), tmp_path / "in"
    tables.ensure_table(spark, table, schemas.BRONZE_SCHEMA, str(tmp_path / "table"))
    drop(inbox, json.dumps(EVENT))
    rows = ingest.bronze_rows(ingest.message_stream(spark, "text", path=str(inbox)))
    query = ingest.start_ingest(rows, table, str(tmp_path / "cp"), interval_seconds=1, query_name=name("q"))
    ingest.supervise(query, timeout_seconds=6)
    assert not query.isActive and spark.table(table).count() == 1


def test_a_failing_query_raises(spark, tmp_path):
    table, inbox = name("bronze"), tmp_path / "in"
    tables.ensure_table(spark, table, schemas.BRONZE_SCHEMA, str(tmp_path / "table"))
    drop(inbox, json.dumps(EVENT))
    stream = ingest.message_stream(spark, "text", path=str(inbox))
    broken = ingest.bronze_rows(stream).withColumn("ip", F.raise_error(F.lit("no")).cast("string"))
    query = ingest.start_ingest(broken, table, str(tmp_path / "cp"), drain=True, query_name=name("q"))
    with pytest.raises(Exception, match="no"):
        ingest.supervise(query)


def test_stream_options(spark):
    with pytest.raises(ValueError):
        ingest.message_stream(spark, "text", path="/tmp", starting_offsets="latest")
    with pytest.raises(ValueError):
        ingest.message_stream(spark, "text", path="/tmp", starting_offsets="middle")


def test_replace_reads_the_table_it_replaces(spark):
    table = name("t")
    tables.replace_table(spark.range(10), table)
    tables.replace_table(spark.table(table).filter("id < 4"), table)
    assert spark.table(table).count() == 4
    tables.replace_table(spark.table(table).withColumn("extra", F.lit("x")), table)
    assert spark.table(table).columns == ["id", "extra"] and spark.table(table).count() == 4


def test_table_as_select(spark, tmp_path):
    table = name("t")
    tables.table_as_select(spark.range(3), table, str(tmp_path / "t"))
    assert spark.table(table).count() == 3 and spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert read_table_or_path(spark, table).count() == read_table_or_path(spark, str(tmp_path / "t")).count()


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    source = str(tmp_path / "many")
    spark.range(1000).repartition(20).write.parquet(source)
    merged = tables.compact_folder(spark, source, str(tmp_path / "few"))
    assert tables.file_sizes(spark, source).count() == 20
    assert tables.file_sizes(spark, str(tmp_path / "few")).count() == 1
    assert merged.agg(F.sum("id")).head()[0] == 499500 and merged.count() == 1000
    # a smaller target gives several files
    total = tables.file_sizes(spark, source).agg(F.sum("length")).head()[0]
    tables.compact_folder(spark, source, str(tmp_path / "some"), file_bytes=total // 4)
    assert 3 <= tables.file_sizes(spark, str(tmp_path / "some")).count() <= 8


def test_compaction_by_partition_and_of_tables(spark, tmp_path):
    source = str(tmp_path / "dated")
    df = spark.range(100).select("id", (F.col("id") % 3).alias("day"))
    df.repartition(10).write.partitionBy("day").parquet(source)
    merged = tables.compact_folder(spark, source, str(tmp_path / "out"), partition_by=("day",))
    assert sorted(map(tuple, merged.select("id", "day").collect())) == sorted(map(tuple, df.collect()))
    assert tables.file_sizes(spark, str(tmp_path / "out")).count() == 3
    table = name("t")
    tables.replace_table(spark.range(100).repartition(10), table)
    assert tables.compact_table(spark, table) and spark.table(table).count() == 100
    assert tables.compact_table(spark, "no_such_table") is False
    dated = name("t")
    df.write.partitionBy("day").option("path", str(tmp_path / "t")).saveAsTable(dated)
    assert tables.compact_table(spark, dated) is False and spark.table(dated).count() == 100


def test_export_by_day(spark, tmp_path):
    df = spark.createDataFrame([("a", at(0), 1.5), ("b", at(90000), 2.5), ("c", None, 3.5)], "payment_id string, event_time timestamp, amount double")
    files.export_by_day(df, str(tmp_path / "json"))
    assert (tmp_path / "json" / "year=2024" / "month=01" / "day=02").is_dir()
    assert {r.payment_id: r.amount for r in spark.read.json(str(tmp_path / "json")).collect()} == {"a": 1.5, "b": 2.5}
    text = spark.createDataFrame([("a", "2024-01-05 10:00:00.123456 UTC"), ("b", "2024-01-06T01:02:03Z"), ("c", "soon"), ("d", "")],
                                 "payment_id string, event_time string")
    files.export_by_day(text, str(tmp_path / "parquet"), file_format="parquet")
    found = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(str(tmp_path / "parquet"))
    assert {(r.payment_id, int(r.day)) for r in found.collect()} == {("a", 5), ("b", 6)}
    with pytest.raises(ValueError):
        files.export_by_day(df, str(tmp_path / "x"), file_format="avro")


def test_export_selection(spark):
    df = spark.createDataFrame([(f"p{i}", at(i * 60)) for i in range(5)], "payment_id string, event_time timestamp")
    picked = files.select_export(df, start="2024-01-01T00:01:00Z", end="2024-01-01T00:04:00Z", limit=2)
    assert [r.payment_id for r in picked.collect()] == ["p1", "p2"]
    assert files.select_export(df).count() == 5


@pytest.mark.parametrize("per_second", [1, 400])
def test_first_rows_are_ranked_in_one_second_only(spark, per_second):
    rows = [(f"p{(i * 37) % 1000:03}", at(i // per_second)) for i in range(1000)] + [("n1", None), ("n0", None)]
    df = spark.createDataFrame(rows, "payment_id string, event_time timestamp").repartition(5)
    expected = sorted(rows, key=lambda r: (r[1] is not None, str(r[1]), r[0]))
    for n in (1, 2, 3, 399, 402, 403, 800, 1001, 1002, 5000):
        found = files.select_export(df, limit=n)
        assert sorted(r.payment_id for r in found.collect()) == sorted(p for p, _ in expected[:n])
    plan = files.select_export(df, limit=500)._jdf.queryExecution().toString()
    assert "Union" in plan and "date_trunc(second" in plan.lower()


def test_partitioned_write_and_bounded_read(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(f"p{i}", at(i * 40000)) for i in range(6)], "payment_id string, event_time timestamp")
    files.write_consolidated(df.withColumn("event_date", F.to_date("event_time")), path)
    assert read_bounded(spark, path).count() == 6
    assert [r.payment_id for r in read_bounded(spark, path, max_rows=2).collect()] == ["p0", "p1"]
    first_day = read_bounded(spark, path, max_files=1)
    assert "event_date" in first_day.columns and {str(r.event_date) for r in first_day.collect()} == {"2024-01-01"}


def test_jdbc_options_and_projection(spark):
    table = jdbc.JdbcTable("jdbc:db://host/x", "fraud.features", "me", "secret", "a.b.Driver")
    assert table.options() == {"url": "jdbc:db://host/x", "dbtable": "fraud.features", "user": "me", "password": "secret", "driver": "a.b.Driver"}
    assert "secret" not in repr(table)
    assert jdbc.Slices("event_time", "a", "b", 4).options() == {"partitionColumn": "event_time", "lowerBound": "a", "upperBound": "b", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc.write_jdbc(spark.range(1), table, "ignore")
    row = {c: "1" for c in [*schemas.SHORT_EVENT_COLUMNS, *schemas.FEATURE_COLUMNS]}
    raw = spark.createDataFrame([{**row, "event_time": "2024-01-01 00:00:00"}, {**row, "event_time": "x", "amount": "y", "payment_id": None}])
    (found,) = jdbc.jdbc_features(raw).collect()
    assert found.amount == 1.0 and found.tx_by_card_5m == 1 and found.event_time is not None
    assert len(jdbc.jdbc_features(raw).columns) == 17


def test_shared_folder_comes_from_the_session(spark):
    from paysignal.session import fresh_path, shared_dir, stage

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert stage(spark.range(5), "five").count() == 5


def test_export_of_text_times_never_fails(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:02:00 UTC"), ("b", "not-a-date"), ("c", None), ("d", "2024-01-02T00:00:00Z")],
                               "payment_id string, event_time string")
    assert [r.payment_id for r in files.select_export(df, end="2024-01-01T12:00:00Z").collect()] == ["a"]
    assert files.select_export(df).count() == 4


def test_versions_lie_below_the_warehouse_and_other_providers_are_refused(spark):
    name = f"kept_{uuid.uuid4().hex}"
    tables.replace_table(spark.range(5).toDF("n"), name)
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").head().data_type
    assert spark.conf.get("spark.sql.warehouse.dir").split(":")[-1] in place and "/versions/" in place
    other = f"other_{uuid.uuid4().hex}"
    spark.range(5).write.format("json").saveAsTable(other)
    assert tables.compact_table(spark, other) is False and spark.table(other).count() == 5


def test_delivered_files_grow_in_number_not_in_size(spark, sf_dir, tmp_path, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "FILE_MESSAGES", 100)
    inbox = str(tmp_path / "inbox")
    per_batch = queries._deliver(spark, sf_dir, inbox, 2)
    rows = [r["count"] for r in spark.read.text(inbox).groupBy(F.input_file_name()).count().collect()]
    assert per_batch == 5 and len(rows) == 10 and max(rows) < 130
