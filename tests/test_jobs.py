"""The command line jobs, one after the other, on the smallest test tables."""

from __future__ import annotations

import uuid

import pytest

from checks.sources import layers, messages
from paysignal import jobs
from paysignal.plans import training
from paysignal.sinks import files


def test_pipeline(spark, sf_dir, tmp_path):
    run = uuid.uuid4().hex
    bronze, silver_t, alerts, relations = (f"{n}_{run}" for n in ("bronze", "silver", "alerts", "relations"))
    inbox = str(tmp_path / "inbox")
    messages(spark, sf_dir).write.text(inbox)
    ingest = ["ingest", "--format", "text", "--path", inbox, "--table", bronze, "--checkpoint", str(tmp_path / "cp"),
              "--location", str(tmp_path / "bronze"), "--trigger", "available-now"]
    jobs.main(ingest)
    jobs.main(ingest)
    assert spark.table(bronze).count() == 1031

    jobs.main(["silver", "--source", bronze, "--target", silver_t])
    assert spark.table(silver_t).count() == 1000 and len(spark.table(silver_t).columns) == 21
    jobs.main(["gold", "--source", silver_t, "--alerts", alerts, "--relations", relations])
    jobs.main(["gold", "--source", silver_t, "--alerts", alerts, "--relations", relations])
    assert spark.table(alerts).count() == 776 and spark.table(relations).count() == 1000
    jobs.main(["dashboard", "--bronze", bronze, "--silver", silver_t, "--alerts", alerts, "--top", "3"])
    jobs.main(["compact", "--table", alerts])
    assert spark.table(alerts).count() == 776

    jobs.main(["export", "--source", alerts, "--path", str(tmp_path / "export"), "--format", "parquet",
               "--start", "2024-01-01T01:00:00Z", "--end", "2024-01-01T02:00:00Z"])
    exported = spark.read.parquet(str(tmp_path / "export"))
    inside = spark.table(alerts).filter("event_time >= '2024-01-01 01:00:00' and event_time < '2024-01-01 02:00:00'")
    assert 0 < exported.count() == inside.count()

    prefix, out = f"g{run}", str(tmp_path / "graph")
    for name, bounds in (("early", ["--end", "2024-01-01T03:00:00Z"]), ("late", ["--start", "2024-01-01T02:00:00Z"])):
        jobs.main(["graph", "--source", relations, "--graph-name", f"{name}_{run}", "--output", out, *bounds])
        jobs.main(["load-graph", "--input", out, "--graph-name", f"{name}_{run}", "--prefix", prefix])
    assert spark.table(f"{prefix}_payments").count() == 1000
    jobs.main(["investigate", "--prefix", prefix, "--graph-name", f"late_{run}", "--output", str(tmp_path / "found")])
    assert spark.read.parquet(str(tmp_path / "found" / "risky_merchants")).count() == 93


def test_short_variant(spark, sf_dir, tmp_path):
    run = uuid.uuid4().hex
    inbox = str(tmp_path / "inbox")
    messages(spark, sf_dir).write.text(inbox)
    jobs.main(["ingest", "--format", "text", "--path", inbox, "--table", f"b_{run}", "--checkpoint", str(tmp_path / "cp"),
               "--location", str(tmp_path / "b"), "--trigger", "available-now", "--short-events"])
    jobs.main(["silver", "--source", f"b_{run}", "--target", f"s_{run}", "--order", "event_time", "--short"])
    jobs.main(["gold", "--source", f"s_{run}", "--alerts", f"a_{run}", "--relations", f"r_{run}", "--short"])
    assert len(spark.table(f"b_{run}").columns) == 13 and len(spark.table(f"s_{run}").columns) == 17
    assert len(spark.table(f"a_{run}").columns) == 19 and len(spark.table(f"r_{run}").columns) == 21
    assert spark.table(f"a_{run}").count() == 776


def test_analyse_and_train(spark, sf_dir, tmp_path):
    source = str(tmp_path / "consolidated")
    files.write_consolidated(layers(spark, sf_dir).consolidated, source)
    jobs.main(["analyse", "--input", source, "--output", str(tmp_path / "analyses"), "--format", "csv"])
    summary = spark.read.option("header", True).csv(str(tmp_path / "analyses" / "summary"))
    assert summary.count() == 3
    jobs.main(["train", "--input", source, "--output", str(tmp_path / "model"), "--max-train-rows", "200"])
    assert spark.read.parquet(str(tmp_path / "model" / "training_set")).count() == training.labelled(spark.read.parquet(source)).count() > 600
    sides = {r.split: r.total for r in spark.read.parquet(str(tmp_path / "model" / "split_sizes")).collect()}
    assert sum(sides.values()) == spark.read.parquet(str(tmp_path / "model" / "training_set")).count() and set(sides) == {"train", "eval"}
    jobs.main(["inspect", "--path", source, "--max-rows", "3"])
    assert {r.metric for r in spark.read.parquet(str(tmp_path / "model" / "metrics")).collect()} >= {"accuracy", "f1"}


def test_wrong_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["merge", "--store", "x"])
