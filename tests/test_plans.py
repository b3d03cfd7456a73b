"""Plans that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paysignal.operators.joins import keep_known
from paysignal.operators.reach import members
from paysignal.plans import elt, graph, silver
from paysignal.session import stage


def text(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return text(df).split("== Physical Plan ==")[1]


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def shuffled(spark):
    """No broadcast joins, as with tables of real size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dedup_cuts_each_key_before_the_shuffle(bronze):
    plan = physical(silver.clean(bronze([{}])))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(payment_id") < plan.index("Partial")
    assert plan.count("Exchange hashpartitioning") == 1


def test_merge_adds_no_shuffle(shuffled, bronze):
    raw = bronze([{}])
    merged = elt.merge(elt.canonical(raw, "s3"), elt.canonical(raw, "rds"))
    assert physical(merged).count("Exchange hashpartitioning") == 2
    assert "FullOuter" in physical(merged)


def test_wide_rows_shuffle_once_for_the_features(shuffled, bronze):
    built = silver.features(stage(silver.clean(bronze([{}])), "clean"))
    built.collect()
    plan = physical(built).split("Initial Plan")[-1]
    by_payment = [line for line in plan.splitlines() if "Exchange hashpartitioning(payment_id" in line]
    assert len(by_payment) == 2  # the wide rows, and the narrow feature rows
    scans = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert len([c for c in scans if "mcc" in c]) == 1
    assert len([c for c in scans if "mcc" not in c]) >= 4


def test_time_range_reaches_the_scan(spark, sf_dir):
    from checks.sources import layers

    plan = text(graph.staging(layers(spark, sf_dir).gold, "2024-01-01T01:00:00Z", "2024-01-01T04:00:00Z"))
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_time" in pushed and "LessThan(event_time" in pushed


@pytest.fixture
def small_partitions(shuffled):
    """Skew thresholds scaled down to test data."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: shuffled.conf.get(k) for k in settings}
    for k, v in settings.items():
        shuffled.conf.set(k, v)
    yield shuffled
    for k, v in before.items():
        shuffled.conf.set(k, v)


def test_a_hub_device_is_split_over_tasks(small_partitions):
    """One device with two thirds of the rows."""
    raw = small_partitions.range(0, 60000, 1, 8).select(
        F.timestamp_seconds(1_704_067_200 + F.col("id") % 20000).alias("event_time"),
        F.concat(F.lit("pay-"), F.col("id")).alias("payment_id"),
        F.concat(F.lit("card-"), F.col("id") % 5000).alias("card_id"),
        F.when(F.col("id") % 3 > 0, "hub").otherwise(F.concat(F.lit("d"), F.col("id") % 900)).alias("device_id"),
        F.lit("m1").alias("merchant_id"), F.lit("ES").alias("country"), F.lit("approved").alias("status"),
    )
    hub = silver.features(stage(raw, "hub"))
    counted = hub.groupBy("device_id").agg(F.count("*").alias("n"), F.min("distinct_cards_per_device").alias("least"),
                                           F.max("distinct_cards_per_device").alias("most"))
    found = {r.device_id: (r.n, r.least, r.most) for r in counted.collect()}
    assert found["hub"] == (40000, 5000, 5000) and len(found) == 301
    joins = [line for line in text(counted).splitlines() if "SortMergeJoin(skew=true)" in line]
    assert any("device_id" in line for line in joins)


def test_hub_keys_in_graph_joins_are_split(small_partitions):
    pairs = small_partitions.range(0, 90000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hub").otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("k"),
        F.concat(F.lit("member-"), F.col("id")).alias("m"),
    )
    pairs = stage(pairs, "pairs")
    found = members(pairs, "k", "m", "total", 2)
    assert tuple(found.filter("k = 'hub'").agg(F.count("*"), F.min("total")).head()) == (60000, 60000)
    found.collect()
    assert "SortMergeJoin(skew=true)" in text(found)
    known = keep_known(pairs, pairs.select("k").distinct(), "k").agg(F.count_distinct("m"))
    assert known.collect()[0][0] == 90000
    assert "SortMergeJoin(skew=true)" in text(known)


def test_investigations_plan_few_shuffles(shuffled, sf_dir):
    from checks.sources import layers

    stored = layers(shuffled, sf_dir).stored_graph
    for query in (graph.risky_merchants, graph.device_clusters):
        assert physical(query(stored, "late")).count("Exchange hashpartitioning") <= 15


def test_events_are_spread_before_payments_are_derived(spark, sf_dir):
    from checks.sources import payments_from_events

    plan = text(payments_from_events(spark, sf_dir))
    # nearer to the scan comes later: the derivation runs behind the shuffle, whatever row groups the file has
    assert plan.index("Generate") < plan.index("Exchange") < plan.index("Scan parquet")


def test_bronze_and_gold_are_not_written_again(spark, sf_dir):
    from checks.sources import layers

    base = layers(spark, sf_dir)
    assert "events.parquet" in base.bronze.inputFiles()[0]
    assert set(base.gold.inputFiles()) == set(base.silver.inputFiles())
