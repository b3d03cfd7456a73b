"""Times the headline queries; prints one JSON line.

Silver and Gold keys run from the raw events on every repetition. The keys
behind them read the stored layers, as their jobs do; building those layers is
timed on its own. Each value is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.sources import layers
from paysignal.plans import gold, silver
from paysignal.session import build_session, stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

KEYS = [
    "bronze_parse", "bronze_ingest", "silver_clean", "silver_features", "top_merchants",
    "fraud_alerts", "kpi_counts", "alerts_per_hour", "top_cards", "canonical", "consolidated", "consolidated_io",
    "risk_high_tx", "risk_cards", "risk_geo", "graph_nodes", "graph_edges", "graph_upsert", "graph_shared_devices",
    "graph_multi_country_cards", "graph_risky_merchants", "graph_device_clusters", "gold_export", "compaction",
    "training_set", "train_eval_split", "binary_metrics",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    found: dict[str, float] = {}

    base = layers(spark, SF_DIR)
    start = time.perf_counter()
    raw_rows = base.bronze.count()
    drain(base.gold)
    drain(base.consolidated)
    drain(base.stored_graph.edges["used_on"])
    found["build_all_layers_cold"] = round(time.perf_counter() - start, 3)

    bronze = base.bronze
    found["silver_from_stored_bronze"] = median_seconds(
        lambda: drain(silver.features(stage(silver.clean(bronze), "silver_clean")))
    )
    hot = base.clean.withColumn(
        "card_id", F.when(F.pmod(F.xxhash64("payment_id"), F.lit(3)) == 0, "card-hot").otherwise(F.col("card_id"))
    )
    hot = stage(hot, "hot")
    found["features_uniform"] = median_seconds(lambda: drain(silver.features(base.clean)))
    found["features_one_card_has_a_third"] = median_seconds(lambda: drain(silver.features(hot)))
    found["gold_from_stored_silver"] = median_seconds(lambda: drain(gold.score(base.silver)))

    for key in KEYS:
        found[key] = median_seconds(lambda: drain(QUERIES[key](spark, SF_DIR)))

    total = round(sum(found[k] for k in KEYS), 3)
    rates = {"bronze_ingest_rows_per_sec": round(raw_rows / found["bronze_ingest"])}
    print(
        json.dumps(
            {
                "metric": "total_median_seconds", "value": total, "unit": "sec", "queries": found,
                "sf": SF_DIR.rstrip("/").rpartition("sf")[2], "cpus": CPUS, "raw_rows": raw_rows, **rates,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
