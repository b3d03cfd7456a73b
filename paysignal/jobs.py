"""Command line jobs: ``python -m paysignal.jobs <job> --help``.

Tables are given by name, folders by path (anything with a slash). The database
password is read from the environment variable ``PAYSIGNAL_JDBC_PASSWORD``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from paysignal import schemas
from paysignal.operators.split import stratified_split
from paysignal.plans import analysis, dashboards, elt, gold, graph, silver, training
from paysignal.session import build_session, stage
from paysignal.sinks import files, graph_files, graph_store, tables
from paysignal.sources.files import read_bounded, read_table_or_path
from paysignal.sources.jdbc import JdbcTable, Slices, jdbc_features, read_jdbc, slices_over, write_jdbc
from paysignal.streaming import ingest


MOST_HOURS_SHOWN = 10_000


def run_ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    schema = schemas.SHORT_EVENT_SCHEMA if a.short_events else schemas.EVENT_SCHEMA
    bronze = schemas.SHORT_BRONZE_SCHEMA if a.short_events else schemas.BRONZE_SCHEMA
    if a.by_day:
        tables.ensure_table(spark, a.table, ingest.by_day_schema(bronze), a.location, partition_by=("event_date", tables.BATCH_COLUMN))
    else:
        tables.ensure_table(spark, a.table, bronze, a.location, a.provider)
    stream = ingest.message_stream(
        spark, a.format, path=a.path, bootstrap_servers=a.bootstrap_servers, topic=a.topic,
        starting_offsets=a.starting_offsets, fail_on_data_loss=a.fail_on_data_loss, max_per_trigger=a.max_per_trigger,
    )
    rows = ingest.bronze_rows(stream, schema, strict=not a.keep_corrupt)
    start = ingest.start_ingest_by_day if a.by_day else ingest.start_ingest
    query = start(
        rows, a.table, a.checkpoint, drain=a.trigger == "available-now", interval_seconds=a.interval_seconds
    )
    ingest.supervise(query, a.timeout_seconds)


def run_silver(spark: SparkSession, a: argparse.Namespace) -> None:
    strict = not a.keep_null_keys
    cleaned = stage(silver.clean(spark.table(a.source), a.order, strict), "silver_clean")
    built = silver.features(cleaned, strict=strict)
    tables.replace_table(silver.short_silver(built) if a.short else built, a.target)


def run_gold(spark: SparkSession, a: argparse.Namespace) -> None:
    scored = gold.score(spark.table(a.source))
    relations = gold.payment_relations(scored) if a.short else gold.graph_payments(scored)
    for rows, target in ((gold.alerts(scored, with_mcc=a.short), a.alerts), (relations, a.relations)):
        if a.by_day:
            tables.replace_by_period(rows, target)
        else:
            tables.replace_table(rows, target)
        if a.keep_versions:
            tables.drop_versions(spark, target, a.keep_versions)


def run_dashboard(spark: SparkSession, a: argparse.Namespace) -> None:
    alerts = spark.table(a.alerts)
    dashboards.layer_counts(
        {"bronze_rows": spark.table(a.bronze), "total_transactions": spark.table(a.silver), "total_fraud_alerts": alerts}
    ).show(truncate=False)
    # one row per hour: a year has 8784
    dashboards.alerts_per_hour(alerts, a.hours).show(a.hours or MOST_HOURS_SHOWN, truncate=False)
    for entity in ("merchant_id", "card_id"):
        dashboards.riskiest(alerts, entity, a.top).show(a.top, truncate=False)
    dashboards.top_alerts(alerts, a.top).show(a.top, truncate=False)
    dashboards.recent_features(spark.table(a.silver), a.top).show(a.top, truncate=False)


def run_export(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.select_export(read_table_or_path(spark, a.source), a.time_column, a.start, a.end, a.limit)
    files.export_by_day(rows, a.path, a.time_column, a.format)


def _jdbc(a: argparse.Namespace) -> JdbcTable:
    password = os.environ.get("PAYSIGNAL_JDBC_PASSWORD", "")
    return JdbcTable(a.jdbc_url, a.jdbc_table, a.jdbc_user, password, a.jdbc_driver)


def run_load_jdbc(spark: SparkSession, a: argparse.Namespace) -> None:
    write_jdbc(jdbc_features(read_table_or_path(spark, a.source)), _jdbc(a), a.mode)


def run_merge(spark: SparkSession, a: argparse.Namespace) -> None:
    source, slices = _jdbc(a), None
    if a.slice_column and a.slice_lower and a.slice_upper:
        slices = Slices(a.slice_column, a.slice_lower, a.slice_upper, a.slices)
    elif a.slice_column:
        slices = slices_over(spark, source, a.slice_column, a.slices)
    limits = elt.RiskThresholds(
        a.high_risk_threshold, a.tx5m_threshold, a.merchants10m_threshold, a.countries1h_threshold, a.suspicious_countries
    )
    merged = elt.merge(
        elt.canonical(read_table_or_path(spark, a.store), "s3"), elt.canonical(read_jdbc(spark, source, slices), "rds")
    )
    if a.compute_counts:
        merged = stage(merged, "merged")
        elt.stage_counts(merged, limits).show()
    files.write_consolidated(merged.filter(elt.is_risky(limits)), a.output, a.mode)


def run_analyse(spark: SparkSession, a: argparse.Namespace) -> None:
    base = analysis.typed(read_table_or_path(spark, a.input))
    limits = analysis.AnalysisLimits(
        a.high_risk_threshold, a.min_high_risk_tx, a.tx5m_threshold, a.countries_threshold,
        a.countries_threshold if a.geo_countries1h_threshold is None else a.geo_countries1h_threshold, a.suspicious_countries,
    )
    analysis.write_analyses(spark, base, a.output, a.format, a.mode, limits).show(truncate=False)


def run_inspect(spark: SparkSession, a: argparse.Namespace) -> None:
    read_bounded(spark, a.path, a.max_files, a.max_rows).show(a.max_rows, truncate=False)


def run_compact(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.compact_table(spark, a.table, a.file_mb * 1024 * 1024)


def run_graph(spark: SparkSession, a: argparse.Namespace) -> None:
    staged = tables.replace_table(
        graph.staging(read_table_or_path(spark, a.source), a.start, a.end), f"graph_dataset_{a.graph_name}"
    )
    built = graph.snapshot(staged, a.graph_name)
    graph_files.write_graph(built, f"{a.output.rstrip('/')}/{a.graph_name}")
    graph.export_counts(staged).show()


def run_load_graph(spark: SparkSession, a: argparse.Namespace) -> None:
    """Load snapshot files into the accumulated graph tables ``<prefix>_<label>``, or into the folders of a store."""
    new = graph_files.read_graph(spark, f"{a.input.rstrip('/')}/{a.graph_name}")
    if a.store:
        graph_store.load(spark, a.store.rstrip("/"), new, a.graph_name)
        if a.keep_versions:
            graph_store.drop_old(spark, a.store.rstrip("/"), a.keep_versions)
        return
    names = {**{label: f"{a.prefix}_{label}" for label in new.nodes}, **{edge: f"{a.prefix}_{edge}" for edge in new.edges}}

    def stored(name: str, like: DataFrame) -> DataFrame:
        tables.ensure_table(spark, names[name], like.schema)
        return spark.table(names[name])

    store = graph.Graph(
        {label: stored(label, df) for label, df in new.nodes.items()},
        {edge: stored(edge, df) for edge, df in new.edges.items()},
    )
    loaded = graph.load_snapshot(store, new, a.graph_name)
    # all new versions are complete before the first table changes
    changed = {names[name]: df for name, df in {**loaded.nodes, **loaded.edges}.items()}
    versions = {table: tables.write_version(df, table) for table, df in changed.items()}
    for table, path in versions.items():
        tables.point_table_at(spark, table, path, changed[table].schema)


def run_investigate(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.store:
        loaded = graph_store.read_store(spark, a.store.rstrip("/"), graph_files.empty_graph(spark))
    else:
        loaded = graph.Graph(
            {label: spark.table(f"{a.prefix}_{label}") for label in graph.NODE_KEYS},
            {edge[0]: spark.table(f"{a.prefix}_{edge[0]}") for edge in graph.EDGE_TYPES},
        )
    for query in (graph.shared_devices, graph.multi_country_cards, graph.risky_merchants, graph.device_clusters):
        files.write_result(query(loaded, a.graph_name), a.output, query.__name__)


def run_train(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = stage(training.labelled(read_table_or_path(spark, a.input), a.high_risk_threshold), "labelled")
    model, _, metrics = training.train_classifier(
        rows, not a.without_label_inputs, a.test_size, a.random_state, a.hash_size, max_train_rows=a.max_train_rows,
        most_categories=a.most_categories,
    )
    files.write_result(rows.select("text", "label"), a.output, "training_set")
    files.write_result(training.label_distribution(rows), a.output, "class_distribution")
    parts = stratified_split(rows, "label", "payment_id", a.test_size, a.random_state)
    files.write_result(training.split_sizes(parts), a.output, "split_sizes")
    files.write_result(spark.createDataFrame(list(metrics.items()), "metric string, value double"), a.output, "metrics")
    model.write().overwrite().save(f"{a.output.rstrip('/')}/model")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="paysignal")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        p.set_defaults(run=run, job=name)
        for option in required:
            p.add_argument(f"--{option}", required=True)
        return p

    p = job("ingest", run_ingest, "table", "checkpoint")
    p.add_argument("--format", default="kafka", choices=["kafka", "text"])
    p.add_argument("--path")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--topic", default="payments")
    p.add_argument("--starting-offsets", choices=["earliest", "latest"], default="earliest")
    p.add_argument("--trigger", choices=["processing-time", "available-now"], default="processing-time")
    p.add_argument("--interval-seconds", type=int, default=5)
    p.add_argument("--timeout-seconds", type=int, default=0)
    p.add_argument("--max-per-trigger", type=int, help="messages (Kafka) or files of one batch at most; the rest follows in later batches")
    p.add_argument("--short-events", action="store_true")
    p.add_argument("--keep-corrupt", action="store_true")
    p.add_argument("--fail-on-data-loss", action="store_true")
    p.add_argument("--by-day", action="store_true", help="Parquet partitions by event date and batch; a batch delivered twice is stored once")
    p.add_argument("--provider", default="parquet")
    p.add_argument("--location")

    p = job("silver", run_silver, "source", "target")
    p.add_argument("--order", choices=["ingestion_ts", "event_time"], default="ingestion_ts")
    p.add_argument("--short", action="store_true")
    p.add_argument("--keep-null-keys", action="store_true")

    p = job("gold", run_gold, "source", "alerts", "relations")
    p.add_argument("--short", action="store_true")
    p.add_argument("--by-day", action="store_true", help="lay the tables out by event date (one more column)")
    p.add_argument("--keep-versions", type=int, default=0, help="remove all but the newest versions; 0 keeps all")

    p = job("dashboard", run_dashboard, "bronze", "silver", "alerts")
    p.add_argument("--top", type=int, default=20)
    p.add_argument("--hours", type=int, default=0, help="only the first hours; 0 shows all")

    p = job("export", run_export, "source", "path")
    p.add_argument("--format", choices=["json", "parquet"], default="json")
    p.add_argument("--time-column", default="event_time")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--limit", type=int, default=0)

    for name, run, required in (
        ("load-jdbc", run_load_jdbc, ("source",)),
        ("merge", run_merge, ("store", "output")),
    ):
        p = job(name, run, *required, "jdbc-url", "jdbc-table")
        p.add_argument("--jdbc-user", default="")
        p.add_argument("--jdbc-driver", default="")
        p.add_argument("--mode", choices=["append", "overwrite"], default="overwrite")
    defaults = elt.RiskThresholds()
    p.add_argument("--high-risk-threshold", type=float, default=defaults.score)
    p.add_argument("--tx5m-threshold", type=int, default=defaults.tx_5m)
    p.add_argument("--merchants10m-threshold", type=int, default=defaults.merchants_10m)
    p.add_argument("--countries1h-threshold", type=int, default=defaults.countries_1h)
    p.add_argument("--suspicious-countries", default=defaults.countries)
    p.add_argument("--compute-counts", action="store_true")
    reading = p.add_mutually_exclusive_group(required=True)
    reading.add_argument("--slice-column", help="date, time or number column for a parallel read")
    reading.add_argument("--one-task", action="store_true", help="read a small table over one connection")
    p.add_argument("--slice-lower", help="both bounds are asked from the database unless given")
    p.add_argument("--slice-upper")
    p.add_argument("--slices", type=int, default=16)

    p = job("analyse", run_analyse, "input", "output")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--mode", choices=["append", "overwrite"], default="overwrite")
    limits = analysis.AnalysisLimits()
    p.add_argument("--high-risk-threshold", type=float, default=limits.score)
    p.add_argument("--min-high-risk-tx", type=int, default=limits.min_high_risk)
    p.add_argument("--tx5m-threshold", type=int, default=limits.tx_5m)
    p.add_argument("--countries-threshold", type=int, default=limits.card_countries)
    p.add_argument("--geo-countries1h-threshold", type=int, help="as --countries-threshold unless given")
    p.add_argument("--suspicious-countries", default=limits.countries)

    p = job("inspect", run_inspect, "path")
    p.add_argument("--max-files", type=int, default=1, help="the first files by name; 0 reads all")
    p.add_argument("--max-rows", type=int, default=20, help="the first rows by time and payment")

    p = job("compact", run_compact, "table")
    p.add_argument("--file-mb", type=int, default=64)

    p = job("graph", run_graph, "source", "graph-name", "output")
    p.add_argument("--start")
    p.add_argument("--end")

    p = job("load-graph", run_load_graph, "input", "graph-name")
    p.add_argument("--prefix", default="graph")
    p.add_argument("--store", help="folder of a graph store: writes only what changes, and switches all tables at once")
    p.add_argument("--keep-versions", type=int, default=0, help="of a store: remove all but the newest versions; 0 keeps all")

    p = job("investigate", run_investigate, "output")
    p.add_argument("--graph-name")
    p.add_argument("--prefix", default="graph")
    p.add_argument("--store", help="read the graph from the folder of a graph store")

    p = job("train", run_train, "input", "output")
    p.add_argument("--max-train-rows", type=int, default=0, help="rows per label given to the fit; 0 means all")
    p.add_argument("--hash-size", type=int, default=4096, help="columns that cards are hashed into")
    p.add_argument("--most-categories", type=int, default=256, help="countries and statuses with a column of their own")
    p.add_argument("--test-size", type=float, default=0.2)
    p.add_argument("--random-state", type=int, default=42)
    p.add_argument("--high-risk-threshold", type=float, default=analysis.HIGH_RISK)
    p.add_argument("--without-label-inputs", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"paysignal-{args.job}"), args)


if __name__ == "__main__":
    main()
