"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.sources import EARLY, LATE, Layers, layers, messages
from paysignal.functions.columns import in_time_range
from paysignal.functions.text import feature_text
from paysignal.operators.metrics import binary_metrics
from paysignal.operators.split import stratified_split
from paysignal.plans import analysis, dashboards, elt, gold, graph, silver, training
from paysignal.schemas import BRONZE_SCHEMA, EVENT_COLUMNS
from paysignal.session import configure, fresh_path, stage
from paysignal.sinks import files, graph_files, graph_store, tables
from paysignal.sources.files import read_bounded
from paysignal.sources.jdbc import jdbc_features
from paysignal.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Times and arrays as text, so that two engines can be compared value by value."""

    def shown(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def _on(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(layers(spark, sf_dir)))


# --- Bronze ------------------------------------------------------------------


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_messages(messages(configure(spark), sf_dir))


def _ingest_all(spark: SparkSession, inbox: str, table: str, checkpoint: str) -> None:
    stream = ingest.message_stream(spark, "text", path=inbox)
    query = ingest.start_ingest(ingest.bronze_rows(stream), table, checkpoint, drain=True, query_name=table)
    ingest.supervise(query)


# Messages of a delivered file, some 60 MB of text.
FILE_MESSAGES = 200_000


def _deliver(spark: SparkSession, sf_dir: str, inbox: str, batches: int) -> int:
    """Messages as equal files of bounded size; returns how many of them make one of ``batches`` batches."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # from the footers
    per_batch = max(-(-events // (batches * FILE_MESSAGES)), 1)
    messages(spark, sf_dir).repartition(batches * per_batch).write.text(inbox)
    return per_batch


def bronze_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed batches of a quarter of the files each, stopped by the time limit, then the rest with the same checkpoint."""
    table, inbox, checkpoint = _new_bronze_table(configure(spark), "bronze_timed")
    stream = ingest.message_stream(spark, "text", path=inbox, max_per_trigger=_deliver(spark, sf_dir, inbox, 4))
    query = ingest.start_ingest(ingest.bronze_rows(stream), table, checkpoint, interval_seconds=1, query_name=table)
    ingest.supervise(query, timeout_seconds=8)
    _ingest_all(spark, inbox, table, checkpoint)
    return spark.table(table).select(*EVENT_COLUMNS)


def bronze_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What timed batches of a quarter of the files each report: how many batches had messages, and how many messages."""
    table, inbox, checkpoint = _new_bronze_table(configure(spark), "bronze_progress")
    stream = ingest.message_stream(spark, "text", path=inbox, max_per_trigger=_deliver(spark, sf_dir, inbox, 4))
    query = ingest.start_ingest(ingest.bronze_rows(stream), table, checkpoint, interval_seconds=1, query_name=table)
    query.processAllAvailable()
    ingest.supervise(query, timeout_seconds=1)
    sizes = ingest.batch_sizes(query)
    stored = spark.table(table).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(F.lit(len(sizes)).cast("long").alias("batches"), F.lit(sum(sizes.values())).cast("long").alias("messages"), "stored")


def bronze_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches by event date, the second delivered twice, then compacted and delivered once more."""
    root = fresh_path(configure(spark), "bronze_by_day")
    table, inbox = f"bronze_by_day_{root[-32:]}", f"{root}/inbox"
    parts = ("event_date", tables.BATCH_COLUMN)
    tables.ensure_table(spark, table, ingest.by_day_schema(BRONZE_SCHEMA), f"{root}/table", partition_by=parts)
    stream = ingest.message_stream(spark, "text", path=inbox, max_per_trigger=_deliver(spark, sf_dir, inbox, 2))
    query = ingest.start_ingest_by_day(ingest.bronze_rows(stream), table, f"{root}/checkpoint", drain=True, query_name=table)
    ingest.supervise(query)
    last = max(ingest.batch_sizes(query), default=0)
    again = stage(spark.table(table).filter(F.col(tables.BATCH_COLUMN) == last).drop(*parts), "again")
    ingest.append_batch(again, last, table)
    tables.compact_table(spark, table)
    ingest.append_batch(again, last, table)
    return spark.table(table).select(*EVENT_COLUMNS)


def _new_bronze_table(spark: SparkSession, name: str) -> tuple[str, str, str]:
    root = fresh_path(spark, name)
    table = f"{name}_{root[-32:]}"
    tables.ensure_table(spark, table, BRONZE_SCHEMA, f"{root}/table")
    return table, f"{root}/inbox", f"{root}/checkpoint"


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, inbox, checkpoint = _new_bronze_table(configure(spark), "bronze_ingest")
    messages(spark, sf_dir).write.text(inbox)
    _ingest_all(spark, inbox, table, checkpoint)
    return spark.table(table).select(*EVENT_COLUMNS)


def bronze_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, one run each with the same checkpoint, and a run that finds nothing new."""
    table, inbox, checkpoint = _new_bronze_table(configure(spark), "bronze_resume")
    all_messages = messages(spark, sf_dir)
    early = F.coalesce(F.get_json_object("value", "$.scenario") == "normal", F.lit(False))
    for delivery in (early, ~early):
        all_messages.filter(delivery).write.mode("append").text(inbox)
        _ingest_all(spark, inbox, table, checkpoint)
    _ingest_all(spark, inbox, table, checkpoint)
    return spark.table(table).select(*EVENT_COLUMNS)


# --- Silver and Gold, built from the raw table on every call -----------------


def _fresh_silver(spark: SparkSession, sf_dir: str, order: str = "ingestion_ts") -> DataFrame:
    bronze = Layers(configure(spark), sf_dir).payments()
    return silver.features(stage(silver.clean(bronze, order), "silver_clean"))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.clean(Layers(configure(spark), sf_dir).payments()))


def silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_fresh_silver(spark, sf_dir))


def silver_features_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver.short_silver(_fresh_silver(spark, sf_dir, "event_time")))


def gold_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.score(_fresh_silver(spark, sf_dir)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events to the ranking of the riskiest merchants."""
    return dashboards.riskiest(gold.alerts(gold.score(_fresh_silver(spark, sf_dir))), "merchant_id")


def replaced_tables(layer: Layers) -> DataFrame:
    """Gold tables replaced twice, the second time from their own content."""
    suffix = fresh_path(layer.spark, "t")[-32:]
    alerts_table = tables.replace_table(layer.alerts(), f"fraud_alerts_{suffix}")
    tables.replace_table(alerts_table.filter("risk_score >= 30"), f"fraud_alerts_{suffix}")
    return layer.spark.table(f"fraud_alerts_{suffix}").select("payment_id", "risk_score", "reasons_text")


def gold_by_hour(layer: Layers) -> DataFrame:
    """Alerts laid out by hour; one hour is then replaced by its high scores; a range of time is read from the table."""
    name = f"alerts_by_hour_{fresh_path(layer.spark, 't')[-32:]}"
    table = tables.replace_by_period(layer.alerts(), name, unit="hour")
    hour = in_time_range(F.col("event_time"), "2024-01-01T01:00:00Z", "2024-01-01T02:00:00Z")
    tables.overwrite_periods(table.filter(hour & (F.col("risk_score") >= 60)), name, unit="hour")
    kept = files.select_export(layer.spark.table(name), start="2024-01-01T00:30:00Z", end="2024-01-01T03:00:00Z")
    return kept.select("payment_id", "event_time", "risk_score", "reasons_text")


# --- writes, read back ---------------------------------------------------------


def consolidated_io(layer: Layers) -> DataFrame:
    path = fresh_path(layer.spark, "consolidated_io")
    files.write_consolidated(layer.consolidated, path)
    return layer.spark.read.parquet(path)


def bounded_read(layer: Layers) -> DataFrame:
    """The first 400 rows, by time and payment, of a folder laid out by day."""
    path = fresh_path(layer.spark, "bounded_read")
    files.write_consolidated(layer.consolidated, path)
    return read_bounded(layer.spark, path, max_rows=400).select("payment_id", "event_time", "risk_score")


def _analysis_rows(transactions: DataFrame, cards: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of the three analyses: ``dataset``, ``id``, ``total``."""
    hour = F.date_format(F.col("hour_bucket").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    parts = [
        ("high_risk_transactions", transactions, F.col("payment_id"), F.round(F.col("risk_score").cast("double"))),
        ("suspicious_cards", cards, F.col("card_id"), F.col("total_tx")),
        ("geo_fraud_patterns", places, F.concat_ws(" ", "country", hour), F.col("total_tx")),
    ]
    rows = [df.select(F.lit(n).alias("dataset"), k.alias("id"), t.cast("long").alias("total")) for n, df, k, t in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def analysis_tables(layer: Layers) -> DataFrame:
    """The query-service variant: three external tables."""
    root = fresh_path(layer.spark, "analysis_tables")
    base = analysis.typed(layer.consolidated)
    built = {
        "high_risk_transactions": analysis.high_risk_tx_sql(base),
        "suspicious_cards": analysis.suspicious_cards_sql(base),
        "geo_fraud_patterns": analysis.geo_patterns_sql(base),
    }
    names = {name: f"{name}_{root[-32:]}" for name in built}
    for name, df in built.items():
        tables.table_as_select(df, names[name], f"{root}/{name}")
    return _analysis_rows(*[layer.spark.table(table) for table in names.values()])


def _analyses_from_csv(layer: Layers, limits: analysis.AnalysisLimits) -> DataFrame:
    root = fresh_path(layer.spark, "analysis_io")
    summary = analysis.write_analyses(layer.spark, analysis.typed(layer.consolidated), root, "csv", limits=limits)
    paths = {r.dataset: r.output_path for r in summary.collect()}  # three paths
    names = ("high_risk_transactions", "suspicious_cards", "geo_fraud_patterns")
    return _analysis_rows(*[layer.spark.read.option("header", True).csv(paths[n]) for n in names])


def analysis_io(layer: Layers) -> DataFrame:
    """All three analyses written as CSV and read back."""
    return _analyses_from_csv(layer, analysis.AnalysisLimits())


def analysis_limits(layer: Layers) -> DataFrame:
    """As ``analysis_io``, with every limit changed."""
    return _analyses_from_csv(layer, analysis.AnalysisLimits(80, 3, 6, 4, 3, "MX"))


def analysis_summary(layer: Layers) -> DataFrame:
    """The summary with paths relative to the output folder."""
    root = fresh_path(layer.spark, "analysis_summary")
    found = analysis.write_analyses(layer.spark, analysis.typed(layer.consolidated), root)
    return found.withColumn("output_path", F.replace("output_path", F.lit(root), F.lit("")))


def gold_export(layer: Layers) -> DataFrame:
    path = fresh_path(layer.spark, "gold_export")
    alerts = layer.alerts()
    files.export_by_day(files.select_export(alerts, start="2024-01-01T00:30:00Z"), path)
    return layer.spark.read.schema(
        T.StructType([*alerts.schema, *[T.StructField(p, T.StringType()) for p in ("year", "month", "day")]])
    ).json(path)


def gold_export_first(layer: Layers) -> DataFrame:
    """The first 700 alerts from a time on, exported as Parquet."""
    path = fresh_path(layer.spark, "gold_export_first")
    files.export_by_day(files.select_export(layer.alerts(), start="2024-01-01T01:10:00Z", limit=700), path, file_format="parquet")
    return layer.spark.read.parquet(path).select("payment_id", "event_time", "risk_score")


def gold_export_all(layer: Layers) -> DataFrame:
    """All alerts exported as Parquet, whatever their time."""
    path = fresh_path(layer.spark, "gold_export_all")
    files.export_by_day(files.select_export(layer.alerts()), path, file_format="parquet")
    options = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
    reader = layer.spark.newSession()
    for key, value in options.items():
        reader.conf.set(key, value)
    reader.conf.set("spark.sql.session.timeZone", "UTC")
    return comparable(reader.read.parquet(path))


def compaction(layer: Layers) -> DataFrame:
    source, target = fresh_path(layer.spark, "scattered"), fresh_path(layer.spark, "compacted")
    layer.gold.repartition(24).write.parquet(source)
    return tables.compact_folder(layer.spark, source, target).select(*layer.gold.columns)


def compaction_files(layer: Layers) -> DataFrame:
    """Whether compaction left fewer files, none much bigger than asked for."""
    source, target = fresh_path(layer.spark, "scattered"), fresh_path(layer.spark, "compacted")
    layer.gold.repartition(48).write.parquet(source)
    before = tables.file_sizes(layer.spark, source).agg(F.count("*").alias("n"), F.sum("length").alias("size")).head()
    wanted = max(before["size"] // 4, 1)
    tables.compact_folder(layer.spark, source, target, wanted)
    after = tables.file_sizes(layer.spark, target).agg(F.count("*").alias("n"), F.max("length").alias("largest"))
    return after.select(
        (F.col("n") < before["n"]).alias("fewer"), F.col("n").between(2, 12).alias("as_asked"),
        (F.col("largest") <= 2 * wanted).alias("bounded"),
    )


def _graph_through_files(layer: Layers) -> graph.Graph:
    """The full snapshot written as files, with a second copy of some nodes and with dangling edges, and read back."""
    root = fresh_path(layer.spark, "graph_csv")
    full = layer.snapshot("full", (None, None))
    nodes = {label: df.unionByName(df.filter(F.col(graph.NODE_KEYS[label]).endswith("3"))) for label, df in full.nodes.items()}
    edges = dict(full.edges)
    astray = edges["used_on"].select("card_id", F.concat(F.lit("lost-"), "device_id").alias("device_id"))
    edges["used_on"] = edges["used_on"].unionByName(astray)
    graph_files.write_graph(graph.Graph(nodes, edges), root)
    return graph_files.read_graph(layer.spark, root)


def graph_csv_roundtrip(layer: Layers) -> DataFrame:
    return _graph_through_files(layer).nodes["payments"]


def graph_csv_nodes(layer: Layers) -> DataFrame:
    return _node_ids(_graph_through_files(layer).nodes)


def graph_csv_edges(layer: Layers) -> DataFrame:
    return _edge_rows(_graph_through_files(layer).edges)


# --- graph ---------------------------------------------------------------------


def _node_ids(found: dict[str, DataFrame]) -> DataFrame:
    ids = [found[label].select(F.lit(label).alias("label"), F.col(key).alias("id")) for label, key in graph.NODE_KEYS.items()]
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).unionByName(ids[3]).unionByName(ids[4])


def graph_nodes(layer: Layers) -> DataFrame:
    return _node_ids(layer.snapshot("full", (None, None)).nodes)


def _reloaded(layer: Layers) -> graph.Graph:
    """The stored graph after its early snapshot is loaded again with only the first hour."""
    return graph.load_snapshot(layer.stored_graph, layer.snapshot("early", (None, "2024-01-01T01:00:00Z")), "early")


def _reloaded_store(layer: Layers) -> graph.Graph:
    """The same reload, through the stored folders and their manifests."""
    root = fresh_path(layer.spark, "graph_store")
    first_hour = layer.snapshot("early", (None, "2024-01-01T01:00:00Z"))
    for name, found in (("early", layer.snapshot("early", EARLY)), ("late", layer.snapshot("late", LATE)), ("early", first_hour)):
        graph_store.load(layer.spark, root, found, name)
    return graph_store.read_store(layer.spark, root, first_hour)


def graph_key_violations(layer: Layers) -> DataFrame:
    """The stored graph with a second copy of some cards."""
    stored = layer.stored_graph
    cards = stored.nodes["cards"]
    doubled = cards.unionByName(cards.filter(F.col("card_id").endswith("7")))
    return graph.key_violations(graph.Graph({**stored.nodes, "cards": doubled}, stored.edges))


def graph_dangling_edges(layer: Layers) -> DataFrame:
    """Edges that remain when some cards are missing."""
    found = layer.snapshot("full", (None, None))
    cards = found.nodes["cards"].filter(~F.col("card_id").endswith("7"))
    return _edge_rows(graph.resolve_edges(found.edges, {**found.nodes, "cards": cards}))


def _edge_rows(edges: dict[str, DataFrame]) -> DataFrame:
    rows = [
        edges[name].select(F.lit(name).alias("edge"), F.col(source).alias("source"), F.col(target).alias("target"))
        for name, _, source, _, target in graph.EDGE_TYPES
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def graph_edges(layer: Layers) -> DataFrame:
    found = layer.snapshot("full", (None, None))
    return _edge_rows(graph.resolve_edges(found.edges, found.nodes))


# --- training ------------------------------------------------------------------


def _rule_as_model(layer: Layers) -> DataFrame:
    """The rule score as a predictor of the label: alert from 60 points on."""
    return training.labelled(layer.consolidated).withColumn("prediction", (F.col("risk_score") >= 60).cast("int"))


def binary_metrics_row(layer: Layers) -> DataFrame:
    found = binary_metrics(_rule_as_model(layer), "label", "prediction", "risk_score")
    values = [(name, round(value, 9)) for name, value in found.items()]
    return layer.spark.createDataFrame(values, "metric string, value double")


def classifier_metrics(layer: Layers) -> DataFrame:
    rows = stage(training.labelled(layer.consolidated), "labelled")
    values = []
    for with_label_inputs in (True, False):
        _, _, found = training.train_classifier(rows, with_label_inputs)
        values += [("all inputs" if with_label_inputs else "without label inputs", m, v) for m, v in found.items()]
    return layer.spark.createDataFrame(values, "inputs string, metric string, value double")


def train_eval_split(layer: Layers) -> DataFrame:
    rows = training.labelled(layer.consolidated).select("payment_id", "label")
    return stratified_split(stage(rows, "labels"), "label", "payment_id")


def classifier_split_sizes(layer: Layers) -> DataFrame:
    """What the classifier learns from and is measured on: rows and positives of both sides."""
    rows = stage(training.labelled(layer.consolidated), "labelled")
    return training.split_sizes(stratified_split(rows, "label", "payment_id"))


def classifier_eval_rows(layer: Layers) -> DataFrame:
    """The evaluation rows that a trained model has scored."""
    _, scored, _ = training.train_classifier(stage(training.labelled(layer.consolidated), "labelled"))
    return scored.filter(F.col("score").between(0, 1)).select("payment_id", "label")


QUERIES: dict[str, Query] = {
    "bronze_parse": bronze_parse,
    "bronze_ingest": bronze_ingest,
    "bronze_resume": bronze_resume,
    "bronze_timed": bronze_timed,
    "bronze_progress": bronze_progress,
    "bronze_by_day": bronze_by_day,
    "silver_clean": silver_clean,
    "silver_features": silver_features,
    "silver_features_short": silver_features_short,
    "gold_scored": gold_scored,
    "fraud_alerts": _on(lambda l: l.alerts()),
    "fraud_alerts_mcc": _on(lambda l: gold.alerts(l.gold, with_mcc=True)),
    "graph_payments": _on(lambda l: gold.graph_payments(l.gold)),
    "payment_relations": _on(lambda l: gold.payment_relations(l.gold)),
    "replaced_tables": _on(replaced_tables),
    "gold_by_hour": _on(gold_by_hour),
    "kpi_counts": _on(
        lambda l: dashboards.layer_counts(
            {"bronze_rows": l.bronze, "total_transactions": l.silver, "total_fraud_alerts": l.alerts()}
        )
    ),
    "alerts_per_hour": _on(lambda l: dashboards.alerts_per_hour(l.alerts())),
    "alerts_first_24_hours": _on(lambda l: dashboards.alerts_per_hour(l.alerts(), 24)),
    "alerts_first_3_hours": _on(lambda l: dashboards.alerts_per_hour(l.alerts(), 3)),
    "top_merchants": flagship,
    "top_merchants_10": _on(lambda l: dashboards.riskiest(l.alerts(), "merchant_id", 10)),
    "top_cards": _on(lambda l: dashboards.riskiest(l.alerts(), "card_id")),
    "top_cards_10": _on(lambda l: dashboards.riskiest(l.alerts(), "card_id", 10)),
    "top_alerts": _on(lambda l: dashboards.top_alerts(l.alerts())),
    "recent_features": _on(lambda l: dashboards.recent_features(l.silver)),
    "jdbc_features": _on(lambda l: jdbc_features(l.silver)),
    "canonical": _on(
        lambda l: elt.canonical(l.store_side(), "s3").unionByName(elt.canonical(l.database_side(), "rds"))
    ),
    "consolidated": _on(lambda l: elt.consolidate(l.store_side(), l.database_side())),
    "consolidated_io": _on(consolidated_io),
    "bounded_read": _on(bounded_read),
    "stage_counts": _on(lambda l: elt.stage_counts(l.merged)),
    "risk_high_tx": _on(lambda l: analysis.high_risk_tx(analysis.typed(l.consolidated))),
    "risk_high_tx_sql": _on(lambda l: analysis.high_risk_tx_sql(analysis.typed(l.consolidated))),
    "risk_cards": _on(lambda l: analysis.suspicious_cards(analysis.typed(l.consolidated))),
    "risk_cards_sql": _on(lambda l: analysis.suspicious_cards_sql(analysis.typed(l.consolidated))),
    "risk_geo": _on(lambda l: analysis.geo_patterns(analysis.typed(l.consolidated))),
    "risk_geo_sql": _on(lambda l: analysis.geo_patterns_sql(analysis.typed(l.consolidated))),
    "analysis_io": _on(analysis_io),
    "analysis_limits": _on(analysis_limits),
    "analysis_tables": _on(analysis_tables),
    "analysis_summary": _on(analysis_summary),
    "gold_export": _on(gold_export),
    "gold_export_all": _on(gold_export_all),
    "gold_export_first": _on(gold_export_first),
    "compaction": _on(compaction),
    "compaction_files": _on(compaction_files),
    "graph_staging": _on(lambda l: graph.staging(l.gold, "2024-01-01T01:00:00Z", "2024-01-01T04:00:00Z")),
    "graph_nodes": _on(graph_nodes),
    "graph_merchants": _on(lambda l: l.snapshot("full", (None, None)).nodes["merchants"]),
    "graph_payment_nodes": _on(lambda l: l.snapshot("full", (None, None)).nodes["payments"]),
    "graph_edges": _on(graph_edges),
    "graph_counts": _on(lambda l: graph.export_counts(graph.staging(l.gold))),
    "graph_csv_roundtrip": _on(graph_csv_roundtrip),
    "graph_csv_nodes": _on(graph_csv_nodes),
    "graph_csv_edges": _on(graph_csv_edges),
    "graph_upsert": _on(lambda l: l.store().nodes["payments"]),
    "graph_upsert_merchants": _on(lambda l: l.store().nodes["merchants"]),
    "graph_upsert_edges": _on(lambda l: _edge_rows(l.store().edges)),
    "graph_reload": _on(lambda l: _reloaded(l).nodes["payments"]),
    "graph_reload_edges": _on(lambda l: _edge_rows(_reloaded(l).edges)),
    "graph_store_reload": _on(lambda l: _reloaded_store(l).nodes["payments"]),
    "graph_store_reload_edges": _on(lambda l: _edge_rows(_reloaded_store(l).edges)),
    "graph_key_violations": _on(graph_key_violations),
    "graph_dangling_edges": _on(graph_dangling_edges),
    "graph_shared_devices": _on(lambda l: graph.shared_devices(l.stored_graph, "late")),
    "graph_shared_devices_all": _on(lambda l: graph.shared_devices(l.stored_graph)),
    "graph_multi_country_cards": _on(lambda l: graph.multi_country_cards(l.stored_graph, "late", 4)),
    "graph_multi_country_cards_all": _on(lambda l: graph.multi_country_cards(l.stored_graph)),
    "graph_risky_merchants": _on(lambda l: graph.risky_merchants(l.stored_graph, "late", 38, 48)),
    "graph_risky_merchants_all": _on(lambda l: graph.risky_merchants(l.stored_graph)),
    "graph_device_clusters": _on(lambda l: graph.device_clusters(l.stored_graph, "late")),
    "graph_device_clusters_all": _on(lambda l: graph.device_clusters(l.stored_graph)),
    "training_set": _on(lambda l: training.training_set(l.consolidated)),
    "training_text": _on(lambda l: training.labelled(l.gold).select("payment_id", feature_text().alias("text"))),
    "label_distribution": _on(lambda l: training.label_distribution(training.labelled(l.consolidated))),
    "train_eval_split": _on(train_eval_split),
    "binary_metrics": _on(binary_metrics_row),
    "classifier_metrics": _on(classifier_metrics),
    "classifier_split_sizes": _on(classifier_split_sizes),
    "classifier_eval_rows": _on(classifier_eval_rows),
}
