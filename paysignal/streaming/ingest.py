"""Streaming ingest of JSON payment messages into the Bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from paysignal.functions.columns import period
from paysignal.schemas import EVENT_SCHEMA
from paysignal.sinks.tables import BATCH_COLUMN, table_location


def message_stream(
    spark: SparkSession,
    source_format: str = "kafka",
    *,
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str = "payments",
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """An unbounded stream with a ``value`` column, from Kafka or from text files."""
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"unsupported start: {starting_offsets}")
    reader = spark.readStream
    if source_format == "kafka":
        reader = reader.format("kafka").options(
            **{
                "kafka.bootstrap.servers": bootstrap_servers,
                "subscribe": topic,
                "startingOffsets": starting_offsets,
                "failOnDataLoss": str(fail_on_data_loss).lower(),
            }
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if starting_offsets != "earliest":
        raise ValueError("a file stream always starts at the earliest file")
    reader = reader.format(source_format).option("ignoreMissingFiles", str(not fail_on_data_loss).lower())
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path)


def parse_messages(messages: DataFrame, schema: StructType = EVENT_SCHEMA, strict: bool = True) -> DataFrame:
    """Typed columns from JSON; works on batches and streams alike.

    ``strict`` drops messages without a payment id, which includes corrupt ones;
    otherwise a corrupt message becomes a row of nulls.
    """
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("payload")).select("payload.*")
    return parsed.filter(F.col("payment_id").isNotNull()) if strict else parsed


def bronze_rows(messages: DataFrame, schema: StructType = EVENT_SCHEMA, strict: bool = True) -> DataFrame:
    return parse_messages(messages, schema, strict).withColumn("ingestion_ts", F.current_timestamp())


def start_ingest(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    *,
    drain: bool = False,
    interval_seconds: int = 5,
    query_name: str = "bronze_payments_stream",
) -> StreamingQuery:
    """Append ``rows`` to ``table``. ``drain`` processes what is there and stops;
    otherwise micro-batches run every ``interval_seconds``. A restart with the
    same checkpoint continues where the last run ended."""
    writer = (
        rows.writeStream.outputMode("append")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.toTable(table)


def by_day_schema(schema: StructType) -> StructType:
    """``schema`` with the partition columns of a table that ``start_ingest_by_day`` fills."""
    return StructType([*schema.fields, StructField("event_date", DateType()), StructField(BATCH_COLUMN, LongType())])


def append_batch(batch: DataFrame, batch_id: int, table: str) -> None:
    """Store a micro-batch as the partitions (event date, batch) of ``table``. A batch that is delivered again replaces
    itself. Rows whose time does not parse have no date."""
    spark = batch.sparkSession
    dated = batch.withColumn("event_date", period(F.try_to_timestamp("event_time"), "day")).withColumn(
        BATCH_COLUMN, F.lit(batch_id).cast("long"))
    parts = ("event_date", BATCH_COLUMN)
    writer = dated.select(*spark.table(table).columns).hint("rebalance", *parts).write.partitionBy(*parts)
    # the place is asked for every batch: compaction moves the table to a new one
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table_location(spark, table))
    spark.catalog.refreshTable(table)


def start_ingest_by_day(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    *,
    drain: bool = False,
    interval_seconds: int = 5,
    query_name: str = "bronze_payments_by_day",
) -> StreamingQuery:
    """As ``start_ingest``, into a table made by ``ensure_table`` with ``by_day_schema``, which may be compacted."""
    writer = (
        rows.writeStream.outputMode("append")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, table))
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()


def batch_sizes(query: StreamingQuery) -> dict[int, int]:
    """Messages per batch that had any, as the running or stopped query reports them (the last 100 or so batches)."""
    return {p.batchId: p.numInputRows for p in query.recentProgress if p.numInputRows > 0}


def supervise(query: StreamingQuery, timeout_seconds: int = 0) -> None:
    """Wait for the query to end, or stop it cleanly after ``timeout_seconds``.
    A failed query raises."""
    if timeout_seconds > 0:
        finished = query.awaitTermination(timeout_seconds)
        if not finished:
            query.stop()
    else:
        query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise RuntimeError(f"ingest stopped with an error: {failure}")
