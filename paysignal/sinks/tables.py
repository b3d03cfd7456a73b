"""Creating, replacing and compacting tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paysignal.functions.columns import PERIODS, is_timestamp, period
from paysignal.session import stage

log = logging.getLogger(__name__)

DEFAULT_FILE_BYTES = 64 * 1024 * 1024
BATCH_COLUMN = "ingest_batch"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _in_session_catalog(name: str) -> bool:
    parts = name.split(".")
    return len(parts) < 3 or parts[0] == "spark_catalog"


def ensure_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None,
                 provider: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Create the namespace and an empty table unless they exist. The partitions of a partitioned table are those found
    below its location, so that a new location brings its own."""
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{location}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    with _setting(spark, _TRACKED, "false"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING {provider}{parts}{place}")


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Make ``name`` hold exactly ``df``; readers see the old or the new version.

    A catalog with atomic replace does it itself. In the session catalog the new
    version goes to a fresh folder first and the table is then pointed at it, so
    the plan may read the table it replaces.
    """
    spark = df.sparkSession
    if not _in_session_catalog(name):
        df.writeTo(name).createOrReplace()
        return spark.table(name)
    point_table_at(spark, name, write_version(df, name), df.schema)
    return spark.table(name)


def replace_by_period(df: DataFrame, name: str, time_column: str = "event_time", unit: str = "day",
                      keep_versions: int = 0) -> DataFrame:
    """As ``replace_table``, laid out by the day or hour of ``time_column`` in files sorted by it, so that a range of time
    reads the files of that range. The partition column comes last. With ``keep_versions`` older versions go."""
    spark, column = df.sparkSession, PERIODS[unit][0]
    moment = F.col(time_column) if is_timestamp(df, time_column) else F.try_to_timestamp(time_column)
    dated = df.drop(column).withColumn(column, period(moment, unit))
    if not _in_session_catalog(name):
        dated.sortWithinPartitions(column, time_column).writeTo(name).partitionedBy(F.col(column)).createOrReplace()
        return spark.table(name)
    path = version_path(spark, name)
    dated.hint("rebalance", column).sortWithinPartitions(column, time_column).write.partitionBy(column).parquet(path)
    point_table_at(spark, name, path, dated.schema, (column,))
    if keep_versions:
        drop_versions(spark, name, keep_versions)
    return spark.table(name)


def overwrite_periods(df: DataFrame, name: str, time_column: str = "event_time", unit: str = "day") -> DataFrame:
    """Replace only the days or hours that ``df`` has rows of; the files of all others stay as they are. ``df`` may be
    derived from the table. Whoever reads the replaced periods meanwhile has to read again."""
    spark, column = df.sparkSession, PERIODS[unit][0]
    moment = F.col(time_column) if is_timestamp(df, time_column) else F.try_to_timestamp(time_column)
    order = spark.table(name).columns
    staged = stage(df.withColumn(column, period(moment, unit)).select(*order), "periods")
    dated = staged.hint("rebalance", column).sortWithinPartitions(column, time_column)
    dynamic = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
    dynamic.parquet(table_location(spark, name))
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}")
    wanted = described.filter("col_name IN ('Location', 'Provider', 'Partition Provider')")
    return {r.col_name: r.data_type for r in wanted.collect()}


def table_location(spark: SparkSession, name: str) -> str:
    return _facts(spark, name)["Location"]


def drop_versions(spark: SparkSession, name: str, keep: int) -> int:
    """Remove the folders of old versions of ``name`` but the ``keep`` newest; the one in use always stays. Returns how many
    went. Readers of a removed version fail, so keep as many as may still be read."""
    current = table_location(spark, name).rstrip("/").rpartition("/")[2]
    root = spark._jvm.org.apache.hadoop.fs.Path(version_path(spark, name)).getParent()
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return 0
    folders = sorted(store.listStatus(root), key=lambda f: (f.getPath().getName() == current, f.getModificationTime()), reverse=True)
    old = [f.getPath() for f in folders[max(keep, 1) :] if f.isDirectory()]
    for path in old:
        store.delete(path, True)
    return len(old)


def version_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a version of table ``name``, below the warehouse: checkpoints may be cleared."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/versions/{name.replace('.', '/')}/{uuid.uuid4().hex}"


def write_version(df: DataFrame, name: str) -> str:
    """Write a new version of table ``name`` to a fresh folder; returns the folder.
    Earlier versions stay until somebody removes them, so running readers finish."""
    path = version_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def point_table_at(spark: SparkSession, name: str, path: str, schema: StructType, partition_by: tuple[str, ...] = ()) -> None:
    """Point the external Parquet table ``name`` at the finished folder ``path``."""
    same = spark.catalog.tableExists(name) and [
        (f.name, f.dataType) for f in spark.table(name).schema
    ] == [(f.name, f.dataType) for f in schema] and partition_columns(spark, name) == partition_by
    if same:
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        ensure_table(spark, name, schema, path, partition_by=partition_by)
    spark.catalog.refreshTable(name)


def partition_columns(spark: SparkSession, name: str) -> tuple[str, ...]:
    return tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)


def table_as_select(df: DataFrame, name: str, path: str, mode: str = "errorifexists") -> None:
    """CTAS into an external Parquet folder."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the data files below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").filter(F.col("path").endswith(".parquet"))


def compact_folder(spark: SparkSession, source: str, target: str, file_bytes: int = DEFAULT_FILE_BYTES,
                   partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Rewrite the Parquet files of ``source`` as files of about ``file_bytes``.

    Without partition columns the scan itself packs small files (and splits big
    ones) into read partitions of the wanted size, each becoming one output
    file: no shuffle. With them, rows are rebalanced by partition value, where a
    big value is split over several tasks.
    """
    packed = spark.newSession()
    packed.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    packed.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    packed.conf.set("spark.sql.files.openCostInBytes", "0")
    packed.conf.set("spark.sql.files.minPartitionNum", "1")
    packed.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
    rows = packed.read.parquet(source)
    if partition_by:
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(target)
    else:
        rows.write.parquet(target)
    return spark.read.parquet(target)


def _is_stream_sink(spark: SparkSession, location: str) -> bool:
    """A folder written by a file stream lists its valid files in a log of its own."""
    try:
        spark.read.format("binaryFile").load(f"{location}/_spark_metadata")
        return True
    except AnalysisException:
        return False


def _files_digest(spark: SparkSession, path: str) -> tuple:
    """Number, bytes and a hash of the names of the data files below ``path``."""
    names = F.bit_xor(F.xxhash64("path", "length"))
    return tuple(file_sizes(spark, path).agg(F.count(F.lit(1)), F.sum("length"), names).head())


def _compact_partitions(table: DataFrame, target: str, parts: tuple[str, ...], file_bytes: int) -> None:
    rows = table
    if BATCH_COLUMN in parts:
        last = table.agg(F.max(BATCH_COLUMN)).first()[0]
        rows = table.withColumn(BATCH_COLUMN, F.when(F.col(BATCH_COLUMN) < last, F.lit(-1)).otherwise(F.col(BATCH_COLUMN)).cast("long"))
    with _setting(table.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes)):
        rows.hint("rebalance", *parts).write.partitionBy(*parts).parquet(target)


def compact_table(spark: SparkSession, name: str, file_bytes: int = DEFAULT_FILE_BYTES) -> bool:
    """Compact a Parquet table, a partitioned one partition by partition. A refusal or a query error is logged
    and leaves the table as it was. Refused are other providers, which have a
    procedure of their own; tables whose partitions the catalog lists; the target of a file stream, because the
    stream would go on with its old file log; and a table whose files changed meanwhile. The batches of a
    ``by_day`` stream become one, but for the last, which may be delivered again."""
    try:
        facts = _facts(spark, name)
        if facts.get("Provider", "").lower() != "parquet":
            raise ValueError("not a Parquet table, use the rewrite procedure of its catalog")
        location = facts["Location"]
        if facts.get("Partition Provider") == "Catalog":
            raise ValueError("the catalog lists its partitions, compact its folder with partition_by")
        parts = partition_columns(spark, name)
        if _is_stream_sink(spark, location):
            raise ValueError("the table is written by a stream")
        target = version_path(spark, name)
        schema = spark.table(name).schema
        before = _files_digest(spark, location)
        if parts:
            _compact_partitions(spark.table(name), target, parts, file_bytes)
        else:
            compact_folder(spark, location, target, file_bytes)
        if _files_digest(spark, location) != before:
            raise ValueError("files were added or removed meanwhile")
        point_table_at(spark, name, target, schema, parts)
        return True
    except (ValueError, PySparkException) as error:  # compaction is optional maintenance
        log.warning("compaction of %s skipped: %s", name, error)
        return False
