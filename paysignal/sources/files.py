"""Table and file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysignal.sinks.files import first_rows, time_of
from paysignal.sinks.tables import file_sizes


def read_table_or_path(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet folder if ``source`` looks like a path, else a catalog table."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_bounded(spark: SparkSession, path: str, max_files: int = 0, max_rows: int = 0,
                 order: tuple[str, ...] = ("event_time", "payment_id")) -> DataFrame:
    """For looking at a folder: the first ``max_files`` files by name and of those the
    first ``max_rows`` rows by time and key; 0 means no bound. No job computes on it.

    The last row wanted is found from counts per hour and second, so no task ranks all rows.
    """
    if max_files > 0:
        names = file_sizes(spark, path).select("path").orderBy("path").limit(max_files)
        chosen = [r.path for r in names.collect()]  # at most max_files names
        if not chosen:
            return spark.read.parquet(path)
        df = spark.read.option("basePath", path).parquet(*chosen)
    else:
        df = spark.read.parquet(path)
    if max_rows > 0:
        moment, *ties = [c for c in order if c in df.columns]
        df = first_rows(df, time_of(df, moment), ties, max_rows)
    return df
