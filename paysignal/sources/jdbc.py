"""JDBC table reads and writes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.schemas import FEATURE_COLUMNS, SHORT_EVENT_COLUMNS


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = ""

    def options(self) -> dict[str, str]:
        named = {"url": self.url, "dbtable": self.table, "user": self.user,
                 "password": self.password, "driver": self.driver}
        return {k: v for k, v in named.items() if v}


@dataclass(frozen=True)
class Slices:
    """Parallel read: ``count`` range queries over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.lower,
                "upperBound": self.upper, "numPartitions": str(self.count)}


def slices_over(spark: SparkSession, table: JdbcTable, column: str, count: int) -> Slices:
    """Slices between the least and the greatest value that the database reports for ``column``."""
    options = table.options()
    source = options.pop("dbtable")
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {source}"
    low, high = spark.read.format("jdbc").options(**options, query=query).load().head()
    if low is None:
        raise ValueError(f"no value of {column} to slice by")
    return Slices(column, str(low), str(high), count)


def read_jdbc(spark: SparkSession, table: JdbcTable, slices: Slices | None = None, fetch_size: int = 10000) -> DataFrame:
    options = {**table.options(), "fetchsize": str(fetch_size), **(slices.options() if slices else {})}
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, table: JdbcTable, mode: str = "overwrite", batch_size: int = 10000,
               connections: int = 16) -> None:
    """``overwrite`` empties and refills the table, keeping its definition; ``append`` adds rows.
    ``connections`` tasks write; what comes before them keeps its own parallelism."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode: {mode}")
    options = {**table.options(), "batchsize": str(batch_size), "numPartitions": str(connections)}
    if mode == "overwrite":
        options["truncate"] = "true"
    df.repartition(connections).write.format("jdbc").options(**options).mode(mode).save()


# Column types of the relational feature table.
_DOUBLE_COLUMNS = {"amount", "declined_ratio_1h"}


def jdbc_features(silver: DataFrame) -> DataFrame:
    """The 17 typed columns of the relational feature table; rows need a payment id."""

    def typed(name: str):
        if name == "event_time":
            return F.try_to_timestamp(F.col(name).cast("string")) if dict(silver.dtypes)[name] == "string" \
                else F.col(name).cast("timestamp")
        if name in _DOUBLE_COLUMNS:
            return F.col(name).try_cast("double")
        return F.col(name).try_cast("int" if name in FEATURE_COLUMNS else "string")

    columns = [*SHORT_EVENT_COLUMNS, *FEATURE_COLUMNS]
    return silver.select(*[typed(c).alias(c) for c in columns]).dropna(subset=["payment_id"])
