"""Table readers: dimensions, statistics tables, databases, and SQL with arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.cdc import latest_rows

BATCH = "batch_id"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table whose zone-less timestamps become timestamps of the session's zone."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoned = [f.name for f in table.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    if not zoned:
        return table
    return table.selectExpr(*[f"CAST({c} AS TIMESTAMP) AS {c}" if c in zoned else c for c in table.columns])


def read_dim(spark: SparkSession, path: str, table: str, columns: Sequence[str]) -> DataFrame:
    """Current rows of a dimension written by ``sinks.dims``: the last row of each key."""
    rows = spark.read.parquet(path).where(F.col("sink_table") == table)
    last = latest_rows(rows, ["sink_table", "key"], [BATCH, "ts", "xid", "xoffset"])
    return last.select(*[F.col("data")[c].alias(c) for c in columns])


def read_upserts(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Current rows of a table written by ``sinks.stats.upsert_batch``."""
    return latest_rows(spark.read.parquet(path), key, [BATCH]).drop(BATCH)


def read_stats(spark: SparkSession, path: str, day_from: int | None = None,
               day_to: int | None = None) -> DataFrame:
    """A statistics table; the days select partitions before any file is opened."""
    stats = spark.read.parquet(path)
    if day_from is not None:
        stats = stats.where(F.col("dt") >= day_from)
    if day_to is not None:
        stats = stats.where(F.col("dt") <= day_to)
    return stats


def run_sql(spark: SparkSession, text: str, args: Sequence | None = None,
            **tables: DataFrame) -> DataFrame:
    """SQL with ``?`` arguments; ``tables`` are named as ``{name}`` in the text."""
    return spark.sql(text, args=list(args or []), **tables)


def read_database(spark: SparkSession, url: str, query: str, driver: str, *,
                  split_on: str | None = None, low: int | None = None, high: int | None = None,
                  parts: int = 64, **options: str) -> DataFrame:
    """A query in a database. With ``split_on`` (a number column) executors read ranges in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("driver", driver).options(**options)
    if split_on is None:
        return reader.option("query", query).load()
    return (reader.option("dbtable", f"({query}) t").option("partitionColumn", split_on)
            .option("lowerBound", str(low)).option("upperBound", str(high))
            .option("numPartitions", str(parts)).load())
