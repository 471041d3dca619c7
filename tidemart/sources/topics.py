"""Topic readers. A topic is a stream (or table) of text lines in a column ``value``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# position is a line's place in its topic; where files have none, the line itself must name one.
LINES = "topic string, value string, position bigint"
OFFSET_BITS = 48


def broker_options(servers: str, topics: Sequence[str], group: str,
                   max_offsets: int | None = None) -> dict[str, str]:
    """Reader options: new records only, committed records only, several topics in one reader."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "groupIdPrefix": group,
        "startingOffsets": "latest",
        "kafka.isolation.level": "read_committed",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_broker(spark: SparkSession, servers: str, topics: Sequence[str], group: str,
                max_offsets: int | None = None) -> DataFrame:
    """Broker topics as (topic, value, position). The connector is a package the cluster adds."""
    reader = spark.readStream.format("kafka").options(**broker_options(servers, topics, group, max_offsets))
    return broker_lines(reader.load())


def broker_lines(records: DataFrame) -> DataFrame:
    """(topic, value, position) of broker records; partition and offset are packed into one position."""
    place = F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS) + F.col("offset")
    return records.select("topic", F.col("value").cast("string").alias("value"), place.alias("position"))


def read_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same shape from a folder of parquet files partitioned by topic."""
    reader = spark.readStream.schema(LINES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path).select("topic", "value", "position")


def by_topic(lines: DataFrame, topics: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per topic; for files the filter is a partition filter."""
    return {name: lines.where(F.col("topic") == name).drop("topic") for name in topics}
