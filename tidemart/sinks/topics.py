"""Topic writers: lines to one topic, or each line to the topic named in its row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.functions.texts import to_lines


def topic_lines(rows: DataFrame, topic: str) -> DataFrame:
    return to_lines(rows).select(F.lit(topic).alias("topic"), "value")


def routed_lines(routed: DataFrame) -> DataFrame:
    """Bodies of routed changes, each for the topic its route names."""
    return routed.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))


def broker_writer(lines: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """To a broker, at least once: after a failure a batch's lines may be sent again."""
    return (lines.select("topic", "value").writeStream.format("kafka").outputMode("append")
            .option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint))


def file_writer(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """To parquet files partitioned by topic, exactly once."""
    return (lines.select("topic", "value").writeStream.format("parquet").outputMode("append")
            .partitionBy("topic").option("path", path).option("checkpointLocation", checkpoint))
