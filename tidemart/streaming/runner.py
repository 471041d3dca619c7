"""Running a streaming job: continuously, or in rounds over newly landed files."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemart.session import STREAM_SETTINGS, release, settings, shared_dir
from tidemart.sources.topics import by_topic, read_files

Job = Callable[[dict[str, DataFrame]], DataFrame]
# Lines repeat their field names; every line of a replay is written twice.
LINES_CODEC = "zstd"


class Feed(NamedTuple):
    """Lines of one topic with their time, and a far-future line that closes all real windows."""

    lines: DataFrame  # ts bigint (ms), value string
    closing: str | None = None


Batch = Callable[[DataFrame, int], None]


def file_sink(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append to a folder exactly once."""
    return (stream.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint))


def batch_sink(stream: DataFrame, write: Batch, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Hand each batch to a function; it may see a batch again after a failure."""
    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint))


def console_sink(stream: DataFrame, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Print a few rows of each batch."""
    return (stream.writeStream.outputMode(mode).format("console").option("truncate", "false")
            .option("checkpointLocation", checkpoint))


def start(writer: DataStreamWriter, every: str = "3 seconds") -> StreamingQuery:
    """Run for good."""
    return writer.trigger(processingTime=every).start()


def catch_up(writer: DataStreamWriter) -> None:
    """Process everything that has arrived since the last run, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def stage(spark: SparkSession, base: str, feeds: Mapping[str, Feed]) -> DataFrame:
    """All feeds as one table (topic, ts, value), computed once."""
    parts = [feed.lines.select(F.lit(name).alias("topic"), F.col("ts").cast("bigint").alias("ts"), "value")
             for name, feed in feeds.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every.write.mode("overwrite").option("compression", LINES_CODEC).partitionBy("topic").parquet(f"{base}/staged")
    release(spark)
    return spark.read.schema("ts bigint, value string, topic string").parquet(f"{base}/staged")


def round_bounds(staged: DataFrame, rounds: int) -> list[int]:
    """Times that cut the staged span into equal rounds."""
    low, high = staged.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return []
    step = max((high - low) // rounds, 1)
    return [low + step * i for i in range(1, rounds)]


def replay(spark: SparkSession, name: str, feeds: Mapping[str, Feed], job: Job, *,
           rounds: int = 2, shuffle_ms: int = 0, partitions: int | None = None) -> DataFrame:
    """Feed a job round by round, each round a new run from the same checkpoint; return its output.

    ``partitions`` is the number of state partitions, fixed by the first run: by default the session's.

    ``shuffle_ms`` moves rows by up to that time towards the next round, so that they arrive late.
    """
    base = shared_dir(spark, name)
    schema = None

    def run(topics: dict[str, DataFrame]) -> None:
        nonlocal schema
        stream = job(topics)
        schema = stream.schema
        catch_up(file_sink(stream, f"{base}/out", f"{base}/checkpoint"))

    feed_rounds(spark, base, feeds, run, rounds, shuffle_ms, partitions)
    return spark.read.schema(schema).parquet(f"{base}/out")


def replay_batches(spark: SparkSession, name: str, feeds: Mapping[str, Feed], job: Job,
                   write: Callable[[str], Batch], *, mode: str = "append", rounds: int = 2,
                   partitions: int | None = None) -> str:
    """The same with a batch function, made by ``write`` for the output folder that is returned."""
    base = shared_dir(spark, name)
    out = f"{base}/out"

    def run(topics: dict[str, DataFrame]) -> None:
        catch_up(batch_sink(job(topics), write(out), f"{base}/checkpoint", mode))

    feed_rounds(spark, base, feeds, run, rounds, partitions=partitions)
    return out


def feed_rounds(spark: SparkSession, base: str, feeds: Mapping[str, Feed],
                run: Callable[[dict[str, DataFrame]], None], rounds: int, shuffle_ms: int = 0,
                partitions: int | None = None) -> None:
    landing = f"{base}/landing"
    staged = stage(spark, base, feeds)
    arrival = F.col("ts") + (F.pmod(F.xxhash64("value"), F.lit(shuffle_ms)) if shuffle_ms else F.lit(0))
    edges = round_bounds(staged, rounds)
    number = F.lit(0)
    for edge in edges:
        number = number + (arrival >= edge).cast("int")
    numbered = staged.withColumn("_round", number)
    closing = [(topic, feed.closing) for topic, feed in feeds.items() if feed.closing]
    values = dict(STREAM_SETTINGS)
    if partitions:
        values["spark.sql.shuffle.partitions"] = str(partitions)
    with settings(spark, {k: v for k, v in values.items() if spark.conf.isModifiable(k)}):
        for i in range(len(edges) + 1):
            land(numbered.where(F.col("_round") == i), landing)
            if i == len(edges) and closing:
                land(spark.createDataFrame(closing, "topic string, value string"), landing)
            run(by_topic(read_files(spark, landing), list(feeds)))
            # The shuffles of a round are not needed by the next one.
            release(spark)


def land(lines: DataFrame, landing: str) -> None:
    (lines.select("value", "topic").write.mode("append").option("compression", LINES_CODEC)
     .partitionBy("topic").parquet(landing))
