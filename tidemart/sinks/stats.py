"""Statistics writers: fixed column list, no helper columns, one partition per day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.dashboard import with_day

JDBC_BATCH = 1024


def columns_of(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    return stats.select(*columns)


def write_table(stats: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the days present in ``stats``.

    Days are dealt over the tasks by hash, so few files are made and no task opens those of all sparse days; AQE
    splits a heavy day. Ranges would have the rows computed once more to sample them.
    """
    daily = with_day(columns_of(stats, columns))
    (daily.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(path))


def table_writer(stats: DataFrame, path: str, checkpoint: str, columns: Sequence[str]) -> DataStreamWriter:
    """Closed windows appended exactly once."""
    return (with_day(columns_of(stats, columns)).writeStream.format("parquet").outputMode("append")
            .partitionBy("dt").option("path", path).option("checkpointLocation", checkpoint))


def jdbc_batch(url: str, table: str, columns: Sequence[str], driver: str,
               writers: int = 16, **options: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append the columns to a database table over at most ``writers`` links."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (columns_of(batch, columns).write.format("jdbc").mode("append")
         .option("url", url).option("dbtable", table).option("driver", driver)
         .option("batchsize", str(JDBC_BATCH)).option("numPartitions", str(writers))
         .options(**options).save())
    return write


def upsert_batch(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` in update mode: each batch keeps its changed rows in its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write
