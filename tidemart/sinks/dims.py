"""Dimension writer: every batch appends its last rows per key; readers take the last per key.

A batch only writes its own folder and rewrites it when it is run again, so a restart neither loses
nor repeats rows, and the cost of a batch does not grow with the dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.texts import text_or_empty
from tidemart.operators.cdc import latest_rows

POSITION = ["ts", "xid", "xoffset"]


def key_columns() -> Column:
    """Names of the route's key columns; ``id`` where it names none."""
    return F.split(F.coalesce("sink_pk", F.lit("id")), ",")


def dim_records(routed: DataFrame) -> DataFrame:
    """Routed changes as (table, key, configured columns as text, position)."""
    names = F.split("sink_columns", ",")
    body = F.map_from_arrays(names, F.transform(names, lambda c: text_or_empty(F.col("data")[c])))
    key = F.transform(key_columns(), lambda c: text_or_empty(F.col("data")[c]))
    return routed.select("sink_table", key.alias("key"), body.alias("data"), *POSITION)


def write_batch(routed: DataFrame, path: str, batch_id: int) -> None:
    last = latest_rows(dim_records(routed), ["sink_table", "key"], POSITION)
    last.write.mode("overwrite").partitionBy("sink_table").parquet(f"{path}/batch_id={batch_id}")


def compact(stored: DataFrame, path: str) -> None:
    """All batches of ``stored`` as one first batch in a new place."""
    last = latest_rows(stored, ["sink_table", "key"], ["batch_id", *POSITION]).drop("batch_id")
    last.write.mode("error").partitionBy("sink_table").parquet(f"{path}/batch_id=0")
