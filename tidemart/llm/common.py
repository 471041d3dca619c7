"""What the operators of this subpackage share: table access, word rules, folds, batch sizes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters that are not white space; an empty array for a null text."""
    parts = F.filter(F.split(text, SPACE_RUN), lambda w: w != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def computed(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with columns that later filters do not move: a generator of one row stands between.

    A filter on a column of a projection is pushed below it with the column's expression in its place, and
    an array that a lambda reads would then be made anew for each of its elements.
    """
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; labels are learned only where it is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def arrow_rows(spark: SparkSession, rows: int = 256) -> None:
    """Rows in one Arrow batch: few, because a text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def broadcast_if_small(ids: DataFrame, most: int = 2_000_000) -> DataFrame:
    """A table of ids, broadcast if counted at most ``most`` (32 MB); beyond that joins shuffle."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """The schema with ``fields`` at its end; fields of the same name are replaced."""
    names = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(fields))


def with_arrays(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with ``more`` columns at its end; columns of the same name are replaced."""
    kept = {n: batch.column(n) for n in batch.schema.names if n not in more}
    return pa.RecordBatch.from_pydict({**kept, **more})


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents outside the held-out third.

    The ids are picked by a hash, so every run picks the same; as there are at most ``rows``, they are
    broadcast. A document with several labels has the largest; repeated rows count once.
    """
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1))
    picked = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
