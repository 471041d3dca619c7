"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{N}]+)"
BOOTSTRAP = "bootstrap-"


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def not_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def words(text: Column) -> Column:
    """Distinct lower-case words of the whole text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1)))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def in_list(csv: Column, item: Column) -> Column:
    return F.array_contains(F.split(csv, ","), item)


def plain_type(change_type: Column) -> Column:
    """Operation type without the snapshot prefix."""
    return F.regexp_replace(change_type, BOOTSTRAP, "")


def cache_key(table: Column, key: Column) -> Column:
    return F.concat_ws(":", F.upper(table), key.cast("string"))


def to_lines(rows: DataFrame, *keep: str) -> DataFrame:
    """Each row as one JSON text ``value``; columns in ``keep`` stay beside it."""
    return rows.select(*keep, F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value"))
