"""Log cleaning: parsing lines, splitting by kind, and the selections made on page logs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.texts import is_blank, words
from tidemart.functions.times import at_millis, at_second
from tidemart.schemas import PAGE_LOG


class LogStreams(NamedTuple):
    start: DataFrame
    page: DataFrame
    display: DataFrame


def parse_lines(lines: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """JSON text to columns, beside the columns in ``keep``; missing keys are null.

    ``inline`` keeps later filters above the parser. As a plain projection they would be pushed below
    it, with one more parse of the line for every column they name. A record's ``rec_id`` is the position
    that the reader gives it; only without one the line's own field counts.
    """
    record = F.from_json("value", schema)
    if "position" in lines.columns and "rec_id" in schema.fieldNames():
        rows = lines.select("position", *keep, F.inline(F.array(record)))
        return rows.withColumn("rec_id", F.coalesce("position", "rec_id")).drop("position")
    return lines.select(*keep, F.inline(F.array(record)))


def with_known_id(log: DataFrame) -> DataFrame:
    """The same rows; one without ``rec_id`` is an error, because nothing would ever match it."""
    missing = F.raise_error(F.lit("a record has no rec_id: read it with its position in the topic"))
    return log.withColumn("rec_id", F.coalesce("rec_id", missing.cast("long")))


def log_table(lines: DataFrame, schema: T.StructType = PAGE_LOG, delay: str | None = None) -> DataFrame:
    """Log lines as a table with whole-second event time ``et`` and, for a stream, its watermark."""
    log = parse_lines(lines, schema).withColumn("et", at_second(F.col("ts")))
    return log.withWatermark("et", delay) if delay else log


def with_event_time(rows: DataFrame, delay: str | None = None, ms: str = "ts") -> DataFrame:
    timed = rows.withColumn("et", at_millis(F.col(ms)))
    return timed.withWatermark("et", delay) if delay else timed


def entry_page() -> Column:
    """True on the page that opens a session."""
    return is_blank(F.col("page.last_page_id"))


def split_log(log: DataFrame) -> LogStreams:
    """Start records, page records and single displays. A record can give a page and displays."""
    running = log.where(F.col("start").isNull())
    return LogStreams(
        start=log.where(F.col("start").isNotNull()),
        page=running.where(F.col("page").isNotNull()),
        display=explode_displays(running))


def _display_fields(log: DataFrame, display: str) -> dict[str, str]:
    """SQL of each display column. A common field wins a name clash, then ts and page_id."""
    own = log.schema["displays"].dataType.elementType.fieldNames()
    common = log.schema["common"].dataType.fieldNames()
    fields = {c: f"{display}.`{c}`" for c in own}
    fields |= {"ts": "ts", "page_id": "page.page_id"}
    return fields | {c: f"common.`{c}`" for c in common}


def explode_displays(log: DataFrame) -> DataFrame:
    """One row per display with ts, page_id and the common fields."""
    fields = _display_fields(log, "_d")
    each = log.where(F.col("start").isNull()).select("common", "ts", "page", F.explode("displays").alias("_d"))
    return each.selectExpr(*[f"{sql} AS `{name}`" for name, sql in fields.items()])


def split_lines(log: DataFrame) -> DataFrame:
    """The same split as (topic, value) lines of all three kinds, in one pass over the log."""
    record = ", ".join(f"'{c}', {c}" for c in log.columns)
    shown = ", ".join(f"'{name}', {sql}" for name, sql in _display_fields(log, "d").items())
    whole = f"to_json(named_struct({record}))"
    nothing = "CAST(array() AS array<struct<topic:string,value:string>>)"
    return log.selectExpr(f"""inline(CASE
        WHEN start IS NOT NULL THEN array(named_struct('topic', 'dwd_start_log', 'value', {whole}))
        ELSE concat(
            CASE WHEN page IS NOT NULL
                THEN array(named_struct('topic', 'dwd_page_log', 'value', {whole})) ELSE {nothing} END,
            coalesce(transform(displays, d -> named_struct(
                'topic', 'dwd_display_log', 'value', to_json(named_struct({shown})))), {nothing})) END)""")


def session_entries(page: DataFrame) -> DataFrame:
    return page.where(entry_page())


def product_clicks(page: DataFrame) -> DataFrame:
    """Visits of a product's detail page."""
    return page.where(F.col("page.page_id") == "good_detail").select(
        F.col("page.item").try_cast("bigint").alias("sku_id"), "ts")


def product_displays(display: DataFrame) -> DataFrame:
    return display.where(F.col("item_type") == "sku_id").select(
        F.col("item").try_cast("bigint").alias("sku_id"), "ts")


def searches(page: DataFrame) -> DataFrame:
    """Texts typed into the search page."""
    return page.where(F.col("page.item").isNotNull() & (F.col("page.page_id") == "good_list")).select(
        F.col("page.item").alias("kw"), "et")


def search_words(page: DataFrame) -> DataFrame:
    """One row per distinct word of each search; searches without a word vanish."""
    return searches(page).select("kw", "et", F.explode(words(F.col("kw"))).alias("word"))
