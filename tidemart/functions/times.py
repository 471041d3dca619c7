"""Date and time expressions. Epoch values are milliseconds, as in the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATETIME = "yyyy-MM-dd HH:mm:ss"
DAY_MS = 86_400_000


def floor_div(value: Column, step: int) -> Column:
    """Whole quotient rounded down, for values below 2^52 (every epoch time in milliseconds)."""
    return F.floor(value / F.lit(step))


def at_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def at_second(ms: Column) -> Column:
    """Timestamp cut to whole seconds."""
    return F.timestamp_seconds(floor_div(ms, 1000))


def parse_datetime(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as timestamp, null when it does not parse.

    A cast costs a tenth of a pattern-based parse; the shape test keeps other notations out.
    """
    return F.when(text.like("____-__-__ __:__:__"), text.try_cast("timestamp"))


def to_millis(text: Column) -> Column:
    return F.unix_millis(parse_datetime(text))


def event_time(rows: DataFrame, text: str = "create_time") -> Column:
    """A record's time: ``et`` or ``create_ts`` where its parser already made one, else from text."""
    if "et" in rows.columns:
        return F.col("et")
    if "create_ts" in rows.columns:
        return at_millis(F.col("create_ts"))
    return parse_datetime(F.col(text))


def now_ms(as_of_ms: int | None = None) -> Column:
    """Whole seconds of the current time in milliseconds (per micro-batch in a stream), or a given time."""
    if as_of_ms is None:
        return F.unix_timestamp() * 1000
    return F.lit(as_of_ms).cast("bigint")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, DATETIME)


def create_date(text: Column) -> Column:
    return F.substring(text, 1, 10)


def create_hour(text: Column) -> Column:
    return F.substring(text, 12, 2)


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days between the birthday's midnight and ``as_of`` (cut towards zero).

    A missing or unreadable birthday gives null.
    """
    days = (F.unix_millis(as_of) - F.unix_millis(birthday.try_cast("timestamp"))) / DAY_MS
    years = days / 365
    return F.when(years < 0, F.ceil(years)).otherwise(F.floor(years)).cast("int")


def day_number(text: Column) -> Column:
    """``yyyyMMdd`` as int, from a date-time text."""
    return F.translate(F.substring(text, 1, 10), "-", "").cast("int")


def hour_label(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def day_or_today(date: int | None) -> Column:
    """The asked day as ``yyyyMMdd``; 0 or nothing means today (calendar year, not week year)."""
    if date:
        return F.lit(int(date))
    return F.date_format(F.current_date(), "yyyyMMdd").cast("int")
