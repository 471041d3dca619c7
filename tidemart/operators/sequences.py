"""Per-device sequence operators on tables: new-visitor repair, first visit of a day, bounces.

None of them brings all records of one device into one task, because a single device (a shared or
broken client id) may hold a large part of the log:

* first records come from a map-side combined aggregate, one small row per device and task;
* the flag goes back to the log by record id, which spreads evenly;
* bounces are a pattern of two steps within a time limit (``operators/patterns.py``), which cuts a
  device's records by time, and further by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import at_millis
from tidemart.operators import patterns
from tidemart.operators.logs import entry_page, with_known_id
from tidemart.operators.patterns import CHUNK_ROWS, TIMEOUT, Pattern


def device() -> Column:
    return F.col("common.mid")


def repair_is_new(log: DataFrame) -> DataFrame:
    """``common.is_new`` becomes 1 on a device's earliest record and 0 on all its others.

    ``rec_id`` must be unique and is never null; the earliest record is the least (ts, rec_id).
    """
    log = with_known_id(log)
    first = (log.groupBy(device().alias("_mid"))
             .agg(F.min(F.struct("ts", "rec_id")).alias("_first"))
             .select("_mid", F.col("_first.rec_id").alias("_rec")))
    flagged = log.join(first, (F.col("rec_id") == F.col("_rec")) & (device() == F.col("_mid")), "left")
    is_new = F.when(F.col("_rec").isNotNull(), "1").otherwise("0")
    return flagged.withColumn("common", F.col("common").withField("is_new", is_new)).select(*log.columns)


def daily_first_visit(page: DataFrame) -> DataFrame:
    """The earliest record of each device on each calendar day of the session's time zone."""
    day = calendar_day(F.col("ts"))
    return (page.groupBy(device().alias("_mid"), day.alias("_day"))
            .agg(F.min_by(F.struct(*page.columns), F.struct("ts", "rec_id")).alias("_r"))
            .select("_r.*"))


def calendar_day(ms: Column) -> Column:
    return F.to_date(at_millis(ms))


def bounces(page: DataFrame, limit_ms: int = 5000, *, entry_after_entry: bool = True,
            slice_ms: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Entry pages whose visitor left: no next page of the device within ``limit_ms``.

    An entry followed by another entry inside the limit is a bounce too, unless
    ``entry_after_entry`` is off. A gap of exactly the limit is a bounce.
    """
    found = patterns.detect(page, bounce_pattern(limit_ms, entry_after_entry), device(), slice_ms=slice_ms,
                            chunk_rows=chunk_rows)
    return bounced(found, entry_after_entry).select("record.*")


def bounce_pattern(limit_ms: int, entry_after_entry: bool = True) -> Pattern:
    """An entry and the page right after it: another entry, or any page."""
    second = entry_page() if entry_after_entry else F.lit(True)
    return Pattern.begin("entry", entry_page()).next("second", second).within(limit_ms)


def bounced(found: DataFrame, entry_after_entry: bool = True) -> DataFrame:
    """Timeouts, and matches where a second entry counts."""
    return found if entry_after_entry else found.where(F.col("outcome") == TIMEOUT)
