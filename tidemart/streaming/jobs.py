"""Streaming jobs. Each takes topic lines (frames with a ``value`` column) and returns a frame.

The delays are the lateness each job accepts. All jobs write in append mode: a window comes out
once, when the watermark has passed its end.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.texts import plain_type
from tidemart.functions.times import floor_div
from tidemart.operators import cdc, changelog, keywords, logs, patterns, sequences, stats, wide
from tidemart.operators.asof import BEGINNING
from tidemart.operators.patterns import Pattern
from tidemart.operators.wide import Dims
from tidemart.plans.warehouse import Params, routed_changes
from tidemart.schemas import (
    CART_INFO, CHANGE, COMMENT_INFO, CONFIG_LINE, DISPLAY_LINE, FAVOR_INFO, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE,
    PAGE_LOG, PAYMENT_INFO, PAYMENT_WIDE, PRODUCT_COUNTS, REFUND_INFO, ROUTE)
from tidemart.session import exists
from tidemart.sinks.dims import write_batch
from tidemart.sinks.topics import routed_lines
from tidemart.streaming.processors import FirstEver, FirstOfDay, KeyedTotals, PatternAttempts, RouteAsOf

VALUE = T.StructType([T.StructField("value", T.StringType())])
FIRST = T.StructType([
    T.StructField("mid", T.StringType()), T.StructField("first_rec", T.LongType()),
    T.StructField("closed", T.TimestampType())])


def _parsed(lines: DataFrame, delay: str) -> DataFrame:
    """Log records beside their line, with watermark on the millisecond event time."""
    return logs.with_event_time(logs.parse_lines(lines, PAGE_LOG, "value"), delay)


def split_topics(lines: DataFrame) -> DataFrame:
    """Raw log lines to (topic, value) lines of the start, page and display topics."""
    return logs.split_lines(logs.parse_lines(lines, PAGE_LOG))


def repair_is_new(lines: DataFrame, size_s: int = 5, delay: str = "5 seconds") -> DataFrame:
    """Log records with repaired ``is_new``.

    The first record of a device is found among its window firsts (one small row per device and
    window); the log then waits one window for it in an outer join by record id.
    """
    log = logs.with_known_id(_parsed(lines, delay).drop("value"))
    firsts = (log.groupBy(F.window("et", f"{size_s} seconds"), F.col("common.mid").alias("mid"))
              .agg(F.min(F.struct("ts", "rec_id")).alias("f"))
              .select("mid", "f.ts", "f.rec_id", F.window_time("window").alias("closed")))
    first = firsts.groupBy("mid").transformWithState(
        FirstEver(), FIRST, "append", "EventTime", eventTimeColumnName="closed")
    on = F.expr(f"rec_id = first_rec AND common.mid = mid AND closed >= et "
                f"AND closed <= et + INTERVAL {size_s} SECONDS")
    is_new = F.when(F.col("first_rec").isNotNull(), "1").otherwise("0")
    return (log.join(first, on, "left")
            .withColumn("common", F.col("common").withField("is_new", is_new))
            .select(*PAGE_LOG.fieldNames()))


def daily_first_visit(lines: DataFrame, size: str = "5 seconds", delay: str = "3 seconds") -> DataFrame:
    """Page lines that are the first of their device on their day."""
    page = logs.with_known_id(_parsed(lines, delay))
    first = F.min_by(F.struct("ts", "rec_id", "value"), F.struct("ts", "rec_id")).alias("f")
    windows = (page.groupBy(F.window("et", size), F.col("common.mid").alias("mid"))
               .agg(first).select("mid", "f.*"))
    # The day is that of the session's time zone, as in the table form.
    day = F.unix_date(sequences.calendar_day(F.col("ts"))).cast("bigint")
    windows = windows.withColumn("day", day)
    return windows.groupBy("mid").transformWithState(FirstOfDay(), VALUE, "append", "None")


ATTEMPTS = T.StructType([
    T.StructField("value", T.StringType()), T.StructField("outcome", T.StringType()),
    T.StructField("times", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.LongType()))])


def pattern_attempts(lines: DataFrame, pattern: Pattern, delay: str = "3 seconds",
                     slice_ms: int | None = None) -> DataFrame:
    """Attempts at a pattern per device: the starting line, its outcome, times and ids of the steps reached.

    Time slices are those of the table operator. State is kept for the records of the last two limits. Records
    that meet no step are left out by the processor: a filter would be pushed below the watermark and hold it up.
    """
    page = logs.with_known_id(_parsed(lines, delay))
    met = pattern.met()
    bits = sum((m.cast("int") * (1 << k) for k, m in enumerate(met)), F.lit(0))
    slice_ms = pattern.slice_ms(slice_ms)
    sliced = page.select(
        F.col("common.mid").alias("mid"), "et", "ts", "rec_id", bits.alias("met"), "value",
        F.explode(patterns.time_slices(F.col("ts"), pattern.limit_ms, slice_ms)).alias("slice"))
    own = F.col("slice") == floor_div(F.col("ts"), slice_ms)
    starts = own & (F.col("met") % 2 == 1)
    ready = sliced.select("mid", "slice", "et", "ts", "rec_id", "met", own.alias("own"),
                          F.when(starts, F.col("value")).alias("value"))
    return ready.groupBy("mid", "slice").transformWithState(
        PatternAttempts(pattern.strict, pattern.limit_ms), ATTEMPTS, "append", "EventTime")


def bounces(lines: DataFrame, limit_ms: int = 5000, delay: str = "3 seconds", *,
            entry_after_entry: bool = True, slice_ms: int | None = None) -> DataFrame:
    """Page lines of entries whose visitor left."""
    found = pattern_attempts(lines, sequences.bounce_pattern(limit_ms, entry_after_entry), delay, slice_ms)
    return sequences.bounced(found, entry_after_entry).select("value")


def order_wide(order_lines: DataFrame, detail_lines: DataFrame, dims: Dims | None, as_of: str | None,
               params: Params = Params(), delay: str = "3 seconds") -> DataFrame:
    base = wide.order_wide_base(
        logs.parse_lines(order_lines, ORDER_INFO), logs.parse_lines(detail_lines, ORDER_DETAIL),
        params.order_lower_ms, params.order_upper_ms, delay, keep_time=True)
    if dims is None:
        return base
    when = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return wide.add_dimensions(base, dims, when)


def payment_wide(payment_lines: DataFrame, wide_lines: DataFrame, params: Params = Params(),
                 delay: str = "3 seconds") -> DataFrame:
    return wide.payment_wide(
        logs.parse_lines(payment_lines, PAYMENT_INFO), logs.parse_lines(wide_lines, ORDER_WIDE),
        params.payment_lower_ms, params.payment_upper_ms, delay)


def province_stats(order_lines: DataFrame, detail_lines: DataFrame, dims: Dims, as_of: str | None = None,
                   as_of_ms: int | None = None, params: Params = Params(), delay: str = "5 seconds") -> DataFrame:
    """Interval join, dimension lookups and windowed distinct count in one query."""
    joined = order_wide(order_lines, detail_lines, dims, as_of, params, delay)
    return stats.province_stats(joined, as_of_ms, params.province_window)


def visitor_stats(page_lines: DataFrame, uv_lines: DataFrame, jump_lines: DataFrame,
                  params: Params = Params(), delay: str = "5 seconds") -> DataFrame:
    """Three topics with a watermark each; the slowest of them closes the windows."""
    facts = stats.visitor_facts(*[_parsed(x, delay) for x in (page_lines, uv_lines, jump_lines)])
    return stats.visitor_stats(facts, params.visitor_window)


def product_stats(topics: dict[str, DataFrame], dims: Dims, params: Params = Params(),
                  delay: str = "20 seconds") -> DataFrame:
    """Eight topics to product statistics with names."""
    schemas = {
        "page": PAGE_LOG, "display": DISPLAY_LINE, "favor": FAVOR_INFO, "cart": CART_INFO,
        "order_wide": ORDER_WIDE, "payment_wide": PAYMENT_WIDE, "refund": REFUND_INFO,
        "comment": COMMENT_INFO}
    facts = stats.product_facts(**{
        name: logs.parse_lines(topics[name], schema) for name, schema in schemas.items()})
    measured = stats.product_measures(logs.with_event_time(facts, delay), params.product_window)
    return stats.add_product_names(measured, dims)


def keyword_stats(page_lines: DataFrame, as_of_ms: int | None = None, params: Params = Params(),
                  delay: str = "3 seconds") -> DataFrame:
    log = logs.log_table(page_lines, PAGE_LOG, delay)
    return stats.keyword_stats(logs.search_words(log), as_of_ms, params.keyword_window)


def product_keywords(stats_lines: DataFrame, as_of_ms: int | None = None) -> DataFrame:
    """Keyword totals of product statistics, without a window: a total comes out again on each change.

    Run it in update mode into ``sinks.stats.upsert_batch``.
    """
    return keywords.product_keywords(logs.parse_lines(stats_lines, PRODUCT_COUNTS), as_of_ms)


WORD_KEY = ("stt", "edt", "word")
WORD_SUMS = ("click_ct", "order_ct", "cart_ct")


def keyword_changes(stats_lines: DataFrame) -> DataFrame:
    """Changelog of keyword totals of product statistics: (stt, edt, keyword, source, ct, sign), append mode.

    A word's three totals change together; counts of zero are never sent, so neither is their withdrawal.
    """
    words = keywords.product_words(logs.parse_lines(stats_lines, PRODUCT_COUNTS)).na.fill("", list(WORD_KEY))
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in WORD_KEY], *[T.StructField(c, T.LongType()) for c in WORD_SUMS],
        T.StructField("sign", T.IntegerType())])
    totals = words.groupBy(*WORD_KEY).transformWithState(KeyedTotals(WORD_KEY, WORD_SUMS), schema, "append", "None")
    return keywords.unpivot_counts(totals, "sign")


def keyword_rollup(changes: DataFrame, popular: int = 10) -> DataFrame:
    """Per window and source: keywords with a count (``rows_ct``), the sum of their counts, and how many reached ``popular``.

    Run it in update mode over the changelog's files into ``sinks.stats.upsert_batch``.
    """
    return changelog.rollup(changes, ["stt", "edt", "source"], {
        "ct": changelog.signed_sum("ct"),
        "popular_ct": changelog.signed_count(F.col("ct") >= popular)})


def route_batch(read_config: Callable[[], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over change lines: facts to topic files, dimensions to their table.

    The configuration is read anew for every batch, so a changed route applies from the next batch. A
    batch that comes again after it was written is skipped, so its lines do not come twice in a topic.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        done = f"{path}/done/batch_id={batch_id}"
        if exists(batch.sparkSession, f"{done}/_SUCCESS"):
            return
        routed = routed_changes(batch, read_config()).persist()
        try:
            facts, dims = cdc.split_routes(routed)
            topics = f"{path}/topics/batch_id={batch_id}"
            # A reader of the topic may have taken the files of a batch that ended before its mark was set.
            if not exists(batch.sparkSession, f"{topics}/_SUCCESS"):
                routed_lines(facts).write.mode("overwrite").partitionBy("topic").parquet(topics)
            write_batch(dims, f"{path}/dims", batch_id)
            batch.limit(0).select(F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(done)
        finally:
            routed.unpersist()
    return write


ROUTED = T.StructType([T.StructField("value", T.StringType()), T.StructField("route", T.StringType())])
VERSION = "CAST(coalesce(at, -9223372036854775808) AS BIGINT) AS at"
SEQ = "CAST(coalesce(seq, -9223372036854775808) AS BIGINT) AS seq"
PACK_ROWS = 512
PACKS = "source_table string, operate_type string, routes string"


def packed_routes(frames: Iterator) -> Iterator:
    """Rows (source_table, operate_type, at, seq, route) as packs of up to ``PACK_ROWS`` (at, seq, route) as text."""
    for frame in frames:
        for (table, operation), rows in frame.sort_values("at").groupby(cdc.ROUTE_KEY):
            for k in range(0, len(rows), PACK_ROWS):
                part = rows.iloc[k:k + PACK_ROWS]
                pack = list(zip(part["at"].tolist(), part["seq"].tolist(), part["route"]))
                yield pd.DataFrame({"source_table": [table], "operate_type": [operation],
                                    "routes": [json.dumps(pack, ensure_ascii=False)]})


def routes_as_of(change_lines: DataFrame, config_lines: DataFrame, snapshot: DataFrame, keep: int | None = None,
                 salts: int = 16) -> DataFrame:
    """Clean changes with the route of their own time; two streams, and the routes known at the first start.

    ``snapshot`` has the columns of ``cdc.config_versions``, ``config_lines`` are such rows as text with ``op``.
    The changes of a (table, operation) are dealt over ``salts`` keys, each of which knows all its routes.
    Routes travel in packs, of which every salt gets a copy.
    A change is routed when it passes, by the routes that have come by then; ``keep`` is the time for which
    ended routes stay known, in the unit of the changes' ``ts``.
    """
    route = F.to_json(F.struct(*ROUTE.fieldNames())).alias("route")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    key = [*cdc.ROUTE_KEY, "salt"]
    changes = cdc.clean_changes(logs.parse_lines(change_lines, CHANGE))
    facts = changes.select(
        F.col("table").alias("source_table"), plain_type(F.col("type")).alias("operate_type"),
        F.pmod(F.xxhash64(*cdc.POSITION), F.lit(salts)).cast("int").alias("salt"),
        F.coalesce("ts", F.lit(BEGINNING)).alias("at"), F.to_json(F.struct(*changes.columns)).alias("value"))

    def packs(versions: DataFrame) -> DataFrame:
        rows = versions.select(*cdc.ROUTE_KEY, F.expr(VERSION), F.expr(SEQ), route)
        return rows.mapInPandas(packed_routes, PACKS).select(*cdc.ROUTE_KEY, every_salt, "routes")

    edits = cdc.config_versions(logs.parse_lines(config_lines, CONFIG_LINE))
    rows = facts.unionByName(packs(edits), allowMissingColumns=True)
    # The routes of one time are reduced to the last one, and neighbouring times share a pack.
    known = cdc.latest_rows(snapshot, [*cdc.ROUTE_KEY, "at"], ["seq"])
    known = packs(known.repartitionByRange(*cdc.ROUTE_KEY, "at"))
    routed = rows.groupBy(*key).transformWithState(
        RouteAsOf(keep), ROUTED, "append", "None", initialState=known.groupBy(*key))
    found = F.from_json("route", ROUTE)
    change = F.from_json("value", CHANGE)
    return (routed.select(F.inline(F.array(F.struct(change.alias("c"), found.alias("r")))))
            .select("c.*", "r.*").withColumn("data", F.from_json("data", cdc.DATA)))


def late_batch(path: str, size_ms: int, delay_ms: int) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over rows with ``ts``: keep rows whose window had already closed.

    Spark itself drops such rows and only counts them. The watermark of a batch is the highest time
    of all batches before it less the delay; each batch stores the highest time so far.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id:
            mark = spark.read.parquet(f"{path}/marks/batch_id={batch_id - 1}").first()["high"]
        window_end = (floor_div(F.col("ts"), size_ms) + 1) * size_ms
        late = F.lit(False) if mark is None else window_end <= mark - delay_ms
        rows = f"{path}/rows/batch_id={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        high = F.greatest(F.max("ts"), F.lit(mark).cast("bigint")).alias("high")
        (spark.read.parquet(rows).agg(high)
         .write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}"))
    return write
