"""Registered streaming queries: the given tables replayed as topics through the streaming jobs.

Each has a table query as its twin and must give the same rows. A far-future closing line per topic
lets the watermark pass every real window; it never comes out itself.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.texts import to_lines
from tidemart.functions.times import to_millis
from tidemart.operators import cdc, logs, sequences
from tidemart.plans.catalog import (
    AS_OF, AS_OF_MS, DAY, HOUR, PARAMS, flat_log, funnel_pattern, funnel_rows,
    order_wide_base, order_wide_table, pages, product_table, routed_rows)
from tidemart.plans import warehouse
from tidemart.schemas import PAGE_LOG
from tidemart.session import settings, shared_dir
from tidemart.sources.sample import Sample
from tidemart.sources.tables import read_dim, read_upserts
from tidemart.streaming import jobs
from tidemart.sinks.stats import upsert_batch
from tidemart.streaming import runner
from tidemart.streaming.runner import Feed

FAR_MS = 4_102_444_800_000
FAR = "2100-01-01 00:00:00"
LATE_AFTER = 10 * DAY
LATE_ROUNDS = 3


def line(**fields) -> str:
    return json.dumps(fields, separators=(",", ":"))


CLOSING_PAGE = line(common={"mid": "~"}, page={"page_id": "~", "last_page_id": "~", "item": "~"},
                    ts=FAR_MS, rec_id=-1)
CLOSING_SEARCH = line(page={"page_id": "good_list", "item": "end"}, ts=FAR_MS, rec_id=-1)


def one_wave(spark: SparkSession) -> int:
    """State partitions of the registered queries: the given tables need no more than one per core."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


# Counting the rows of a state store costs one more read of the store in each write; only progress reports show it.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def replay(spark: SparkSession, *rest, **options) -> DataFrame:
    with settings(spark, UNCOUNTED):
        return runner.replay(spark, *rest, partitions=one_wave(spark), **options)


def replay_batches(spark: SparkSession, *rest, **options) -> str:
    with settings(spark, UNCOUNTED):
        return runner.replay_batches(spark, *rest, partitions=one_wave(spark), **options)


def log_feed(log: DataFrame, closing: str | None = CLOSING_PAGE) -> Feed:
    return Feed(to_lines(log, "ts"), closing)


def fact_feed(rows: DataFrame, time: str = "create_time", **closing) -> Feed:
    lines = to_lines(rows.withColumn("_ts", to_millis(F.col(time))), "_ts").withColumnRenamed("_ts", "ts")
    return Feed(lines, line(**closing) if closing else None)


def order_feeds(s: Sample) -> dict[str, Feed]:
    return {
        "dwd_order_info": fact_feed(s.orders(), id=-1, create_time=FAR),
        "dwd_order_detail": fact_feed(s.details(), id=-2, order_id=-2, create_time=FAR)}


def parsed_pages(lines: DataFrame) -> DataFrame:
    return flat_log(logs.parse_lines(lines, PAGE_LOG))


def stream_log_split(s: Sample) -> DataFrame:
    out = replay(s.spark, "log_split", {"ods_log": log_feed(s.log(), None)},
                 lambda t: jobs.split_topics(t["ods_log"]))
    kind = F.regexp_extract("topic", "^dwd_(.*)_log$", 1)
    return out.groupBy(kind.alias("stream")).agg(F.count("*").alias("n"))


def stream_repair_is_new(s: Sample) -> DataFrame:
    return flat_log(replay(s.spark, "repair_is_new", {"ods_log": log_feed(s.log())},
                           lambda t: jobs.repair_is_new(t["ods_log"])))


def stream_daily_first_visit(s: Sample) -> DataFrame:
    return parsed_pages(replay(s.spark, "first_visit", {"dwd_page_log": log_feed(pages(s))},
                               lambda t: jobs.daily_first_visit(t["dwd_page_log"])))


def stream_jump_detail(s: Sample) -> DataFrame:
    return parsed_pages(replay(s.spark, "jump_detail", {"dwd_page_log": log_feed(pages(s))},
                               lambda t: jobs.bounces(t["dwd_page_log"], PARAMS.bounce_ms)))


def stream_funnel_three_steps(s: Sample) -> DataFrame:
    found = replay(s.spark, "funnel", {"dwd_page_log": log_feed(pages(s))},
                   lambda t: jobs.pattern_attempts(t["dwd_page_log"], funnel_pattern()))
    starts = logs.parse_lines(found, PAGE_LOG, "outcome", "ids")
    return funnel_rows(starts.select("rec_id", "ts", "common.mid", "outcome", "ids"))


def stream_visitor_stats(s: Sample) -> DataFrame:
    page = pages(s)
    feeds = {
        "dwd_page_log": log_feed(page), "dwm_uv": log_feed(sequences.daily_first_visit(page)),
        "dwm_user_jump_detail": log_feed(sequences.bounces(page, PARAMS.bounce_ms))}
    return replay(s.spark, "visitor_stats", feeds,
                  lambda t: jobs.visitor_stats(*[t[name] for name in feeds], PARAMS))


def stream_order_wide(s: Sample) -> DataFrame:
    return replay(s.spark, "order_wide", order_feeds(s), lambda t: jobs.order_wide(
        t["dwd_order_info"], t["dwd_order_detail"], s.dims(), AS_OF, PARAMS))


def stream_payment_wide(s: Sample) -> DataFrame:
    feeds = {
        "dwd_payment_info": fact_feed(s.payments(), id=-1, order_id=-1, create_time=FAR),
        "dwm_order_wide": fact_feed(order_wide_table(s).drop("et"), order_id=-2, create_time=FAR)}
    return replay(s.spark, "payment_wide", feeds,
                  lambda t: jobs.payment_wide(t["dwd_payment_info"], t["dwm_order_wide"], PARAMS))


def stream_province_stats(s: Sample) -> DataFrame:
    return replay(s.spark, "province_stats", order_feeds(s), lambda t: jobs.province_stats(
        t["dwd_order_info"], t["dwd_order_detail"], s.dims(), AS_OF, AS_OF_MS, PARAMS))


def stream_product_stats(s: Sample) -> DataFrame:
    display = logs.explode_displays(s.log())
    orders = order_wide_base(s)
    feeds = {
        "page": log_feed(pages(s), line(page={"page_id": "good_detail", "item": "-1"}, ts=FAR_MS)),
        "display": log_feed(display, None),
        "favor": fact_feed(s.favors()), "cart": fact_feed(s.carts()),
        "order_wide": fact_feed(orders.drop("et")),
        "payment_wide": fact_feed(warehouse.payment_wide_table(s.payments(), orders, PARAMS),
                                  "payment_create_time"),
        "refund": fact_feed(s.refunds()), "comment": fact_feed(s.comments())}
    return replay(s.spark, "product_stats", feeds, lambda t: jobs.product_stats(t, s.dims(), PARAMS))


def stream_keyword_stats(s: Sample) -> DataFrame:
    feeds = {"dwd_page_log": log_feed(s.search_log().drop("et"), CLOSING_SEARCH)}
    return replay(s.spark, "keyword_stats", feeds,
                  lambda t: jobs.keyword_stats(t["dwd_page_log"], AS_OF_MS, PARAMS))


def stream_product_keywords(s: Sample) -> DataFrame:
    feeds = {"dws_product_stats": fact_feed(product_table(s), "stt")}
    out = replay_batches(
        s.spark, "product_keywords", feeds,
        lambda t: jobs.product_keywords(t["dws_product_stats"], AS_OF_MS), upsert_batch, mode="update")
    return read_upserts(s.spark, out, ["stt", "edt", "keyword", "source"])


def stream_keyword_rollup(s: Sample) -> DataFrame:
    """Two jobs: keyword totals as a changelog, and groups of keywords over the changelog's files."""
    base = shared_dir(s.spark, "keyword_rollup")
    # The later half of the statistics comes first in some windows, so totals change from round to round.
    feed = fact_feed(product_table(s).withColumn("arrival", F.concat(F.lit("2024-01-0"), F.col("sku_id") % 3 + 1,
                                                                     F.lit(" 00:00:00"))), "arrival")

    def run(topics: dict[str, DataFrame]) -> None:
        changes = jobs.keyword_changes(topics["dws_product_stats"])
        runner.catch_up(runner.file_sink(changes, f"{base}/changes", f"{base}/checkpoint-changes"))
        sent = s.spark.readStream.schema(changes.schema).parquet(f"{base}/changes")
        runner.catch_up(runner.batch_sink(jobs.keyword_rollup(sent), upsert_batch(f"{base}/out"),
                                          f"{base}/checkpoint-rollup", "update"))

    runner.feed_rounds(s.spark, base, {"dws_product_stats": feed}, run, 3, partitions=one_wave(s.spark))
    found = read_upserts(s.spark, f"{base}/out", ["stt", "edt", "source"])
    return found.where("rows_ct > 0").withColumnRenamed("rows_ct", "keyword_ct")


def routed_replay(s: Sample) -> str:
    lines = s.change_lines().withColumn("ts", F.get_json_object("value", "$.ts").cast("bigint"))
    return replay_batches(s.spark, "routes", {"ods_db": Feed(lines)}, lambda t: t["ods_db"],
                          lambda out: jobs.route_batch(s.routes, out))


def stream_cdc_routes(s: Sample) -> DataFrame:
    """Fact lines per topic after routing in the stream."""
    topics = s.spark.read.parquet(f"{routed_replay(s)}/topics")
    return topics.groupBy("topic").agg(F.count("*").alias("n"))


def stream_routes_as_of(s: Sample) -> DataFrame:
    """Routing by the edits as they come, after a start from the snapshot of routes."""
    history = s.route_history()
    lines = s.change_lines().withColumn("ts", F.get_json_object("value", "$.ts").cast("bigint"))
    edits = history.where(F.col("op") != "snapshot")
    feeds = {"ods_db": Feed(lines), "ods_config": Feed(to_lines(edits.withColumn("ts", F.col("at")), "ts"))}
    snapshot = cdc.config_versions(history.where(F.col("op") == "snapshot"))
    return replay(s.spark, "routes_as_of", feeds, lambda t: jobs.routes_as_of(
        t["ods_db"], t["ods_config"], snapshot, salts=one_wave(s.spark)))


def stream_dim_upsert(s: Sample) -> DataFrame:
    """The user dimension after routing in the stream."""
    return read_dim(s.spark, f"{routed_replay(s)}/dims", "dim_user_info", ["id", "name"])


def late_rows(s: Sample) -> DataFrame:
    """Rows that come after their one-hour window has closed; every tenth row comes ten days late."""
    log = s.log()
    arrival = F.col("ts") + F.when(F.col("rec_id") % 10 == 3, LATE_AFTER).otherwise(0)
    feeds = {"ods_log": Feed(to_lines(log.withColumn("arrival", arrival), "arrival")
                             .withColumnRenamed("arrival", "ts"))}
    out = replay_batches(
        s.spark, "late_rows", feeds, lambda t: logs.parse_lines(t["ods_log"], PAGE_LOG),
        lambda path: jobs.late_batch(path, HOUR, 5_000), rounds=LATE_ROUNDS)
    rows = s.spark.read.parquet(f"{out}/rows")
    return rows.where(F.col("late").cast("boolean")).select("rec_id", "ts", F.col("common.mid").alias("mid"))


STREAM_QUERIES: dict[str, Callable[[Sample], DataFrame]] = {
    "stream_log_split": stream_log_split,
    "stream_repair_is_new": stream_repair_is_new,
    "stream_daily_first_visit": stream_daily_first_visit,
    "stream_jump_detail": stream_jump_detail,
    "stream_funnel_three_steps": stream_funnel_three_steps,
    "stream_visitor_stats": stream_visitor_stats,
    "stream_order_wide": lambda s: stream_order_wide(s).drop("et"),
    "stream_payment_wide": stream_payment_wide,
    "stream_province_stats": stream_province_stats,
    "stream_product_stats": stream_product_stats,
    "stream_keyword_stats": stream_keyword_stats,
    "stream_product_keywords": stream_product_keywords,
    "stream_keyword_rollup": stream_keyword_rollup,
    "stream_cdc_routes": stream_cdc_routes,
    "stream_cdc_routes_as_of": lambda s: routed_rows(stream_routes_as_of(s)),
    "stream_dim_upsert": stream_dim_upsert,
    "late_rows": late_rows,
}

# Table queries that give the same rows.
TWINS = {
    "stream_log_split": "log_split_counts", "stream_repair_is_new": "repair_is_new",
    "stream_daily_first_visit": "daily_first_visit", "stream_jump_detail": "jump_detail",
    "stream_visitor_stats": "visitor_stats", "stream_order_wide": "order_wide",
    "stream_payment_wide": "payment_wide", "stream_province_stats": "province_stats",
    "stream_product_stats": "product_stats", "stream_keyword_stats": "keyword_stats",
    "stream_product_keywords": "product_keywords", "stream_cdc_routes_as_of": "cdc_routes_as_of",
    "stream_funnel_three_steps": "funnel_three_steps",
}

