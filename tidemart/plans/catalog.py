"""Registered table queries: every operator over the whole given tables.

Window sizes and time limits are longer than the warehouse's own, because the given events lie
hours apart. Nested records are flattened and money is given as double for the SQL check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import texts, times
from tidemart.operators import cdc, dashboard, joins, keywords, logs, patterns, sequences, stats, wide
from tidemart.operators.patterns import Pattern
from tidemart.plans import warehouse
from tidemart.schemas import CHANGE, PAGE_LOG
from tidemart.session import limit_task_bytes, shared_dir, stored
from tidemart.sinks.stats import write_table
from tidemart.sources import tables
from tidemart.sources.sample import Sample

DAY = times.DAY_MS
HOUR = 3_600_000
AS_OF = "2024-06-30 00:00:00"
AS_OF_MS = 1_719_705_600_000
PARAMS = warehouse.Params(
    bounce_ms=6 * HOUR, order_lower_ms=-30 * DAY, order_upper_ms=30 * DAY,
    visitor_window="1 hour", product_window="6 hours", province_window="1 day",
    keyword_window="1 day")
HOT_CHUNK_ROWS = 500


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double."""
    money = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if f.dataType.typeName() == "decimal"}
    return df.withColumns(money) if money else df


def flat_log(log: DataFrame, *more: Column) -> DataFrame:
    return log.select(
        "rec_id", "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.item").alias("item"), F.col("page.during_time").alias("during_time"), *more)


def pages(s: Sample) -> DataFrame:
    return logs.split_log(s.log()).page


# ------------------------------------------------------------ warehouse tables

def visitor_table(s: Sample) -> DataFrame:
    return warehouse.visitor_table(pages(s), PARAMS)


def order_wide_base(s: Sample) -> DataFrame:
    return warehouse.order_base_table(s.orders(), s.details(), PARAMS)


def order_wide_table(s: Sample) -> DataFrame:
    return warehouse.order_wide_table(s.orders(), s.details(), s.dims(), AS_OF, PARAMS)


def payment_wide_table(s: Sample) -> DataFrame:
    return warehouse.payment_wide_table(s.payments(), order_wide_table(s), PARAMS)


def product_facts(s: Sample) -> DataFrame:
    page, display = logs.split_log(s.log())[1:]
    # Statistics read no dimension column of the wide facts, so the lookups are left out here. Two
    # of the eight inputs read the order lines: they are joined once and kept as a table.
    orders = stored(order_wide_base(s), "dwm_order_wide")
    payments = warehouse.payment_wide_table(s.payments(), orders, PARAMS)
    return stats.product_facts(page, display, s.favors(), s.carts(), orders, payments,
                               s.refunds(), s.comments())


def product_table(s: Sample) -> DataFrame:
    return warehouse.product_table(product_facts(s), s.dims(), PARAMS)


def province_table(s: Sample) -> DataFrame:
    return warehouse.province_table(order_wide_table(s), AS_OF_MS, PARAMS)


def search_table(s: Sample) -> DataFrame:
    return warehouse.search_table(s.search_log(), AS_OF_MS, PARAMS)


def keyword_table(s: Sample) -> DataFrame:
    return warehouse.keyword_table(search_table(s), product_table(s), AS_OF_MS)


def routed(s: Sample) -> DataFrame:
    return warehouse.routed_changes(s.change_lines(), s.routes())


# ------------------------------------------------------------ single operators

def json_log_scan(s: Sample) -> DataFrame:
    log = logs.log_table(s.log_lines())
    return flat_log(log, times.stamp(F.col("et")).alias("et"))


def repair_is_new_raw(s: Sample) -> DataFrame:
    """The same repair on lines without an id of their own: the reader's position is the id."""
    log = s.log()
    line = F.to_json(F.struct(*[c for c in log.columns if c != "rec_id"])).alias("value")
    lines = log.select(F.col("rec_id").alias("position"), line)
    return flat_log(sequences.repair_is_new(logs.parse_lines(lines, PAGE_LOG)))


def to_json_rows(s: Sample) -> DataFrame:
    rows = s.payments().select("id", "order_id", "payment_type", "create_time", F.when(
        F.col("id") % 2 == 0, F.col("subject")).alias("subject"))
    return texts.to_lines(rows)


def cdc_clean(s: Sample) -> DataFrame:
    return cdc.clean_changes(logs.parse_lines(s.change_lines(), CHANGE)).select(
        "database", "table", "type", "ts", "xid")


def cdc_prune_columns(s: Sample) -> DataFrame:
    rows = cdc.prune_columns(routed(s))
    return rows.select(
        "table", "xid", "sink_table", F.size("data").alias("n_columns"),
        *[F.col("data")[c].alias(c) for c in ("id", "user_id", "order_status", "name", "note", "segment")])


def routed_rows(routed: DataFrame) -> DataFrame:
    """Routed changes without their bodies, which are counted."""
    return cdc.prune_columns(routed).select(
        "table", "operate_type", "ts", "xid", "sink_type", "sink_table", F.size("data").alias("n_columns"),
        F.col("data")["id"].alias("id"))


def dim_upsert(s: Sample) -> DataFrame:
    """Users as they are, changed by every routed user record."""
    existing = s.table("customer").select(
        F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("name"))
    _, to_dims = cdc.split_routes(routed(s))
    return cdc.dim_upsert(existing, to_dims, ["id", "name"])


def log_split_counts(s: Sample) -> DataFrame:
    streams = logs.split_log(s.log())
    parts = [getattr(streams, k).select(F.lit(k).alias("stream")) for k in streams._fields]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("stream").agg(F.count("*").alias("n"))


def sql_with_args(s: Sample) -> DataFrame:
    return tables.run_sql(
        s.spark,
        "SELECT order_status, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS total "
        "FROM {orders} WHERE create_time >= ? AND user_id <> ? GROUP BY order_status",
        ["1996-01-01 00:00:00", 7], orders=s.orders())


def any_positive(s: Sample) -> DataFrame:
    return keywords.any_positive(product_table(s)).select(
        "stt", "edt", "sku_id", "sku_name", "click_ct", "order_ct", "cart_ct")


def coalesce_merge(s: Sample) -> DataFrame:
    """Orders with gaps, filled from the unbroken orders."""
    whole = s.orders()
    gaps = whole.withColumns({
        "order_status": F.when(F.col("id") % 2 == 0, F.col("order_status")),
        "total_amount": F.when(F.col("id") % 3 == 0, F.col("total_amount"))})
    filled = joins.coalesce_merge(gaps, whole, "id", ["order_status", "total_amount", "user_id"])
    return filled.select("id", "order_status", "total_amount", "user_id")


def scalar_time_functions(s: Sample) -> DataFrame:
    o = s.table("orders").withColumn("ms", F.unix_millis("o_orderdate") + F.col("o_orderkey"))
    text = times.stamp(F.col("o_orderdate"))
    as_of = F.to_timestamp(F.lit(AS_OF))
    return o.select(
        "o_orderkey", times.stamp(times.at_second(F.col("ms"))).alias("whole_second"),
        times.to_millis(text).alias("millis"),
        times.to_millis(F.when(F.col("o_orderkey") % 2 == 0, text).otherwise("no date")).alias("checked"),
        F.unix_millis(as_of).alias("now_ms"),
        times.create_date(text).alias("create_date"), times.create_hour(text).alias("create_hour"),
        times.age_in_years(F.to_date("o_orderdate"), as_of).alias("age"),
        times.day_number(text).alias("day_number"), F.hour(times.at_millis(F.col("ms"))).alias("hour"),
        times.hour_label(F.hour(times.at_millis(F.col("ms")))).alias("hour_label"),
        texts.plain_type(F.concat(F.lit("bootstrap-"), F.lower("o_orderstatus"))).alias("plain_type"))


def scalar_text_functions(s: Sample) -> DataFrame:
    e = flat_log(s.log())
    listed = F.lit("home,good_list")
    return e.select(
        "rec_id", F.coalesce("item", F.lit("none")).alias("item"),
        F.coalesce(F.col("page_id").contains("good"), F.lit(False)).alias("has_good"),
        (F.coalesce(F.length("page_id"), F.lit(0)) > 4).alias("is_long"),
        texts.is_blank(F.col("last_page_id")).alias("is_entry"),
        texts.not_blank(F.col("last_page_id")).alias("is_next"),
        F.coalesce(texts.in_list(listed, F.col("page_id")), F.lit(False)).alias("is_listed"),
        texts.cache_key(F.lit("dim_user_info"), F.col("mid")).alias("cache_key"),
        texts.text_or_empty(F.col("during_time")).alias("during_text"),
        F.coalesce("last_page_id", "page_id", F.lit("start")).alias("first_known"))


def display_explode(s: Sample) -> DataFrame:
    return logs.explode_displays(s.log()).select(
        "ts", "page_id", "mid", "vc", "item", "item_type", "order")


def funnel_pattern() -> Pattern:
    """From a list of products to a product's page to a payment, with any pages between."""
    page = F.col("page.page_id")
    return (Pattern.begin("list", page == "good_list").followed_by("product", page == "good_detail")
            .followed_by("payment", page == "payment").within(PARAMS.bounce_ms))


def funnel_rows(attempts: DataFrame) -> DataFrame:
    """(rec_id, ts, mid, outcome, ids) to one flat row per attempt."""
    return attempts.select(
        "rec_id", "ts", "mid", "outcome", F.size("ids").alias("reached"),
        F.get("ids", F.lit(1)).alias("product_id"), F.get("ids", F.lit(2)).alias("payment_id"))


def funnel_three_steps(s: Sample) -> DataFrame:
    found = patterns.detect(pages(s), funnel_pattern(), F.col("common.mid"))
    return funnel_rows(found.select("record.rec_id", "record.ts", "record.common.mid", "outcome",
                                    F.col("taken.id").alias("ids")))


def order_lines_hot_key(s: Sample) -> DataFrame:
    """Orders and lines within a day of each other, where one order id holds half of both tables."""
    def shared(name: str) -> Column:
        return F.when(F.col(name) % 2 == 0, 0).otherwise(F.col(name))

    pairs = wide.order_wide_base(
        s.orders().withColumn("id", shared("id")), s.details().withColumn("order_id", shared("order_id")),
        -DAY, DAY, chunk_rows=HOT_CHUNK_ROWS)
    return pairs.groupBy("create_date", "order_status").agg(
        F.count("*").alias("n_pairs"), F.sum("split_total_amount").alias("amount"), F.sum("total_amount").alias("total"))


# ------------------------------------------------------------ dashboard, one day of a stored table

def last_day(stats: DataFrame, name: str, ask: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Write a statistics table by day, and ask one question about its last day: only that day is opened."""
    spark, path = stats.sparkSession, shared_dir(stats.sparkSession, name)
    write_table(stats, path, stats.columns)
    day = tables.read_stats(spark, path).agg(F.max("dt")).first()[0]
    return ask(tables.read_stats(spark, path, day, day), day)


TABLE_QUERIES: dict[str, Callable[[Sample], DataFrame]] = {
    # scans and sinks
    "json_log_scan": json_log_scan,
    "config_latest": lambda s: cdc.config_latest(s.config_changes()),
    "sql_with_args": sql_with_args,
    "dim_upsert": dim_upsert,
    # selections and routing
    "to_json_rows": to_json_rows,
    "cdc_clean": cdc_clean,
    "cdc_prune_columns": cdc_prune_columns,
    "cdc_routes_as_of": lambda s: routed_rows(warehouse.routed_as_of(s.change_lines(), s.route_history())),
    "cdc_route_counts": lambda s: cdc.route_counts(routed(s)),
    "log_split_counts": log_split_counts,
    "display_explode": display_explode,
    "session_entries": lambda s: flat_log(logs.session_entries(pages(s))),
    "product_clicks": lambda s: logs.product_clicks(pages(s)),
    "product_displays": lambda s: logs.product_displays(logs.explode_displays(s.log())),
    "good_comments": lambda s: s.comments().groupBy("sku_id").agg(
        F.count("*").alias("comment_ct"), F.sum(stats.good_comment()).alias("good_comment_ct")),
    "search_keywords": lambda s: logs.search_words(s.search_log()).select(
        times.stamp(F.col("et")).alias("et"), "word"),
    "any_positive": any_positive,
    "coalesce_merge": coalesce_merge,
    "scalar_time_functions": scalar_time_functions,
    "scalar_text_functions": scalar_text_functions,
    # wide facts
    "order_wide_base": lambda s: order_wide_base(s).drop("et"),
    "order_wide": lambda s: order_wide_table(s).drop("et"),
    "order_lines_hot_key": order_lines_hot_key,
    "payment_wide": payment_wide_table,
    # sequences
    "repair_is_new": lambda s: flat_log(sequences.repair_is_new(s.log())),
    "repair_is_new_raw": repair_is_new_raw,
    "daily_first_visit": lambda s: flat_log(sequences.daily_first_visit(pages(s))),
    "jump_timeout_only": lambda s: flat_log(
        sequences.bounces(pages(s), PARAMS.bounce_ms, entry_after_entry=False)),
    "funnel_three_steps": funnel_three_steps,
    "jump_detail": lambda s: flat_log(sequences.bounces(pages(s), PARAMS.bounce_ms)),
    # statistics
    "visitor_stats": visitor_table,
    "product_stats": product_table,
    "province_stats": province_table,
    "keyword_stats": search_table,
    "product_keywords": lambda s: keywords.product_keywords(product_table(s), AS_OF_MS),
    # dashboard, every day
    "gmv_total": lambda s: dashboard.gmv_total(product_table(s), None),
    "gmv_by_brand": lambda s: dashboard.gmv_by_brand(product_table(s), None),
    "gmv_by_category": lambda s: dashboard.gmv_by_category(product_table(s), None),
    "gmv_by_spu": lambda s: dashboard.gmv_by_spu(product_table(s), None),
    "province_map": lambda s: dashboard.province_map(province_table(s), None),
    "visitor_by_hour": lambda s: dashboard.visitor_by_hour(visitor_table(s), None),
    "visitor_by_is_new": lambda s: dashboard.visitor_by_is_new(visitor_table(s), None),
    "visitor_24h": lambda s: dashboard.visitor_24h(visitor_table(s), None),
    # dashboard, the last day of a stored table
    "gmv_by_brand_day": lambda s: last_day(product_table(s), "product_stats", dashboard.gmv_by_brand),
    "visitor_24h_day": lambda s: last_day(visitor_table(s), "visitor_stats", dashboard.visitor_24h),
    "keyword_score_day": lambda s: last_day(keyword_table(s), "keyword_stats", dashboard.keyword_score),
    "keyword_score": lambda s: dashboard.keyword_score(keyword_table(s), None),
}


def table_query(build: Callable[[Sample], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        limit_task_bytes(spark)
        return plain(build(Sample(spark, sf_dir)))
    return run
