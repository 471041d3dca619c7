"""Windowed statistics. The same functions run on tables and on streams in append mode.

Distinct order counts use two plain aggregates: first by (group, order), then by group. Both combine
on the map side, no set of ids is ever held in one row, and a hot product or province is spread by
its orders before its partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import event_time, now_ms, stamp, to_millis
from tidemart.operators.joins import DimSpec, enrich
from tidemart.operators.logs import entry_page, product_clicks, product_displays
from tidemart.operators.wide import Dims
from tidemart.schemas import (
    KEYWORD_STATS, MONEY, MONEY_SUM, PRODUCT_STATS, PROVINCE_STATS, VISITOR_STATS)

# Grades that count as a good comment.
GOOD_GRADES = ("1205", "1204")

_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
           "good_comment_ct")
_VISITS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")


def _bounds() -> list[Column]:
    return [stamp(F.col("window.start")).alias("stt"), stamp(F.col("window.end")).alias("edt")]


# ---------------------------------------------------------------- visitors

def _visitor_rows(log: DataFrame, **given: str) -> DataFrame:
    counts = [f"CAST({given.get(c, 0)} AS BIGINT) AS {c}" for c in _VISITS]
    return log.selectExpr("common.vc", "common.ch", "common.ar", "common.is_new", *counts, "ts", "et")


def visitor_facts(page: DataFrame, first_visits: DataFrame, bounced: DataFrame) -> DataFrame:
    """Page views with session starts, first visits and bounces as rows of one shape.

    The page log is read once for page views, durations and session starts.
    """
    views = _visitor_rows(page.withColumn("_entry", entry_page()), pv_ct="1", sv_ct="_entry",
                          dur_sum="coalesce(page.during_time, 0)")
    return (views.unionByName(_visitor_rows(first_visits, uv_ct="1"))
            .unionByName(_visitor_rows(bounced, uj_ct="1")))


def visitor_stats(facts: DataFrame, size: str = "5 seconds") -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _VISITS]
    return (facts.groupBy(F.window("et", size), "vc", "ch", "ar", "is_new")
            .agg(*sums, F.min("ts").alias("ts"))
            .select(*_bounds(), "*").select(*VISITOR_STATS))


# ---------------------------------------------------------------- products

def _measures(rows: DataFrame, ts: Column, order_kind: str | None = None, **given: str) -> DataFrame:
    """Product, time and all measures; ``given`` has the SQL of those the source fills."""
    kind, order = (f"'{order_kind}'", "order_id") if order_kind else ("NULL", "NULL")
    return rows.withColumn("_ts", ts).selectExpr(
        "CAST(sku_id AS BIGINT) AS sku_id", "CAST(_ts AS BIGINT) AS ts",
        *[f"CAST({given.get(c, 0)} AS BIGINT) AS {c}" for c in _COUNTS],
        *[f"CAST({given.get(c, 0)} AS {MONEY.simpleString()}) AS {c}" for c in _AMOUNTS],
        f"CAST({kind} AS STRING) AS order_kind", f"CAST({order} AS BIGINT) AS order_id")


def good_comment() -> Column:
    return F.when(F.col("appraise").isin(*GOOD_GRADES), 1).otherwise(0)


def product_facts(page: DataFrame, display: DataFrame, favor: DataFrame, cart: DataFrame,
                  order_wide: DataFrame, payment_wide: DataFrame, refund: DataFrame,
                  comment: DataFrame) -> DataFrame:
    """The eight product inputs as rows of one shape; measures a source lacks are 0."""
    def created(rows: DataFrame) -> Column:
        return F.unix_millis(event_time(rows))

    paid = to_millis(F.col("payment_create_time"))
    graded = comment.withColumn("_good", good_comment())
    parts = [
        _measures(product_clicks(page), F.col("ts"), click_ct="1"),
        _measures(product_displays(display), F.col("ts"), display_ct="1"),
        _measures(favor, created(favor), favor_ct="1"),
        _measures(cart, created(cart), cart_ct="1"),
        _measures(order_wide, created(order_wide), "order",
                  order_amount="split_total_amount", order_sku_num="sku_num"),
        _measures(payment_wide, paid, "payment", payment_amount="split_total_amount"),
        _measures(refund, created(refund), "refund", refund_amount="refund_amount"),
        _measures(graded, created(comment), comment_ct="1", good_comment_ct="_good"),
    ]
    facts = parts[0]
    for part in parts[1:]:
        facts = facts.unionByName(part)
    return facts


def product_measures(facts: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Sums and distinct order counts per window and product. Needs the event time ``et``."""
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    sums += [F.sum(c).cast(MONEY_SUM).alias(c) for c in _AMOUNTS]
    first_ts = F.min("ts").alias("ts")
    per_order = (facts.groupBy(F.window("et", size), "sku_id", "order_kind", "order_id")
                 .agg(*sums, first_ts))

    def orders(kind: str) -> Column:
        return F.count(F.when(F.col("order_kind") == kind, F.col("order_id")))

    return (per_order.groupBy("window", "sku_id")
            .agg(*sums, first_ts, orders("order").alias("order_ct"),
                 orders("payment").alias("paid_order_ct"), orders("refund").alias("refund_order_ct"))
            .select(*_bounds(), "*").drop("window"))


def add_product_names(measures: DataFrame, dims: Dims) -> DataFrame:
    """Product, spu, brand and category of each statistics row, looked up after aggregation."""
    named = enrich(measures, [
        DimSpec(dims.sku, "sku_id", {
            "sku_name": "sku_name", "sku_price": "price", "spu_id": "spu_id", "tm_id": "tm_id",
            "category3_id": "category3_id"}),
        DimSpec(dims.spu, "spu_id", {"spu_name": "spu_name"}),
        DimSpec(dims.tm, "tm_id", {"tm_name": "tm_name"}),
        DimSpec(dims.category3, "category3_id", {"category3_name": "name"}),
    ])
    return named.select(*PRODUCT_STATS)


# ---------------------------------------------------------------- provinces

def province_stats(order_wide: DataFrame, as_of_ms: int | None = None, size: str = "5 seconds") -> DataFrame:
    """Amount and number of distinct orders per window and province. Needs the event time ``et``."""
    place = {
        "province_id": "province_id", "province_name": "province_name",
        "area_code": "province_area_code", "iso_code": "province_iso_code",
        "iso_3166_2": "province_3166_2_code"}
    rows = order_wide.select("et", "order_id", "split_total_amount",
                             *[F.col(src).alias(name) for name, src in place.items()])
    amount = F.sum("split_total_amount").cast(MONEY_SUM).alias("split_total_amount")
    per_order = rows.groupBy(F.window("et", size), *place, "order_id").agg(amount)
    total = F.sum("split_total_amount").cast(MONEY_SUM).alias("order_amount")
    return (per_order.groupBy("window", *place)
            .agg(total, F.count("order_id").alias("order_count"))
            .select(*_bounds(), "*", now_ms(as_of_ms).alias("ts"))
            .select(*PROVINCE_STATS))


# ---------------------------------------------------------------- search words

def keyword_stats(found: DataFrame, as_of_ms: int | None = None, size: str = "10 seconds") -> DataFrame:
    """Searches per window and word."""
    return (found.groupBy(F.window("et", size), F.col("word").alias("keyword"))
            .agg(F.count("*").alias("ct"))
            .select(*_bounds(), "keyword", F.lit("search").alias("source"), "ct",
                    now_ms(as_of_ms).alias("ts"))
            .select(*KEYWORD_STATS))
