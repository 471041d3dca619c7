"""The warehouse layers put together: from topics to statistics tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import event_time
from tidemart.operators import cdc, keywords, logs, sequences, stats, wide
from tidemart.operators.spread import CHUNK_ROWS
from tidemart.operators.wide import Dims
from tidemart.schemas import CHANGE


class Params(NamedTuple):
    """Sizes of windows and limits; the defaults are those of the running warehouse."""

    bounce_ms: int = 5_000
    order_lower_ms: int = -5 * wide.MINUTE
    order_upper_ms: int = 5 * wide.MINUTE
    payment_lower_ms: int = -45 * wide.MINUTE
    payment_upper_ms: int = 5_000
    visitor_window: str = "5 seconds"
    product_window: str = "5 seconds"
    province_window: str = "5 seconds"
    keyword_window: str = "10 seconds"
    order_chunk_rows: int | None = CHUNK_ROWS


def visitor_table(page: DataFrame, params: Params = Params()) -> DataFrame:
    """Page log to visitor statistics."""
    # Only these fields travel through the shuffles below, not whole records.
    page = page.selectExpr(
        "named_struct('mid', common.mid, 'vc', common.vc, 'ch', common.ch, 'ar', common.ar, "
        "'is_new', common.is_new) AS common",
        "named_struct('last_page_id', page.last_page_id, 'during_time', page.during_time) AS page",
        "ts", "rec_id")
    uv = sequences.daily_first_visit(page.drop("page"))
    uj = sequences.bounces(page, params.bounce_ms)
    facts = stats.visitor_facts(*[logs.with_event_time(x) for x in (page, uv, uj)])
    return stats.visitor_stats(facts, params.visitor_window)


def order_base_table(orders: DataFrame, details: DataFrame, params: Params = Params()) -> DataFrame:
    """Order lines with their orders; the event time ``et`` stays for the layers above."""
    return wide.order_wide_base(
        orders, details, params.order_lower_ms, params.order_upper_ms, keep_time=True,
        chunk_rows=params.order_chunk_rows)


def order_wide_table(orders: DataFrame, details: DataFrame, dims: Dims, as_of: str,
                     params: Params = Params()) -> DataFrame:
    base = order_base_table(orders, details, params)
    return wide.add_dimensions(base, dims, F.to_timestamp(F.lit(as_of)))


def payment_wide_table(payments: DataFrame, order_wide: DataFrame, params: Params = Params()) -> DataFrame:
    return wide.payment_wide(payments, order_wide, params.payment_lower_ms, params.payment_upper_ms)


def product_table(facts: DataFrame, dims: Dims, params: Params = Params()) -> DataFrame:
    """Product facts to product statistics with names."""
    measured = stats.product_measures(logs.with_event_time(facts), params.product_window)
    return stats.add_product_names(measured, dims)


def province_table(order_wide: DataFrame, as_of_ms: int | None, params: Params = Params()) -> DataFrame:
    timed = order_wide.withColumn("et", event_time(order_wide))
    return stats.province_stats(timed, as_of_ms, params.province_window)


def search_table(page: DataFrame, as_of_ms: int | None, params: Params = Params()) -> DataFrame:
    return stats.keyword_stats(logs.search_words(page), as_of_ms, params.keyword_window)


def keyword_table(search: DataFrame, product_stats: DataFrame, as_of_ms: int | None) -> DataFrame:
    """Keywords from searches and from product counts in one table."""
    return search.unionByName(keywords.product_keywords(product_stats, as_of_ms))


def routed_changes(lines: DataFrame, config_changes: DataFrame) -> DataFrame:
    changes = cdc.clean_changes(logs.parse_lines(lines, CHANGE))
    return cdc.route_changes(changes, cdc.config_latest(config_changes))


def routed_as_of(lines: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Change lines with the route that was in force at each line's own time."""
    return cdc.routes_as_of(cdc.clean_changes(logs.parse_lines(lines, CHANGE)), config_changes)
