"""Record schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 2)
MONEY_SUM = T.DecimalType(38, 2)


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "decimal(20,2)": MONEY}


def fields(columns: str) -> T.StructType:
    """Struct of ``name type`` pairs; needs no running session."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


COMMON = fields(
    "ar string, uid string, os string, ch string, is_new string, md string, mid string, "
    "vc string, ba string")
PAGE = fields("page_id string, during_time bigint, last_page_id string, item string, item_type string")
START = fields("entry string, loading_time bigint, open_ad_id string")
DISPLAY = fields("item string, item_type string, order bigint")

# The columns product statistics need of a display line.
DISPLAY_LINE = fields("item string, item_type string, ts bigint")

# rec_id is the position of a record in its topic (file row or broker offset): unique, and the
# tie-break between records of one device with the same ts.
PAGE_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", START),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("ts", T.LongType()),
    T.StructField("rec_id", T.LongType()),
])

# `data` and `old` stay text until the table's route is known, because columns differ per table.
CHANGE = fields(
    "database string, table string, type string, ts bigint, xid bigint, xoffset bigint, "
    "data string, old string")
ROUTE = fields(
    "source_table string, operate_type string, sink_type string, sink_table string, "
    "sink_columns string, sink_pk string, sink_extend string")

# A route edit: the time from which it holds and its place in the log of edits.
CONFIG_LINE = T.StructType([*ROUTE.fields, *fields("op string, at bigint, seq bigint").fields])

ORDER_INFO = fields(
    "id bigint, province_id bigint, order_status string, user_id bigint, "
    "total_amount decimal(20,2), activity_reduce_amount decimal(20,2), "
    "coupon_reduce_amount decimal(20,2), original_total_amount decimal(20,2), "
    "feight_fee decimal(20,2), expire_time string, create_time string, operate_time string")
ORDER_DETAIL = fields(
    "id bigint, order_id bigint, sku_id bigint, order_price decimal(20,2), sku_num bigint, "
    "sku_name string, create_time string, split_total_amount decimal(20,2), "
    "split_activity_amount decimal(20,2), split_coupon_amount decimal(20,2)")
PAYMENT_INFO = fields(
    "id bigint, order_id bigint, user_id bigint, total_amount decimal(20,2), subject string, "
    "payment_type string, create_time string, callback_time string")

ORDER_WIDE = fields(
    "detail_id bigint, order_id bigint, sku_id bigint, order_price decimal(20,2), sku_num bigint, "
    "sku_name string, province_id bigint, order_status string, user_id bigint, "
    "total_amount decimal(20,2), activity_reduce_amount decimal(20,2), "
    "coupon_reduce_amount decimal(20,2), original_total_amount decimal(20,2), "
    "feight_fee decimal(20,2), split_feight_fee decimal(20,2), split_activity_amount decimal(20,2), "
    "split_coupon_amount decimal(20,2), split_total_amount decimal(20,2), expire_time string, "
    "create_time string, operate_time string, create_date string, create_hour string, "
    "province_name string, province_area_code string, province_iso_code string, "
    "province_3166_2_code string, user_age int, user_gender string, spu_id bigint, tm_id bigint, "
    "category3_id bigint, spu_name string, tm_name string, category3_name string")
PAYMENT_WIDE = fields(
    "payment_id bigint, subject string, payment_type string, payment_create_time string, "
    "callback_time string, detail_id bigint, order_id bigint, sku_id bigint, "
    "order_price decimal(20,2), sku_num bigint, sku_name string, province_id bigint, "
    "order_status string, user_id bigint, total_amount decimal(20,2), "
    "activity_reduce_amount decimal(20,2), coupon_reduce_amount decimal(20,2), "
    "original_total_amount decimal(20,2), feight_fee decimal(20,2), split_feight_fee decimal(20,2), "
    "split_activity_amount decimal(20,2), split_coupon_amount decimal(20,2), "
    "split_total_amount decimal(20,2), order_create_time string, province_name string, "
    "province_area_code string, province_iso_code string, province_3166_2_code string, "
    "user_age int, user_gender string, spu_id bigint, tm_id bigint, category3_id bigint, "
    "spu_name string, tm_name string, category3_name string")

FAVOR_INFO = fields("id bigint, sku_id bigint, create_time string")
CART_INFO = fields("id bigint, sku_id bigint, create_time string")
REFUND_INFO = fields(
    "id bigint, order_id bigint, sku_id bigint, refund_amount decimal(20,2), create_time string")
COMMENT_INFO = fields("id bigint, sku_id bigint, appraise string, create_time string")

# The columns keyword statistics need of a product statistics line.
PRODUCT_COUNTS = fields(
    "stt string, edt string, sku_name string, click_ct bigint, order_ct bigint, cart_ct bigint")

VISITOR_STATS = (
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")
PRODUCT_STATS = (
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts")
PROVINCE_STATS = (
    "stt", "edt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2",
    "order_amount", "order_count", "ts")
KEYWORD_STATS = ("stt", "edt", "keyword", "source", "ct", "ts")
