"""Words from product names and the unpivot of their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.texts import words
from tidemart.functions.times import now_ms
from tidemart.schemas import KEYWORD_STATS


def any_positive(stats: DataFrame) -> DataFrame:
    return stats.where((F.col("click_ct") > 0) | (F.col("order_ct") > 0) | (F.col("cart_ct") > 0))


def product_words(stats: DataFrame) -> DataFrame:
    return any_positive(stats).select(
        "stt", "edt", F.explode(words(F.col("sku_name"))).alias("word"),
        "click_ct", "order_ct", "cart_ct")


def sum_words(split: DataFrame) -> DataFrame:
    return split.groupBy("stt", "edt", "word").agg(
        F.sum("click_ct").alias("click_ct"), F.sum("order_ct").alias("order_ct"),
        F.sum("cart_ct").alias("cart_ct"))


def unpivot_counts(sums: DataFrame, *keep: str) -> DataFrame:
    """Up to three rows (click, order, cart) per word, only where the count is positive; ``keep`` stays beside."""
    return sums.select(
        "stt", "edt", F.col("word").alias("keyword"),
        F.expr("stack(3, 'click', click_ct, 'order', order_ct, 'cart', cart_ct) as (source, ct)"),
        *keep).where(F.col("ct") > 0)


def product_keywords(product_stats: DataFrame, as_of_ms: int | None = None) -> DataFrame:
    rows = unpivot_counts(sum_words(product_words(product_stats)))
    return rows.withColumn("ts", now_ms(as_of_ms)).select(*KEYWORD_STATS)
