"""Dashboard rollups over the statistics tables.

Every function takes the day as ``yyyyMMdd`` (0: today) and then answers for that day only, by a
filter on the partition column ``dt`` where the table has one. With ``date=None`` it answers for
every day at once, with ``dt`` as first column and top-n lists per day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.functions.times import day_number, day_or_today, hour_label
from tidemart.schemas import MONEY_SUM

# Weight of a keyword by where it came from; every other source counts 2.
SOURCE_WEIGHTS = {"search": 10, "click": 8, "order": 5}
OTHER_WEIGHT = 2


def with_day(stats: DataFrame) -> DataFrame:
    return stats if "dt" in stats.columns else stats.withColumn("dt", day_number(F.col("stt")))


def _rollup(stats: DataFrame, date: int | None, keys: Mapping[str, Column],
            aggs: Sequence[Column]) -> DataFrame:
    rows = with_day(stats)
    groups = [value.alias(name) for name, value in keys.items()]
    if date is None:
        groups = [F.col("dt"), *groups]
    else:
        rows = rows.where(F.col("dt") == day_or_today(date))
    return rows.groupBy(*groups).agg(*aggs)


def _top(rolled: DataFrame, date: int | None, measure: str, name: str, limit: int) -> DataFrame:
    """Highest ``measure`` first; equal values by name, so the list is the same on every run."""
    order = [F.desc(measure), F.asc(name)]
    if date is not None:
        return rolled.orderBy(*order).limit(limit)
    ranked = rolled.withColumn("_n", F.row_number().over(Window.partitionBy("dt").orderBy(*order)))
    return ranked.where(F.col("_n") <= limit).drop("_n")


def _amount() -> Column:
    return F.sum("order_amount").cast(MONEY_SUM).alias("order_amount")


def gmv_total(product_stats: DataFrame, date: int | None = 0) -> DataFrame:
    return _rollup(product_stats, date, {}, [_amount()])


def gmv_by(product_stats: DataFrame, name: str, date: int | None = 0, limit: int = 5) -> DataFrame:
    rolled = _rollup(product_stats, date, {name: F.col(name)}, [_amount()])
    return _top(rolled, date, "order_amount", name, limit)


def gmv_by_brand(product_stats: DataFrame, date: int | None = 0, limit: int = 5) -> DataFrame:
    return gmv_by(product_stats, "tm_name", date, limit)


def gmv_by_category(product_stats: DataFrame, date: int | None = 0, limit: int = 5) -> DataFrame:
    return gmv_by(product_stats, "category3_name", date, limit)


def gmv_by_spu(product_stats: DataFrame, date: int | None = 0, limit: int = 100) -> DataFrame:
    return gmv_by(product_stats, "spu_name", date, limit)


def province_map(province_stats: DataFrame, date: int | None = 0) -> DataFrame:
    return _rollup(province_stats, date, {"province_name": F.col("province_name")},
                   [_amount(), F.sum("order_count").alias("order_count")])


def _visits() -> list[Column]:
    return [F.sum(f"{c}_ct").alias(c) for c in ("pv", "uv", "uj")]


def visitor_by_hour(visitor_stats: DataFrame, date: int | None = 0) -> DataFrame:
    hour = F.hour(F.to_timestamp("stt"))
    return _rollup(visitor_stats, date, {"hour": hour}, _visits())


def visitor_by_is_new(visitor_stats: DataFrame, date: int | None = 0) -> DataFrame:
    return _rollup(visitor_stats, date, {"is_new": F.col("is_new")}, _visits())


def visitor_24h(visitor_stats: DataFrame, date: int | None = 0) -> DataFrame:
    """All 24 hours of a day with labels 00 to 23; an hour without visits counts 0."""
    days = ["dt"] if date is None else []
    counts = ("pv", "uv", "uj")
    # At most 24 entries per day, so the hours of a day fit in one row.
    entry = F.struct("hour", F.struct(*counts))
    by_hour = F.map_from_entries(F.collect_list(entry)).alias("_by_hour")
    daily = (visitor_by_hour(visitor_stats, date).where(F.col("hour").isNotNull())
             .groupBy(*days).agg(by_hour))
    hourly = daily.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_hour"))
    found = F.try_element_at("_by_hour", F.col("_hour"))
    return hourly.select(*days, hour_label(F.col("_hour")).alias("hour"), *[
        F.coalesce(found[c], F.lit(0)).cast("bigint").alias(c) for c in counts])


def source_weight() -> Column:
    weight = None
    for source, value in SOURCE_WEIGHTS.items():
        case = F.col("source") == source
        weight = F.when(case, value) if weight is None else weight.when(case, value)
    return weight.otherwise(OTHER_WEIGHT)


def keyword_score(keyword_stats: DataFrame, date: int | None = 0, limit: int = 10) -> DataFrame:
    score = F.sum(F.col("ct") * source_weight()).alias("score")
    rolled = _rollup(keyword_stats, date, {"keyword": F.col("keyword")}, [score])
    return _top(rolled, date, "score", "keyword", limit)
