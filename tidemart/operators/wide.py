"""Wide facts: order line with its order, payment with its order lines, and their dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.times import age_in_years, event_time
from tidemart.operators.joins import DimSpec, enrich, interval_join
from tidemart.operators.spread import spread_interval_join
from tidemart.schemas import ORDER_WIDE, PAYMENT_WIDE

MINUTE = 60_000
_FROM_ORDER = (
    "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "expire_time", "create_time")
_FROM_DETAIL = (
    "order_id", "sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
    "split_coupon_amount", "split_total_amount")
_FROM_PAYMENT = (
    "order_id", "user_id", "total_amount", "subject", "payment_type", "callback_time")


class Dims(NamedTuple):
    user: DataFrame
    province: DataFrame
    sku: DataFrame
    spu: DataFrame
    tm: DataFrame
    category3: DataFrame


def _timed(rows: DataFrame, prefix: str, delay: str | None, text: str = "create_time") -> DataFrame:
    et = f"{prefix}et"
    renamed = (rows.withColumn("et", event_time(rows, text))
               .withColumnsRenamed({c: prefix + c for c in {*rows.columns, "et"}}))
    return renamed.withWatermark(et, delay) if delay else renamed


def _fill(schema: StructType, given: dict[str, str]) -> list[str]:
    """SQL of the columns in schema order; a column nobody fills is null."""
    return [f"CAST({given.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]


def _pairs(left: DataFrame, right: DataFrame, *columns_and_bounds, chunk_rows: int | None,
           left_id: Sequence[str], right_id: Sequence[str]) -> DataFrame:
    """Tables may have keys of more than ``chunk_rows`` rows; streams, and tables without a limit, are joined plainly."""
    if chunk_rows is None or left.isStreaming or right.isStreaming:
        return interval_join(left, right, *columns_and_bounds)
    return spread_interval_join(left, right, *columns_and_bounds, chunk_rows=chunk_rows, left_id=left_id,
                                right_id=right_id)


def order_wide_base(orders: DataFrame, details: DataFrame, lower_ms: int = -5 * MINUTE,
                    upper_ms: int = 5 * MINUTE, delay: str | None = None,
                    keep_time: bool = False, chunk_rows: int | None = None) -> DataFrame:
    """Order line with its order, both created within the interval. Dimension columns are null.

    With ``keep_time`` the line's event time ``et`` stays for a following windowed aggregate. With ``chunk_rows``
    an order id of more rows than that is spread over several tasks.
    """
    pairs = _pairs(
        _timed(orders, "o_", delay), _timed(details, "d_", delay),
        "o_id", "d_order_id", "o_et", "d_et", lower_ms, upper_ms, chunk_rows=chunk_rows,
        left_id=("o_id", "o_user_id", "o_et"), right_id=("d_id",))
    given = {c: f"o_{c}" for c in _FROM_ORDER}
    given |= {c: f"d_{c}" for c in _FROM_DETAIL}
    given |= {
        "detail_id": "d_id",
        "create_date": "substring(o_create_time, 1, 10)",
        "create_hour": "substring(o_create_time, 12, 2)",
    }
    columns = _fill(ORDER_WIDE, given)
    if keep_time:
        columns.append("o_et AS et")
    return pairs.selectExpr(*columns)


def add_dimensions(wide: DataFrame, dims: Dims, as_of: Column) -> DataFrame:
    """User, province, product, brand, spu and category columns of an order line.

    Name and price come from the product dimension and replace those of the order line.
    """
    user = dims.user.select("id", "gender", age_in_years(F.col("birthday"), as_of).alias("age"))
    full = enrich(wide, [
        DimSpec(user, "user_id", {"user_gender": "gender", "user_age": "age"}),
        DimSpec(dims.province, "province_id", {
            "province_name": "name", "province_iso_code": "iso_code",
            "province_area_code": "area_code", "province_3166_2_code": "iso_3166_2"}),
        DimSpec(dims.sku, "sku_id", {
            "sku_name": "sku_name", "order_price": "price", "spu_id": "spu_id", "tm_id": "tm_id",
            "category3_id": "category3_id"}),
        DimSpec(dims.tm, "tm_id", {"tm_name": "tm_name"}),
        DimSpec(dims.spu, "spu_id", {"spu_name": "spu_name"}),
        DimSpec(dims.category3, "category3_id", {"category3_name": "name"}),
    ])
    return full.select(*wide.columns)


def payment_wide(payments: DataFrame, order_wide: DataFrame, lower_ms: int = -45 * MINUTE,
                 upper_ms: int = 5_000, delay: str | None = None,
                 chunk_rows: int | None = None) -> DataFrame:
    """Payment with the order lines created at most 45 minutes before it or 5 seconds after it.

    Where both sides carry a column (total_amount, user_id) the payment's value stays. ``chunk_rows`` as above, for
    order lines kept as a table.
    """
    pairs = _pairs(
        _timed(payments, "p_", delay), _timed(order_wide, "w_", delay),
        "p_order_id", "w_order_id", "p_et", "w_et", lower_ms, upper_ms, chunk_rows=chunk_rows,
        left_id=("p_id",), right_id=("w_detail_id",))
    given = {c: f"w_{c}" for c in ORDER_WIDE.fieldNames()}
    given |= {c: f"p_{c}" for c in _FROM_PAYMENT}
    given |= {
        "payment_id": "p_id",
        "payment_create_time": "p_create_time",
        "order_create_time": "w_create_time",
    }
    return pairs.selectExpr(*_fill(PAYMENT_WIDE, given))
