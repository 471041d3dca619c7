"""Joins shared by several layers: interval join, dimension enrichment and small-table lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import DAY_MS, floor_div

BROADCAST_LIMIT = 10 * 1024 * 1024
SLICES_PER_SPAN = 10
HOUR_MS = 3_600_000


def slice_length(lower_ms: int, upper_ms: int) -> int:
    return SLICES_PER_SPAN * max(upper_ms - lower_ms, 1000)


def in_slices(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, lower_ms: int, upper_ms: int,
              slice_ms: int) -> tuple[DataFrame, DataFrame]:
    """Left rows with every slice (``_lslice``) their interval touches, right rows with their own (``_rslice``)."""
    lms, rms = F.unix_millis(F.col(left_ts)), F.unix_millis(F.col(right_ts))
    lslices = F.sequence(floor_div(lms + lower_ms, slice_ms), floor_div(lms + upper_ms, slice_ms))
    lhs = left.select("*", F.explode(lslices).alias("_lslice"))
    # Never null, so that the optimizer has no reason to compute the time once more in a filter.
    rhs = right.select("*", F.coalesce(floor_div(rms, slice_ms), F.lit(0)).alias("_rslice"))
    return lhs, rhs


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower_ms: int, upper_ms: int,
                  slice_ms: int | None = None) -> DataFrame:
    """Pairs with equal keys and ``right_ts`` between ``left_ts + lower`` and ``left_ts + upper``.

    Time is cut into slices and the slice is part of the join key: a hot key spreads over its
    slices, and records of one key that are far apart in time never meet. The left row goes to every
    slice its interval touches, which is one slice for most rows because a slice is longer than the
    interval. Works on two tables and on two streams with watermarks on the time columns.
    """
    slice_ms = slice_ms or slice_length(lower_ms, upper_ms)
    lms, rms = F.unix_millis(F.col(left_ts)), F.unix_millis(F.col(right_ts))
    lhs, rhs = in_slices(left, right, left_ts, right_ts, lower_ms, upper_ms, slice_ms)
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_lslice") == F.col("_rslice"))
    within = rms.between(lms + lower_ms, lms + upper_ms)
    if left.isStreaming or right.isStreaming:
        # Spark drops old state only by timestamp bounds. Intervals of whole days follow the zone's
        # clock changes, so those bounds are an hour wider than the exact ones above.
        slack = HOUR_MS if max(abs(lower_ms), abs(upper_ms)) >= DAY_MS else 0
        within = within & F.expr(
            f"{right_ts} >= {left_ts} + INTERVAL {lower_ms - slack} MILLISECONDS AND "
            f"{right_ts} <= {left_ts} + INTERVAL {upper_ms + slack} MILLISECONDS")
    return lhs.join(rhs, on & within).drop("_lslice", "_rslice")


@dataclass(frozen=True)
class DimSpec:
    """One lookup: fact column ``on`` equals ``dim.key``; ``columns`` maps new names to the dim's."""

    dim: DataFrame
    on: str
    columns: Mapping[str, str]
    key: str = "id"


def enrich(facts: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """Left lookups one after another; a found column replaces one of the same name.

    A later lookup may use a key an earlier one brought in. A missing dimension row gives nulls.
    No broadcast is forced: a dimension below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast
    by its known file size, a larger one is joined by sort-merge, where AQE splits hot keys.
    """
    for spec in specs:
        side = spec.dim.selectExpr(
            f"{spec.key} AS _dim_key", *[f"{source} AS _dim_{name}" for name, source in spec.columns.items()])
        joined = facts.join(side, F.col(spec.on) == F.col("_dim_key"), "left")
        replaced = [name for name in spec.columns if name in facts.columns]
        facts = (joined.drop("_dim_key", *replaced)
                 .withColumnsRenamed({f"_dim_{name}": name for name in spec.columns}))
    return facts


def planned_bytes(df: DataFrame) -> int:
    """Size of a frame as the optimizer knows it before running."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_lookup(facts: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                 limit: int = BROADCAST_LIMIT, salts: int = 128, how: str = "inner") -> DataFrame:
    """Join with a table of few keys, where each key may hold a large part of the facts.

    The small side is broadcast when its planned size is below ``limit``. Otherwise the keys are
    salted: the facts draw a salt from ``spread_by`` and the small side is repeated per salt.
    """
    if planned_bytes(small) <= limit:
        return facts.join(F.broadcast(small), list(on), how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def coalesce_merge(rows: DataFrame, other: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Fill nulls of ``names`` from the row of ``other`` with the same key."""
    side = other.select(F.col(key).alias("_other_key"), *[F.col(c).alias(f"_other_{c}") for c in names])
    filled = {c: F.coalesce(F.col(c), F.col(f"_other_{c}")) for c in names}
    return (rows.join(side, F.col(key) == F.col("_other_key"), "left")
            .withColumns(filled).select(*rows.columns))
