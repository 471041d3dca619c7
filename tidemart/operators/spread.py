"""Interval join of tables where one key may hold any part of the rows, also within one slice of time.

The plain interval join has (key, slice) as its join key, so one task gets all rows of such a group. Here groups
are counted first, and those of more than ``chunk_rows`` rows on either side are cut into cells:

* by time: quantiles of a sample of the group's right rows are the cuts. A right row lies in one part, a left row
  goes to each part its interval touches, so no pair is lost or found twice;
* a part that is still too large (a pile of one time, or many left rows) is a grid: right rows are dealt over its
  columns and repeated per row of the grid, left rows the other way round, and a pair meets in one cell.

Only groups in full hash buckets are counted one by one. The rows repeated are about as many as the rows there are,
but for piles, where the pairs themselves are more. Rows alike in ``left_id`` or ``right_id`` (all columns, if not
given) stay together; naming few columns there keeps the others out of the counting passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.operators.asof import not_after
from tidemart.operators.joins import in_slices, interval_join, planned_bytes, slice_length, small_lookup
from tidemart.session import stored

CHUNK_ROWS = 1_000_000
# Inputs that plan for less than this per row of a chunk are joined without counting.
ROW_BYTES = 64
# Sampled rows between two cuts.
SAMPLED = 64
# Hash buckets of the first count; the list of full ones is at most 2 MB.
BUCKETS = 1 << 18

GROUP = ["_key", "_slice"]
PART = [*GROUP, "_part"]
CELL = [*PART, "_row", "_column"]
LEFT, RIGHT = 0, 1


def spread_interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str,
                         right_ts: str, lower_ms: int, upper_ms: int, slice_ms: int | None = None,
                         chunk_rows: int = CHUNK_ROWS, left_id: Sequence[str] = (),
                         right_id: Sequence[str] = ()) -> DataFrame:
    """The pairs of ``interval_join`` on two tables without clashing names; no cell has many more than ``chunk_rows`` rows.

    Both sides are read several times: give it tables, not long plans.
    """
    same = (left, right, left_key, right_key, left_ts, right_ts, lower_ms, upper_ms, slice_ms)
    if planned_bytes(left) + planned_bytes(right) < ROW_BYTES * chunk_rows:
        return interval_join(*same)
    cells = spread(*same, chunk_rows, left_id, right_id)
    if cells is None:
        return interval_join(*same)
    lhs, rhs = cells
    return (lhs.join(rhs, CELL).where(F.col("_at").between(F.col("_from"), F.col("_to")))
            .select(*left.columns, *right.columns))


def spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str,
           lower_ms: int, upper_ms: int, slice_ms: int | None, chunk_rows: int, left_id: Sequence[str] = (),
           right_id: Sequence[str] = ()) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with the cells of each row; nothing where no group is larger than ``chunk_rows``."""
    slice_ms = slice_ms or slice_length(lower_ms, upper_ms)
    lhs, rhs = in_slices(left, right, left_ts, right_ts, lower_ms, upper_ms, slice_ms)
    at = F.unix_millis(left_ts)
    lhs = lhs.where(F.col(left_key).isNotNull()).withColumnRenamed("_lslice", "_slice").withColumns({
        "_key": F.col(left_key), "_from": at + lower_ms, "_to": at + upper_ms,
        "_spot": F.xxhash64(*(left_id or left.columns))})
    rhs = (rhs.where(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull()).withColumnRenamed("_rslice", "_slice")
           .withColumns({"_key": F.col(right_key), "_at": F.unix_millis(right_ts),
                         "_spot": F.xxhash64(*(right_id or right.columns))}))

    groups = crowded(both(lhs, rhs, GROUP), chunk_rows)
    if groups.isEmpty():
        return None
    cuts = stored(time_cuts(groups, rhs, chunk_rows), "time-cuts")
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    cut, known = F.col("_cuts"), F.col("_cuts").isNotNull()

    def parts(time: str) -> Column:
        return F.when(known, not_after(cut, F.col(time), most)).otherwise(0)

    lhs = small_lookup(lhs, cuts, GROUP, ["_spot"], how="left")
    rhs = small_lookup(rhs, cuts, GROUP, ["_spot"], how="left")
    lhs = lhs.select("*", F.explode(F.sequence(parts("_from"), parts("_to"))).alias("_part"))
    rhs = rhs.withColumn("_part", parts("_at"))

    grids = stored(grid_sizes(both(lhs.where(known), rhs.where(known), PART), chunk_rows), "grids")
    lhs = small_lookup(lhs, grids, PART, ["_spot"], how="left")
    rhs = small_lookup(rhs, grids, PART, ["_spot"], how="left")
    lhs = lhs.withColumn("_row", dealt("_rows")).select("*", every("_columns").alias("_column"))
    rhs = rhs.withColumn("_column", dealt("_columns")).select("*", every("_rows").alias("_row"))
    return lhs, rhs


def both(lhs: DataFrame, rhs: DataFrame, columns: list[str]) -> DataFrame:
    return lhs.select(*columns, F.lit(LEFT).alias("_side")).unionAll(rhs.select(*columns, F.lit(RIGHT).alias("_side")))


def crowded(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Groups with more than ``chunk_rows`` rows on one side, written to a table.

    Hash buckets are counted first, which combines to a few numbers in each task. A large group makes its bucket
    full, so only the groups of full buckets are counted one by one.
    """
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*GROUP), F.lit(BUCKETS)))
    large = F.col("count") > chunk_rows
    full = stored(rows.groupBy("_bucket", "_side").count().where(large).select("_bucket").distinct(), "full-buckets")
    counted = rows.join(F.broadcast(full), "_bucket", "left_semi").groupBy(*GROUP, "_side").count()
    return stored(counted.where(large).select(*GROUP).distinct(), "crowded")


def time_cuts(groups: DataFrame, rhs: DataFrame, chunk_rows: int) -> DataFrame:
    """Each group with its sorted cuts, about one per ``chunk_rows`` right rows."""
    step = max(1, chunk_rows // SAMPLED)
    sampled = (rhs.where(F.pmod("_spot", F.lit(step)) == 0).select(*GROUP, "_at")
               .join(groups, GROUP, "left_semi"))
    nth = F.row_number().over(Window.partitionBy(*GROUP).orderBy("_at"))
    cuts = (sampled.withColumn("_nth", nth).where(F.col("_nth") % max(1, chunk_rows // step) == 0)
            .groupBy(*GROUP).agg(F.sort_array(F.collect_set("_at")).alias("_cuts")))
    none = F.array().cast("array<bigint>")
    return groups.join(cuts, GROUP, "left").withColumn("_cuts", F.coalesce("_cuts", none))


def grid_sizes(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows and columns of the grid of each part that one cell does not hold."""
    def cells(side: int) -> Column:
        n = F.count(F.when(F.col("_side") == side, 1))
        return F.greatest(F.lit(1).cast("bigint"), F.ceil(n / chunk_rows))

    sizes = rows.groupBy(*PART).agg(cells(LEFT).alias("_rows"), cells(RIGHT).alias("_columns"))
    return sizes.where((F.col("_rows") > 1) | (F.col("_columns") > 1))


def dealt(cells: str) -> Column:
    return F.pmod("_spot", F.coalesce(cells, F.lit(1)))


def every(cells: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(cells, F.lit(1)) - 1))
