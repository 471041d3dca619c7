"""As-of join: each fact with the version of its key that was in force at the fact's own time.

A version holds from its time on, until the next version of the same key; at equal times the version comes
before the fact, and of versions with equal times the one with the greatest sequence number counts. A version
without a time holds from the beginning; a fact without a time meets only those. Facts before the first version
of their key are dropped (``how="inner"``) or keep nulls (``how="left"``).

Two physical forms give the same rows:

* few versions, also of any one key: the versions of a key are one sorted array, broadcast, and a fact finds its
  own by halving steps. The facts are not shuffled, so a key may hold any part of them. Each fact is joined with
  the whole array of its key, so long arrays would cost facts times versions.
* many versions: both logs are merged, cut into ranges of (key, time) with about equal numbers of rows, and each
  range carries the last version forward. What a range starts with is the last version of the ranges before it,
  found among one row per key and range. A hot key is cut by time, and a pile of one time by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.operators.joins import BROADCAST_LIMIT, planned_bytes
from tidemart.session import stored

BEGINNING = -(1 << 63)
# Versions of one key that a fact may carry while it looks for its own.
LOG_VERSIONS = 128


def not_after(times: Column, at: Column, most: int) -> Column:
    """How many of the sorted ``times`` (at most ``most``) are not after ``at``."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(most, 1).bit_length()))])

    def step(passed: Column, width: Column) -> Column:
        reached = passed + width
        inside = (reached <= F.size(times)) & (F.get(times, reached - 1) <= at)
        return F.when(inside, reached).otherwise(passed)

    return F.aggregate(steps, F.lit(0), step)


def as_of_join(facts: DataFrame, versions: DataFrame, on: Sequence[str], at: str, version_at: str, seq: str,
               position: Sequence[str] = (), how: str = "inner", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``facts`` with the columns of their version, less its time and sequence number.

    ``position`` names columns of the facts that tell rows of one key and time apart; they spread such piles.
    """
    brought = [c for c in versions.columns if c not in (*on, version_at, seq)]
    known = versions.select(
        *on, F.coalesce(F.col(version_at).cast("bigint"), F.lit(BEGINNING)).alias("_at"),
        F.col(seq).alias("_seq"), F.struct(*brought).alias("_version"))
    # A frame may not know its size; what is written does.
    known = stored(known, "versions")
    timed = facts.withColumn("_fact_at", F.coalesce(F.col(at).cast("bigint"), F.lit(BEGINNING)))
    if planned_bytes(known) <= limit and longest_log(known, on) <= LOG_VERSIONS:
        found = _looked_up(timed, known, on)
    else:
        found = _carried(timed, known, on, position)
    if how == "inner":
        found = found.where(F.col("_version").isNotNull())
    return found.select(*facts.columns, *[F.col("_version")[c].alias(c) for c in brought])


def longest_log(versions: DataFrame, on: Sequence[str]) -> int:
    return versions.groupBy(*on).count().agg(F.max("count")).first()[0] or 0


def _looked_up(facts: DataFrame, versions: DataFrame, on: Sequence[str]) -> DataFrame:
    log = versions.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("_at", "_seq", "_version"))).alias("_log"))
    log = stored(log.select(*on, F.col("_log._at").alias("_times"), F.col("_log._version").alias("_versions")), "versions-by-key")
    most = log.agg(F.max(F.size("_times"))).first()[0] or 1
    same = [F.col(f"_f.{c}").eqNullSafe(F.col(f"_v.{c}")) for c in on]
    joined = facts.alias("_f").join(F.broadcast(log.alias("_v")), same, "left").select("_f.*", "_times", "_versions")
    passed = not_after(F.col("_times"), F.col("_fact_at"), most)
    return joined.withColumn("_version", F.get("_versions", passed - 1)).drop("_times", "_versions")


def _carried(facts: DataFrame, versions: DataFrame, on: Sequence[str], position: Sequence[str]) -> DataFrame:
    place = F.xxhash64(*position) if position else F.lit(0).cast("bigint")
    merged = facts.select(
        *on, F.col("_fact_at").alias("_at"), F.lit(1).alias("_kind"), place.alias("_place"),
        F.struct(*[c for c in facts.columns]).alias("_fact")).unionByName(
        versions.select(*on, "_at", F.lit(0).alias("_kind"), F.col("_seq").cast("bigint").alias("_place"), "_version"),
        allowMissingColumns=True)
    order = ["_at", "_kind", "_place"]
    ranged = stored(merged.repartitionByRange(*on, *order).withColumn("_range", F.spark_partition_id()), "merged-logs")
    # One row per key and range: the last version there, and the last one of the ranges before.
    last = F.max_by(F.struct("_version"), F.when(F.col("_kind") == 0, F.struct(*order)))
    ends = ranged.groupBy(*on, "_range").agg(last.alias("_last"))
    before = Window.partitionBy(*on).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_start", F.last("_last", ignorenulls=True).over(before)).select(*on, "_range", "_start")
    same = [F.col("_r._range") == F.col("_s._range")]
    same += [F.col(f"_r.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in on]
    both = ranged.alias("_r").join(starts.alias("_s"), same).select("_r.*", "_start")
    so_far = Window.partitionBy(*on, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last(F.when(F.col("_kind") == 0, F.struct("_version")), ignorenulls=True).over(so_far)
    return (both.withColumn("_in_force", F.coalesce(carried, "_start")).where(F.col("_kind") == 1)
            .select("_fact.*", F.col("_in_force._version").alias("_version")))
