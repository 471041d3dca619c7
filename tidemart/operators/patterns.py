"""Patterns over the records of a key: begin, next, followed-by, within a time limit.

A pattern is compiled to a bounded automaton. Every record that meets the first condition starts one attempt.
A ``next`` step must be met by the very next record of the key, a ``followed_by`` step by the first later record
that meets it. An attempt whose last step comes less than the limit after its start is a match; one that a
``next`` step fails in that time is dropped; every other one is a timeout, which keeps the steps it has reached.

The outcome of an attempt depends only on what follows, so it is computed backwards: for each step, last one
first, the outcome of waiting for it is that of the nearest later record which takes it. That is one window pass
per step over one sort. As nothing beyond the limit counts, a key's records are cut into time slices, and records
just after a slice's end are copied into it. A slice that is still heavy is cut by position into chunks: the
outcome of waiting at a chunk's end is that of waiting at the start of the next one, folded from the last
chunk to the first. No key and no slice of a key has to be in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.functions.times import floor_div
from tidemart.operators.joins import BROADCAST_LIMIT, planned_bytes
from tidemart.session import stored

SLICES_PER_LIMIT = 12
# Rows of one window task at most, and how many sampled places lie between two cuts.
CHUNK_ROWS = 1_000_000
PLACES_PER_CHUNK = 16
MATCH = "match"
TIMEOUT = "timeout"
TAKEN = "array<struct<ts:bigint,id:bigint>>"


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column
    strict: bool


@dataclass(frozen=True)
class Pattern:
    steps: tuple[Step, ...]
    limit_ms: int = 0

    @staticmethod
    def begin(name: str, condition: Column) -> Pattern:
        return Pattern((Step(name, condition, False),))

    def next(self, name: str, condition: Column) -> Pattern:
        return replace(self, steps=(*self.steps, Step(name, condition, True)))

    def followed_by(self, name: str, condition: Column) -> Pattern:
        return replace(self, steps=(*self.steps, Step(name, condition, False)))

    def within(self, limit_ms: int) -> Pattern:
        return replace(self, limit_ms=limit_ms)

    @property
    def strict(self) -> tuple[bool, ...]:
        return tuple(step.strict for step in self.steps)

    def met(self) -> list[Column]:
        """Whether a record meets each step; a condition that is null is not met."""
        return [F.coalesce(step.condition, F.lit(False)) for step in self.steps]

    def slice_ms(self, wanted: int | None = None) -> int:
        return max(wanted or SLICES_PER_LIMIT * self.limit_ms, self.limit_ms)


def time_slices(ms: Column, limit_ms: int, slice_ms: int) -> Column:
    """The slice of a record, and also the slice before it when the record may follow a start there."""
    own = floor_div(ms, slice_ms)
    return F.when(F.pmod(ms, F.lit(slice_ms)) < limit_ms, F.array(own, own - 1)).otherwise(F.array(own))


def detect(rows: DataFrame, pattern: Pattern, key: Column, ts: str = "ts", rec_id: str = "rec_id",
           slice_ms: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(record, outcome, taken) of every attempt that ends in a match or a timeout.

    ``record`` is the starting row as a struct, ``taken`` the (ts, id) of each step reached in time.
    """
    slice_ms = pattern.slice_ms(slice_ms)
    met = pattern.met()
    # Only starts can come out, so every other record travels without its payload.
    sliced = rows.select(
        key.alias("_mid"), F.col(ts).alias("_ts"), F.col(rec_id).alias("_id"),
        *[m.alias(f"_is{k}") for k, m in enumerate(met, 1)],
        F.when(met[0], F.struct(*rows.columns)).alias("_r"),
        F.explode(time_slices(F.col(ts), pattern.limit_ms, slice_ms)).alias("_slice"))
    if not any(pattern.strict):
        sliced = sliced.where(" OR ".join(f"_is{k}" for k in range(1, len(met) + 1)))
    sliced = (sliced.withColumn("_own", F.col("_slice") == floor_div(F.col("_ts"), slice_ms))
              .withColumn("_r", F.when(F.col("_own"), F.col("_r"))))
    hot = hot_groups(sliced, F.struct("_ts", "_id"), chunk_rows)
    if hot is None:
        starts = _backwards(sliced, pattern, ["_mid", "_slice"]).where("_own AND _is1")
    else:
        starts = _over_chunks(in_chunks(sliced, hot), pattern)
    return _outcomes(starts, pattern)


def _outcome(taken: str, wait: int | str, dead: str = "CAST(NULL AS BIGINT)") -> str:
    """SQL of an outcome: steps taken, the step it still waits for (0: none), the time at which it failed."""
    return f"named_struct('at', CAST({taken} AS {TAKEN}), 'wait', {wait}, 'dead', {dead})"


_HERE = "array(named_struct('ts', _ts, 'id', _id))"


def _take(k: int, last: int) -> str:
    """Outcome of a record that takes step k: itself, then that of waiting for the next step."""
    if k == last:
        return _outcome(_HERE, 0)
    return _outcome(f"concat({_HERE}, _n{k + 1}.at)", f"_n{k + 1}.wait", f"_n{k + 1}.dead")


def _tried(k: int, strict: bool, last: int) -> str:
    """Outcome that a record gives to attempts waiting for step k; null where they pass over it."""
    failed = _outcome("array()", 0, "_ts") if strict else "NULL"
    return f"CASE WHEN _is{k} THEN {_take(k, last)} ELSE {failed} END"


def _backwards(rows: DataFrame, pattern: Pattern, group: list[str]) -> DataFrame:
    """``_n2`` and up: the outcome of waiting for each step behind a row, as far as the group goes."""
    last = len(pattern.steps)
    # From the last row to the first, so that the frame of what follows only grows.
    back = Window.partitionBy(*group).orderBy(F.col("_ts").desc(), F.col("_id").desc())
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    for k in range(last, 1, -1):
        strict = pattern.steps[k - 1].strict
        tried = F.expr(_tried(k, strict, last))
        found = F.lag(tried).over(back) if strict else F.last(tried, ignorenulls=True).over(later)
        rows = rows.withColumn(f"_n{k}", F.coalesce(found, F.expr(_outcome("array()", k))))
    return rows


def _outcomes(starts: DataFrame, pattern: Pattern) -> DataFrame:
    """Decide each attempt by the times at which it was completed or failed."""
    limit, last = pattern.limit_ms, len(pattern.steps)
    ended = starts.select("_r", "_ts", F.expr(_take(1, last)).alias("_e"))
    in_time = ended.withColumn("taken", F.expr(f"filter(_e.at, x -> x.ts - _ts < {limit})"))
    whole = (F.col("_e.wait") == 0) & F.col("_e.dead").isNull() & (F.size("taken") == last)
    failed = F.coalesce(F.col("_e.dead") - F.col("_ts") < limit, F.lit(False))
    return in_time.where(~failed).select(
        F.col("_r").alias("record"), F.when(whole, MATCH).otherwise(TIMEOUT).alias("outcome"), "taken")


# ------------------------------------------------------------ heavy slices

def if_small(rows: DataFrame) -> DataFrame:
    """A stored table, broadcast if its files are small."""
    return F.broadcast(rows) if planned_bytes(rows) <= BROADCAST_LIMIT else rows


def hot_groups(rows: DataFrame, place: Column, chunk_rows: int = CHUNK_ROWS) -> DataFrame | None:
    """(_hmid, _hslice) groups of more than ``chunk_rows`` rows with the places to cut them; None without any.

    Groups are counted over all rows. Their cuts come from places picked by a hash of the record id, about
    ``PLACES_PER_CHUNK`` in ``chunk_rows``, so chunks keep their size and their number grows with the data.
    An uneven cut only costs time. There is one cut per chunk, so the answer is small beside the data; it
    is a stored table, and its joins are broadcast only if that is small.
    """
    counted = (rows.groupBy("_mid", "_slice").agg(F.count("*").alias("n")).where(F.col("n") > chunk_rows)
               .select(F.col("_mid").alias("_hmid"), F.col("_slice").alias("_hslice")))
    counted = stored(counted, "hot-groups")
    if counted.isEmpty():
        return None
    picked = F.pmod(F.xxhash64("_id", "_ts"), F.lit(chunk_rows)) < PLACES_PER_CHUNK
    within = rows.where(picked).join(if_small(counted), _same_group())
    cuts = (f"transform(sequence({PLACES_PER_CHUNK}, greatest(n - 1, {PLACES_PER_CHUNK}), {PLACES_PER_CHUNK}), "
            "i -> get(p, CAST(i AS INT))) AS _cuts")
    found = stored(within.groupBy("_hmid", "_hslice")
                   .agg(F.count("*").alias("n"), F.sort_array(F.collect_list(place)).alias("p"))
                   .where(F.col("n") > PLACES_PER_CHUNK).selectExpr("_hmid", "_hslice", cuts), "hot-cuts")
    return None if found.isEmpty() else found


def _same_group() -> Column:
    return F.col("_mid").eqNullSafe(F.col("_hmid")) & (F.col("_slice") == F.col("_hslice"))


def cuts_before(position: Column) -> Column:
    """How many of the sorted ``_cuts`` are not after a position, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(30))])

    def step(passed: Column, width: Column) -> Column:
        reached = passed + width
        inside = (reached <= F.size("_cuts")) & (F.get("_cuts", reached - 1) <= position)
        return F.when(inside, reached).otherwise(passed)

    return F.aggregate(steps, F.lit(0), step)


def in_chunks(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``_chunk``: the number of a row's chunk in a hot group; null in all other groups."""
    chunk = F.when(F.col("_cuts").isNotNull(), cuts_before(F.struct("_ts", "_id")))
    return (rows.join(if_small(hot), _same_group(), "left").withColumn("_chunk", chunk)
            .drop("_hmid", "_hslice", "_cuts"))


def _over_chunks(rows: DataFrame, pattern: Pattern) -> DataFrame:
    """Starts with outcomes that go on from chunk to chunk."""
    last, group = len(pattern.steps), ["_mid", "_slice", "_chunk"]
    if last == 1:
        return rows.where("_own AND _is1")
    done = stored(_backwards(rows, pattern, group), "pattern-chunks")
    steps = range(2, last + 1)
    # Per chunk, what happens to an attempt that waits for a step where the chunk begins.
    firsts = [F.min_by(F.expr(_tried(k, pattern.steps[k - 1].strict, last)), F.when(
        F.lit(pattern.steps[k - 1].strict) | F.col(f"_is{k}"), F.struct("_ts", "_id"))) for k in steps]
    entered = [F.coalesce(f, F.expr(_outcome("array()", k))) for f, k in zip(firsts, steps)]
    chunks = done.where("_chunk IS NOT NULL").groupBy(*group).agg(F.array(*entered).alias("_entered"))
    going_on = "acc[size(acc) - 1]._entered[o.wait - 2]"
    joined = _outcome(f"concat(o.at, {going_on}.at)", f"{going_on}.wait", f"{going_on}.dead")
    folded = f"""aggregate(
        reverse(sort_array(collect_list(struct(_chunk, _entered)))),
        CAST(array() AS array<struct<_chunk:int,_entered:array<struct<at:{TAKEN},wait:int,dead:bigint>>>>),
        (acc, f) -> concat(acc, array(named_struct('_chunk', f._chunk, '_entered',
            transform(f._entered, o -> CASE WHEN o.wait > 0 AND size(acc) > 0 THEN {joined} ELSE o END)))))"""
    carried = stored(chunks.groupBy("_mid", "_slice").agg(F.expr(folded).alias("_all"))
                     .select(F.col("_mid").alias("_hmid"), F.col("_slice").alias("_hslice"), F.explode("_all").alias("_c"))
                     .select("_hmid", "_hslice", "_c.*").withColumnRenamed("_chunk", "_hchunk"), "pattern-carried")
    after = _same_group() & (F.col("_chunk") + 1 == F.col("_hchunk"))
    starts = done.where("_own AND _is1").join(if_small(carried), after, "left")
    going_on = "_entered[_n2.wait - 2]"
    more = _outcome(f"concat(_n2.at, {going_on}.at)", f"{going_on}.wait", f"{going_on}.dead")
    return starts.withColumn("_n2", F.expr(f"CASE WHEN _n2.wait > 0 AND _entered IS NOT NULL THEN {more} ELSE _n2 END"))
