"""Patterns of several steps: tables, chunks of heavy slices, streams and their state."""

import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemart.operators import patterns
from tidemart.operators.patterns import Pattern
from tidemart.plans.stream_catalog import CLOSING_PAGE
from tidemart.schemas import PAGE_LOG
from tidemart.session import shared_dir
from tidemart.streaming import jobs, runner
from tidemart.streaming.processors import PatternAttempts
from tidemart.streaming.runner import Feed, replay

ROWS = "mid string, page string, ts long, rec_id long"
# Kinds of the steps after the first: n is the very next record, f any later one.
SHAPES = ["", "n", "f", "ff", "nf", "fn", "nfn", "fff"]


def pattern(shape, limit, column="page"):
    found = Pattern.begin("s0", F.col(column) == "a")
    for k, kind in enumerate(shape):
        condition = F.col(column) == "bca"[k]
        found = found.next(f"s{k + 1}", condition) if kind == "n" else found.followed_by(f"s{k + 1}", condition)
    return found.within(limit)


def plain(rows, shape, limit):
    out = []
    by_key = {}
    for mid, page, ts, rec_id in rows:
        by_key.setdefault(mid, []).append((ts, rec_id, page))
    for seen in by_key.values():
        seen.sort()
        for i, (ts, rec_id, page) in enumerate(seen):
            if page != "a":
                continue
            taken, at, outcome = [(ts, rec_id)], i, None
            for k, kind in enumerate(shape):
                at += 1
                if kind == "f":
                    while at < len(seen) and seen[at][2] != "bca"[k]:
                        at += 1
                if at >= len(seen) or seen[at][0] - ts >= limit:
                    outcome = "timeout"
                    break
                if seen[at][2] != "bca"[k]:
                    outcome = "failed"
                    break
                taken.append(seen[at][:2])
            if outcome != "failed":
                out.append((rec_id, outcome or "match", [i for _, i in taken]))
    return sorted(out)


def drawn(seed, n, span):
    draw = random.Random(seed)
    return [("hot" if draw.random() < 0.6 else draw.choice(["x", "y", None]), draw.choice(["a", "b", "c", "d", None]),
             500 if draw.random() < 0.2 else draw.randrange(0, span), k) for k in range(n)]


def found(frame):
    return sorted((r.rec_id, r.outcome, list(r.ids)) for r in frame.select(
        "record.rec_id", "outcome", F.col("taken.id").alias("ids")).collect())


@pytest.mark.parametrize("shape", SHAPES)
def test_tables_against_brute_force(spark, shape):
    rows = drawn(len(shape) + 1, 1500, 60_000)
    table = spark.createDataFrame(rows, ROWS).repartition(4)
    want = plain(rows, shape, 3000)
    assert found(patterns.detect(table, pattern(shape, 3000), F.col("mid"), slice_ms=7000)) == want
    # The same where every slice of more than twelve records is cut into chunks.
    assert found(patterns.detect(table, pattern(shape, 3000), F.col("mid"), chunk_rows=12)) == want


def test_nothing_in_nothing_out(spark):
    empty = spark.createDataFrame([], ROWS)
    assert patterns.detect(empty, pattern("nf", 3000), F.col("mid")).isEmpty()


def test_one_sort_and_no_window_over_what_follows(spark):
    table = spark.createDataFrame(drawn(1, 50, 1000), ROWS)
    plan = patterns.detect(table, pattern("fff", 3000), F.col("mid"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "unboundedfollowing" not in plan.lower()
    assert plan.count("Exchange hashpartitioning") == 1


def feeds(spark, rows):
    lines = [(ts, json.dumps({"common": {"mid": mid}, "page": {"page_id": page}, "ts": ts, "rec_id": rec_id}))
             for mid, page, ts, rec_id in rows]
    return {"log": Feed(spark.createDataFrame(lines, "ts long, value string"), CLOSING_PAGE)}


def page_pattern(shape, limit):
    return pattern(shape, limit, "page.page_id")


@pytest.mark.parametrize("shape", ["nf", "ff"])
def test_streams_against_brute_force(spark, shape):
    """Four rounds with records up to five seconds late."""
    rows = [r for r in drawn(9, 500, 60_000) if r[0]]
    out = replay(spark, "t_pattern", feeds(spark, rows),
                 lambda t: jobs.pattern_attempts(t["log"], page_pattern(shape, 3000), "6 seconds", 7000),
                 rounds=4, shuffle_ms=5000, partitions=2)
    value = F.from_json("value", PAGE_LOG)
    got = out.select(value["rec_id"].alias("rec_id"), "outcome", "ids").collect()
    assert sorted((r.rec_id, r.outcome, list(r.ids)) for r in got) == plain(rows, shape, 3000)


def test_state_ends_with_the_limit(spark):
    """However long the log, only the buckets of the last two limits stay."""
    rows = [(f"m{k % 5}", "abcd"[k % 4], 1000 * k, k) for k in range(600)]
    base, left = shared_dir(spark, "t_pattern_state"), []

    def run(topics):
        found = jobs.pattern_attempts(topics["log"], page_pattern("ff", 5000))
        query = runner.file_sink(found, f"{base}/out", f"{base}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        left.append(query.lastProgress.stateOperators[0].numRowsTotal)

    runner.feed_rounds(spark, base, feeds(spark, rows), run, 4, partitions=2)
    state = spark.read.format("statestore").option("stateVarName", "buckets").load(f"{base}/checkpoint")
    assert max(left) <= 5 * 6 and state.count() <= 5 * 6


class Handle:
    """Buckets and timers in memory; calls are counted."""

    def __init__(self):
        self.calls, self.kept, self.timers = 0, {}, set()

    def called(self, result=None):
        self.calls += 1
        return result

    def getMapState(self, name, *schemas):
        return self

    def registerTimer(self, at):
        self.called(self.timers.add(at))

    def exists(self):
        return self.called(bool(self.kept))

    def keys(self):
        return self.called(iter(list(self.kept)))

    def iterator(self):
        return self.called(iter(list(self.kept.items())))

    def getValue(self, key):
        return self.called(self.kept.get(key))

    def updateValue(self, key, value):
        self.called(self.kept.update({key: value}))

    def removeKey(self, key):
        self.called(self.kept.pop(key))

    def clear(self):
        self.called(self.kept.clear())


def test_a_key_has_one_timer(spark):
    """Twelve buckets cost about one call each; what is not due waits for a timer of its own."""
    handle, job = Handle(), PatternAttempts((False, True), 1000)
    job.init(handle)

    def give(*times):
        rows = [SimpleNamespace(ts=t, rec_id=t, met=3, own=True, value=str(t)) for t in times]
        assert list(job.handleInputRows(("m",), iter(rows), None)) == []

    def wake(mark):
        out = []
        for at in sorted(t for t in handle.timers if t <= mark):
            out += job.handleExpiredTimer(("m",), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None)
            handle.timers.discard(at)
        return [(r.value, r.outcome) for r in out]

    give(*range(1500, 13_500, 1000))
    assert handle.timers == {3000}
    assert handle.calls <= 14
    give(500, 2900)
    assert handle.timers == {2000, 3000}
    assert wake(6000) == [("500", "timeout"), ("1500", "timeout"), ("2500", "match"), ("2900", "match"),
                          ("3500", "timeout"), ("4500", "timeout")]
    assert handle.timers == {7000} and min(handle.kept) == (5,)
    handle.calls = 0
    assert len(wake(99_000)) == 8 and not handle.kept and not handle.timers
    assert handle.calls <= 3
