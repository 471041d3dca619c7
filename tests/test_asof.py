"""As-of joins in both physical forms, and routing by edits in a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import asof
from tidemart.operators.asof import as_of_join
from tidemart.operators.cdc import config_versions
from tidemart.schemas import CONFIG_LINE
from tidemart.streaming import jobs
from tidemart.streaming.processors import RouteAsOf
from tidemart.streaming.runner import Feed, replay

FACTS = "k string, o string, at long, pos long"
VERSIONS = "k string, o string, since long, seq long, name string"


def plain(facts, versions, how):
    out = []
    for k, o, at, pos in facts:
        at = -(1 << 63) if at is None else at
        known = [(-(1 << 63) if since is None else since, seq, name) for a, b, since, seq, name in versions
                 if (a, b) == (k, o)]
        known = [v for v in known if v[0] <= at]
        if known:
            out.append((pos, max(known)[2]))
        elif how == "left":
            out.append((pos, None))
    return sorted(out)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [1 << 40, 0])
def test_as_of_against_brute_force(spark, how, limit):
    """One key holds two thirds of the facts, half of them at one time; keys and times may be null."""
    draw = random.Random(5)
    keys = ["hot", "hot", "hot", "hot", "a", None, "none"]
    facts = [(draw.choice(keys), "i", draw.choice([None, 50, 50, 50, draw.randint(-10, 300)]), n) for n in range(3000)]
    versions = [(draw.choice(["hot", "a", None, "unused"]), draw.choice("iu"), draw.choice([None, draw.randint(0, 300)]),
                 n, f"v{n}") for n in range(400)]
    given = spark.createDataFrame(facts, FACTS).repartition(6), spark.createDataFrame(versions, VERSIONS)
    got = as_of_join(*given, ["k", "o"], "at", "since", "seq", ["pos"], how, limit)
    assert got.columns == ["k", "o", "at", "pos", "name"]
    assert sorted((r.pos, r.name) for r in got.collect()) == plain(facts, versions, how)


def test_a_hot_key_is_spread_over_ranges(spark):
    facts = spark.range(20_000).selectExpr("'hot' AS k", "'i' AS o", "id % 3 AS at", "id AS pos")
    versions = spark.createDataFrame([("hot", "i", t, t, f"v{t}") for t in range(3)], VERSIONS)
    merged = facts.repartitionByRange(8, "k", "at", F.xxhash64("pos"))
    sizes = [r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 20_000 / 8
    got = as_of_join(facts, versions, ["k", "o"], "at", "since", "seq", ["pos"], limit=0)
    assert {(r.at, r.name): r["count"] for r in got.groupBy("at", "name").count().collect()} == {
        (0, "v0"): 6667, (1, "v1"): 6667, (2, "v2"): 6666}


def test_few_versions_leave_the_facts_where_they_are(spark):
    facts = spark.range(100).selectExpr("chr(97 + id div 100) AS k", "chr(105 + id div 100) AS o", "id AS at", "id AS pos")
    versions = spark.createDataFrame([("a", "i", 5, 1, "v")], VERSIONS)
    joined = as_of_join(facts, versions, ["k", "o"], "at", "since", "seq", limit=1 << 40)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert joined.count() == 95


def test_a_long_history_of_one_key_is_carried(spark, monkeypatch):
    """However small the versions are, no fact is joined with thousands of them."""
    facts = spark.range(2000).selectExpr("'hot' AS k", "'i' AS o", "id AS at", "id AS pos")
    versions = spark.range(1000).selectExpr("'hot' AS k", "'i' AS o", "id * 2 AS since", "id AS seq", "concat('v', id) AS name")
    monkeypatch.setattr(asof, "_looked_up", None)
    got = as_of_join(facts, versions, ["k", "o"], "at", "since", "seq", ["pos"], limit=1 << 40)
    assert all(r.name == f"v{r.at // 2}" for r in got.collect()) and got.count() == 2000


def edit(table, topic, op, at, seq):
    return (table, "insert", "kafka", topic, "id", None, None, op, at, seq)


def test_routes_change_between_runs_of_the_stream(spark):
    """Edits come in later rounds, late changes follow the route of their own time, old routes are forgotten."""
    known = config_versions(spark.createDataFrame([edit("t", "first", "snapshot", None, 1)], CONFIG_LINE))
    edits = [edit("t", "second", "update", 100, 2), edit("t", "gone", "delete", 150, 3),
             edit("t", "third", "insert", 200, 4), edit("u", "other", "insert", 100, 5)]
    names = CONFIG_LINE.fieldNames()
    config = [(at, json.dumps(dict(zip(names, (*rest, at, seq))))) for *rest, at, seq in edits]

    def change(table, ts, arrival):
        return arrival, json.dumps({"database": "d", "table": table, "type": "insert", "ts": ts, "xid": ts,
                                    "xoffset": 0, "data": json.dumps({"id": ts})})

    changes = [change("t", ts, ts) for ts in (0, 99, 100, 160, 200, 300)] + [change("t", 101, 290), change("u", 99, 99),
                                                                             change("u", 120, 120)]
    feeds = {name: Feed(spark.createDataFrame(rows, "ts long, value string"))
             for name, rows in (("db", changes), ("config", config))}
    want = {("t", 0): "first", ("t", 99): "first", ("t", 100): "second", ("t", 101): "second", ("t", 160): "second",
            ("t", 200): "third", ("t", 300): "third", ("u", 120): "other"}
    for keep in (None, 1000):
        out = replay(spark, "t_routes", feeds, lambda t: jobs.routes_as_of(t["db"], t["config"], known, keep, 2),
                     rounds=3, partitions=2)
        assert {(r.table, r.ts): r.sink_table for r in out.collect()} == want
        assert out.where("data.id IS NULL").isEmpty()
    out = replay(spark, "t_routes", feeds, lambda t: jobs.routes_as_of(t["db"], t["config"], known, 0, 1),
                 rounds=3, partitions=2)
    late = {(r.table, r.ts): r.sink_table for r in out.collect()}
    assert late == {k: v for k, v in want.items() if k != ("t", 101)}


class Handle:
    """Map states in memory that count the calls."""

    def __init__(self):
        self.calls = 0
        self.kept = {}

    def getMapState(self, name, *schemas):
        return self

    def keys(self):
        self.calls += 1
        return iter(list(self.kept))

    def getValue(self, key):
        self.calls += 1
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.kept[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.kept[key]


@pytest.mark.parametrize("keep", [None, 700])
def test_routes_are_kept_in_blocks(keep):
    """Calls of the state grow with blocks, not with routes; later and earlier routes come in any order."""
    draw, handle, job = random.Random(3), Handle(), RouteAsOf(keep)
    job.init(handle)
    known, newest = {}, 0
    for batch in range(4):
        edits = [(draw.randint(-500, 40_000), n + 10_000 * batch, f"r{batch}.{n}") for n in range(5000)]
        changes = [draw.randint(-600, 41_000) for _ in range(300)]
        packs = [json.dumps(edits[k:k + 512]) for k in range(0, 5000, 512)]
        rows = [{"routes": p} for p in packs] + [{"routes": None, "at": at, "value": str(at)} for at in changes]
        draw.shuffle(rows)
        handle.calls = 0
        got = sorted((int(r.value), r.route) for r in job.handleInputRows(("t",), iter(rows), None))
        assert handle.calls < 500
        for at, seq, route in edits:
            known[at] = max(known.get(at, (-1, "")), (seq, route))
        newest = max(known)
        if keep is not None:
            first = max(at for at in known if at <= newest - keep)
            known = {at: value for at, value in known.items() if at >= first}
        want = []
        for at in changes:
            before = [t for t in known if t <= at]
            if before:
                want.append((at, known[max(before)][1]))
        assert got == sorted(want)
    assert max(len(json.loads(rows)) for rows, in handle.kept.values()) <= 2 * job.BLOCK


@pytest.mark.parametrize("held", [7, 100])
def test_changes_of_a_batch_are_held_in_files(monkeypatch, held):
    """However many changes a key has in one batch, few are held; they come out by time, and of one time as they came."""
    monkeypatch.setattr(RouteAsOf, "HELD_CHANGES", held)
    monkeypatch.setattr(RouteAsOf, "READ_CHANGES", 3)
    sizes, sorted_run = [], RouteAsOf._sorted_run
    monkeypatch.setattr(RouteAsOf, "_sorted_run", lambda self, changes, file: (
        sizes.append(len(changes)), sorted_run(self, changes, file))[1])
    draw, job = random.Random(9), RouteAsOf(None)
    job.init(Handle())
    changes = [(draw.randrange(50), n) for n in range(1000)]
    rows = [{"routes": None, "at": at, "value": str(n)} for at, n in changes]
    rows.append({"routes": json.dumps([(10, 1, "a"), (30, 2, "b")])})
    got = [(int(r.value), r.route) for r in job.handleInputRows(("t",), iter(rows), None)]
    assert got == [(n, "a" if at < 30 else "b") for at, n in sorted(changes, key=lambda c: c[0]) if at >= 10]
    assert sizes == [held] * (1000 // held)
