"""Streaming jobs against their table twins: several rounds, late rows, restarts from a checkpoint."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemart.functions.texts import to_lines
from tidemart.operators import logs, sequences
from tidemart.plans.catalog import HOUR, flat_log, pages
from tidemart.plans.stream_catalog import CLOSING_PAGE
from tidemart.schemas import PAGE_LOG
from tidemart.session import shared_dir
from tidemart.sinks import dims, stats, topics
from tidemart.sources import tables
from tidemart.sources.topics import broker_options, by_topic, read_files
from tidemart.streaming import jobs, runner
from tidemart.streaming.runner import Feed, replay


def rows(df):
    return sorted(map(str, df.collect()))


def feed(log):
    return {"log": Feed(to_lines(log, "ts"), CLOSING_PAGE)}


def parsed(df):
    return flat_log(logs.parse_lines(df, PAGE_LOG))


def test_late_rows_inside_the_delay_change_nothing(spark, sample):
    """Rows arrive up to four hours late in four rounds; the jobs accept five."""
    page = pages(sample)
    late = dict(rounds=4, shuffle_ms=4 * HOUR)
    got = replay(spark, "t_jump", feed(page), lambda t: jobs.bounces(t["log"], 6 * HOUR, "5 hours"), **late)
    assert rows(parsed(got)) == rows(flat_log(sequences.bounces(page, 6 * HOUR)))
    got = replay(spark, "t_uv", feed(page),
                 lambda t: jobs.daily_first_visit(t["log"], "1 hour", "5 hours"), **late)
    assert rows(parsed(got)) == rows(flat_log(sequences.daily_first_visit(page)))
    log = sample.log()
    got = replay(spark, "t_new", feed(log), lambda t: jobs.repair_is_new(t["log"], 3600, "5 hours"), **late)
    assert rows(flat_log(got)) == rows(flat_log(sequences.repair_is_new(log)))


@pytest.mark.parametrize("both", [True, False])
def test_known_bounce_rows_as_a_stream(spark, both):
    known = [("101", None, 1000), ("101", None, 2000), ("102", None, 1000), ("102", "home", 7000),
             ("102", "detail", 50000)]
    lines = [(ts, json.dumps({"common": {"mid": m}, "page": {"last_page_id": last}, "ts": ts, "rec_id": i}))
             for i, (m, last, ts) in enumerate(known)]
    feeds = {"log": Feed(spark.createDataFrame(lines, "ts long, value string"), CLOSING_PAGE)}
    out = replay(spark, "t_known", feeds, lambda t: jobs.bounces(t["log"], entry_after_entry=both), rounds=3)
    want = [("101", 2000), ("102", 1000)] + ([("101", 1000)] if both else [])
    got = logs.parse_lines(out, PAGE_LOG).select("common.mid", "ts").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_topic_files_come_back_by_topic(spark, tmp_path):
    lines = topics.topic_lines(spark.range(3), "a").unionByName(topics.topic_lines(spark.range(2), "b"))
    lines.write.partitionBy("topic").parquet(f"{tmp_path}/in")
    stream = read_files(spark, f"{tmp_path}/in", max_files=1)
    runner.catch_up(topics.file_writer(stream, f"{tmp_path}/out", f"{tmp_path}/ck"))
    back = by_topic(spark.read.parquet(f"{tmp_path}/out"), ["a", "b"])
    assert [back[t].count() for t in "ab"] == [3, 2]
    assert json.loads(back["a"].first()["value"]).keys() == {"id"}


def test_broker_options():
    options = broker_options("h1:9092,h2:9092", ["x", "y"], "g", 1000)
    assert options["subscribe"] == "x,y" and options["startingOffsets"] == "latest"
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["maxOffsetsPerTrigger"] == "1000"


def routed(spark, *users):
    data = [("dim_user", "id,name", None, {"id": i, **({"name": n} if n else {})}, ts, 0, 0)
            for i, n, ts in users]
    return spark.createDataFrame(
        data, "sink_table string, sink_columns string, sink_pk string, data map<string,string>, "
              "ts long, xid long, xoffset long")


def test_dimension_batches(spark, tmp_path):
    path = str(tmp_path / "dims")
    dims.write_batch(routed(spark, ("1", "a", 1), ("2", "b", 1), ("1", "c", 2)), path, 0)
    for _ in range(2):  # the same batch again after a failure
        dims.write_batch(routed(spark, ("2", None, 3), ("3", "d", 3)), path, 1)
    want = [("1", "c"), ("2", ""), ("3", "d")]

    def current(where):
        return sorted(map(tuple, tables.read_dim(spark, where, "dim_user", ["id", "name"]).collect()))

    assert current(path) == want
    dims.compact(spark.read.parquet(path), f"{tmp_path}/compact")
    assert current(f"{tmp_path}/compact") == want
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 3


def test_statistics_table_reads_only_the_asked_day(spark, tmp_path):
    made = spark.createDataFrame(
        [("2024-03-01 00:00:00", 1, "x"), ("2024-03-02 00:00:00", 2, "y")], "stt string, ct long, helper string")
    path = str(tmp_path / "stats")
    for _ in range(2):  # writing a day again replaces it
        stats.write_table(made, path, ["stt", "ct"])
    day = tables.read_stats(spark, path, 20240302, 20240302)
    assert day.columns == ["stt", "ct", "dt"] and [r["ct"] for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_written_statistics_are_computed_once(spark, tmp_path):
    """Sparse days beside a heavy one: all rows arrive, and none is computed once more to be dealt out."""
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    heavy = spark.range(20_000).selectExpr("'2024-01-01 00:00:00' AS stt", "id AS ct")
    sparse = spark.range(600).selectExpr(
        "date_format(timestamp'2025-01-01' + make_dt_interval(cast(id AS int)), 'yyyy-MM-dd HH:mm:ss') AS stt", "id AS ct")
    made = heavy.unionByName(sparse).mapInArrow(counted, "stt string, ct long")
    path = str(tmp_path / "stats")
    stats.write_table(made, path, ["stt", "ct"])
    assert computed.value == 20_600
    back = tables.read_stats(spark, path)
    assert (back.count(), back.select("dt").distinct().count()) == (20_600, 601)


def test_database_writer_takes_only_the_listed_columns(monkeypatch):
    seen = {}

    class Writer:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                seen.setdefault(name, []).append((args, kwargs))
                return self
            return call

    class Frame:
        write = Writer()

        def select(self, *columns):
            seen["columns"] = columns
            return self

    stats.jdbc_batch("jdbc:x", "t", ["a", "b"], "d.Driver", user="u")(Frame(), 0)
    assert seen["columns"] == ("a", "b") and (("batchsize", "1024"), {}) in seen["option"]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = spark.createDataFrame([(1, "x")], "ts long, value string")
    out = replay(spark, "t_settings", {"a": Feed(log)}, lambda t: t["a"], rounds=1)
    assert out.count() == 1 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_empty_feed(spark):
    nothing = spark.createDataFrame([], "ts long, value string")
    out = replay(spark, "t_empty", {"a": Feed(nothing)}, lambda t: t["a"].select(F.upper("value").alias("v")))
    assert out.columns == ["v"] and out.count() == 0


def test_shared_dir_is_below_the_named_folder(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/tidemart/x-")


def test_join_state_is_dropped_by_watermark(spark, sample):
    """After the closing lines only those lines are left in the join's state."""
    from tidemart.plans.catalog import PARAMS
    from tidemart.plans.stream_catalog import order_feeds

    base, left = shared_dir(spark, "t_state"), []

    def run(t):
        stream = jobs.order_wide(t["dwd_order_info"], t["dwd_order_detail"], None, None, PARAMS)
        writer = runner.file_sink(stream, f"{base}/out", f"{base}/checkpoint")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        left.append(query.lastProgress.stateOperators[0].numRowsTotal)

    runner.feed_rounds(spark, base, order_feeds(sample), run, 2)
    assert left[0] > 100 and left[-1] <= 4


def test_running_for_good(spark, tmp_path):
    """The continuous runner, default windows and the current time as statistics time."""
    def land(name, *texts):
        lines = [("p", json.dumps({"page": {"page_id": "good_list", "item": x}, "ts": ts})) for x, ts in texts]
        (spark.createDataFrame(lines, "topic string, value string")
         .write.mode("append").partitionBy("topic").parquet(f"{tmp_path}/in"))

    land("a", ("red ring RED", 1_000), ("ring", 9_000), ("ring", 11_000))
    found = jobs.keyword_stats(by_topic(read_files(spark, f"{tmp_path}/in"), ["p"])["p"])
    with runner.settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        query = runner.start(runner.file_sink(found, f"{tmp_path}/out", f"{tmp_path}/ck"), "1 second")
        try:
            query.processAllAvailable()
            land("b", ("end", 60_000))
            query.processAllAvailable()
        finally:
            query.stop()
    rows = spark.read.parquet(f"{tmp_path}/out").where("stt < '1970-01-01 00:00:10'").collect()
    assert sorted((r["keyword"], r["ct"], r["edt"]) for r in rows) == [
        ("red", 1, "1970-01-01 00:00:10"), ("ring", 2, "1970-01-01 00:00:10")]
    assert all(r["ts"] > 1_700_000_000_000 and r["ts"] % 1000 == 0 for r in rows)


def test_a_repeated_route_batch_writes_nothing_new(spark, sample, tmp_path):
    write = jobs.route_batch(sample.routes, str(tmp_path))
    lines = sample.change_lines().select("value")
    write(lines, 0)
    files = sorted(map(str, (tmp_path / "topics").rglob("*.parquet")))
    write(lines, 0)
    assert files and files == sorted(map(str, (tmp_path / "topics").rglob("*.parquet")))
    stream = read_files(spark, f"{tmp_path}/topics")
    assert stream.isStreaming


def test_lines_of_a_replay_are_written_small(spark):
    """Staged and landed lines, which repeat their field names, are written with the denser codec."""
    base = shared_dir(spark, "t_lines")
    lines = spark.range(20_000).selectExpr(
        "id AS ts", """concat('{"create_time":"', hash(id), '","order_id":', id, ',"split_total_amount":', hash(id) % 997, '}') AS value""")
    runner.feed_rounds(spark, base, {"log": runner.Feed(lines)}, lambda topics: None, 2)
    for folder in ("staged", "landing"):
        files = list(Path(base, folder).rglob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)
