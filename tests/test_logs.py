"""Log layer: splitting, displays, sequences, on hand-made rows and against brute force."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemart.operators import logs, patterns, sequences
from tidemart.schemas import PAGE_LOG
from tidemart.session import settings
from tidemart.sources.topics import broker_lines

HOME_ROWS = [  # mid, page, last page, ts
    ("101", "home", None, 1000), ("101", "home", None, 2000), ("102", "home", None, 1000),
    ("102", "good_list", "home", 7000), ("102", "good_list", "detail", 50000)]


def page_log(spark, rows):
    data = [Row(common={"mid": m}, page={"page_id": p, "last_page_id": last}, start=None, displays=None,
                ts=ts, rec_id=i) for i, (m, p, last, ts) in enumerate(rows)]
    return spark.createDataFrame([_plain(r) for r in data], PAGE_LOG)


def _plain(row):
    full = row.asDict()
    full["common"] = {f: full["common"].get(f) for f in PAGE_LOG["common"].dataType.fieldNames()}
    full["page"] = {f: full["page"].get(f) for f in PAGE_LOG["page"].dataType.fieldNames()}
    return full


def visits(df):
    return sorted((r["mid"], r["ts"]) for r in df.select("common.mid", "ts").collect())


def test_bounces_of_the_known_rows(spark):
    log = page_log(spark, HOME_ROWS)
    assert visits(sequences.bounces(log, entry_after_entry=False)) == [("101", 2000), ("102", 1000)]
    assert visits(sequences.bounces(log)) == [("101", 1000), ("101", 2000), ("102", 1000)]
    more = page_log(spark, HOME_ROWS + [("101", "home", None, 3000)])
    assert visits(sequences.bounces(more)) == [("101", 1000), ("101", 2000), ("101", 3000), ("102", 1000)]


def test_gap_of_exactly_the_limit_is_a_bounce(spark):
    log = page_log(spark, [("a", "home", None, 0), ("a", "x", "home", 5000),
                           ("b", "home", "", 0), ("b", "x", "home", 4999)])
    assert visits(sequences.bounces(log)) == [("a", 0)]


def brute_bounces(rows, limit, both):
    out = []
    order = sorted(enumerate(rows), key=lambda r: (r[1][0], r[1][3], r[0]))
    for (_, row), after in zip(order, order[1:] + [None]):
        mid, _, last, ts = row
        follow = after[1] if after and after[1][0] == mid else None
        if last in (None, ""):
            if follow is None or follow[3] - ts >= limit or (both and follow[2] in (None, "")):
                out.append((mid, ts))
    return sorted(out)


@pytest.mark.parametrize("both", [True, False])
@pytest.mark.parametrize("slice_ms", [5000, 7000, None])
def test_bounces_against_brute_force_with_a_hot_device(spark, both, slice_ms):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.5 else f"d{rng.randrange(30)}", "p",
             rng.choice([None, "", "home", "list"]), rng.randrange(-20_000, 2_000_000) // 500 * 500)
            for _ in range(3000)]
    log = page_log(spark, rows)
    assert visits(sequences.bounces(log, entry_after_entry=both, slice_ms=slice_ms)) == \
        brute_bounces(rows, 5000, both)


@pytest.mark.parametrize("both", [True, False])
def test_pile_of_one_time_is_cut_by_position(spark, both):
    """Half of all records carry one device and one time; another device none, another no id."""
    rng = random.Random(11)
    rows = [("hot", "p", rng.choice([None, "home"]), 1000) if rng.random() < 0.5 else
            (rng.choice(["", "a", "b"]), "p", rng.choice([None, "home"]), rng.randrange(0, 300_000))
            for _ in range(4000)]
    log = page_log(spark, rows)
    cut = log.withColumn("common", F.col("common").withField(
        "mid", F.when(F.col("common.mid") != "", F.col("common.mid"))))
    got = sequences.bounces(cut, entry_after_entry=both, chunk_rows=16)
    assert sorted((m or "", ts) for m, ts in map(tuple, got.select("common.mid", "ts").collect())) == \
        brute_bounces(rows, 5000, both)
    assert got.columns == log.columns


def test_cuts_of_a_pile_are_even(spark):
    rows = spark.range(40_000).select(
        F.lit("hot").alias("_mid"), F.lit(0).cast("bigint").alias("_slice"),
        F.lit(5).cast("bigint").alias("_ts"), F.col("id").alias("_id"))
    place = F.struct("_ts", "_id")
    hot = patterns.hot_groups(rows, place, 1000)
    cuts = [c["_id"] for c in hot.first()["_cuts"]]
    sizes = [b - a for a, b in zip([0, *cuts], [*cuts, 40_000])]
    assert hot.count() == 1 and 30 <= len(cuts) <= 50 and max(sizes) < 4000
    # A frame made of rows, whose plan has no size, is cut in the same way.
    small = spark.createDataFrame(rows.limit(3000).rdd, rows.schema)
    assert len(patterns.hot_groups(small, place, 100).first()["_cuts"]) > 20
    assert patterns.hot_groups(rows, place, 1 << 40) is None
    assert patterns.hot_groups(rows.withColumn("_mid", F.col("_id").cast("string")), place, 1000) is None


def test_hot_device_is_spread_over_slices(spark):
    """One device holds all rows; no (device, slice) group holds more than a small share."""
    rows = spark.range(20_000).select(F.lit("hot").alias("mid"), (F.col("id") * 1000).alias("ts"))
    sliced = rows.select("mid", F.explode(patterns.time_slices(F.col("ts"), 5000, 60_000)).alias("s"))
    top = sliced.groupBy("mid", "s").count().agg(F.max("count")).first()[0]
    assert top <= 65 and sliced.count() < 1.1 * 20_000


def test_repair_and_first_visit_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"d{rng.randrange(20)}", "p", "home",
             rng.randrange(0, 4 * 86_400_000) // 60_000 * 60_000) for _ in range(2000)]
    log = page_log(spark, rows)
    first, daily = {}, {}
    for i, (mid, _, _, ts) in enumerate(rows):
        first[mid] = min(first.get(mid, (ts, i)), (ts, i))
        day = (mid, ts // 86_400_000)
        daily[day] = min(daily.get(day, (ts, i)), (ts, i))
    got = {(r["mid"], r["rec_id"]): r["is_new"] for r in sequences.repair_is_new(log).select(
        "common.mid", "rec_id", "common.is_new").collect()}
    assert len(got) == len(rows)
    assert {k for k, v in got.items() if v == "1"} == {(m, i) for m, (_, i) in first.items()}
    visits_of_days = {r["rec_id"] for r in sequences.daily_first_visit(log).select("rec_id").collect()}
    assert visits_of_days == {i for _, i in daily.values()}


def test_records_without_id_take_their_position_or_fail(spark):
    lines = spark.createDataFrame([
        (json.dumps({"common": {"mid": m, "is_new": "0"}, "page": {"page_id": "p"}, "ts": ts}), at)
        for m, ts, at in [("a", 5, 7), ("a", 9, 8), ("b", 6, 9)]], "value string, position long")
    log = logs.parse_lines(lines, PAGE_LOG)
    fixed = sequences.repair_is_new(log).select("rec_id", "common.is_new").collect()
    assert sorted(map(tuple, fixed)) == [(7, "1"), (8, "0"), (9, "1")]
    with pytest.raises(Exception, match="no rec_id"):
        sequences.repair_is_new(logs.parse_lines(lines.drop("position"), PAGE_LOG)).collect()


def test_broker_position_is_one_number(spark):
    records = spark.createDataFrame([("t", bytearray(b"x"), 3, 5)], "topic string, value binary, partition int, offset long")
    assert tuple(broker_lines(records).first()) == ("t", "x", (3 << 48) + 5)


def test_days_follow_the_session_zone(spark):
    log = page_log(spark, [("a", "p", None, 15 * 3_600_000), ("a", "p", None, 17 * 3_600_000)])
    assert sequences.daily_first_visit(log).count() == 1
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Shanghai"}):
        assert sequences.daily_first_visit(log).count() == 2


def test_visits_around_midnight_count_for_both_days(spark):
    day = 86_400_000
    log = page_log(spark, [("a", "p", None, day - 2000), ("a", "p", None, day + 2000)])
    assert len(visits(sequences.daily_first_visit(log))) == 2


def test_split_and_displays(spark):
    lines = spark.createDataFrame([(x,) for x in (
        '{"common":{"mid":"1","is_new":"0"},"start":{"entry":"icon"},"displays":[{"item":"9"}],"ts":1}',
        '{"common":{"mid":"2","vc":"v1"},"page":{"page_id":"home"},"ts":2,'
        '"displays":[{"item":"5","item_type":"sku_id","order":1},{"item":"6","item_type":"x","order":2}]}',
        '{"common":{"mid":"3"},"displays":[{"item":"7","item_type":"sku_id"}],"ts":3}',
        '{"common":{"mid":"4"},"page":{"page_id":"list","last_page_id":"home"},"ts":4}')], "value string")
    streams = logs.split_log(logs.parse_lines(lines, PAGE_LOG))
    assert [df.count() for df in streams] == [1, 2, 3]
    shown = {r["item"]: r for r in streams.display.collect()}
    assert shown["5"]["page_id"] == "home" and shown["5"]["vc"] == "v1" and shown["5"]["ts"] == 2
    assert shown["7"]["page_id"] is None  # a display without a page keeps an empty page
    assert logs.product_displays(streams.display).count() == 2
    assert logs.session_entries(streams.page).count() == 1


def test_common_wins_a_name_clash(spark):
    schema = "common struct<mid:string,item:string>, page struct<page_id:string>, start string, " \
             "displays array<struct<item:string,page_id:string,order:bigint>>, ts bigint"
    log = spark.createDataFrame([(("1", "c"), ("home",), None, [("d", "other", 3)], 5)], schema)
    assert logs.explode_displays(log).first().asDict() == {
        "mid": "1", "item": "c", "ts": 5, "page_id": "home", "order": 3}
