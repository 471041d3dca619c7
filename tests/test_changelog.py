"""Changelogs of totals, and aggregates over them, from round to round."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tidemart.operators import changelog
from tidemart.session import shared_dir
from tidemart.streaming import jobs, runner
from tidemart.streaming.processors import KeyedTotals
from tidemart.streaming.runner import Feed


def test_totals_that_rise_and_fall(spark):
    """Totals go back to old values and to zero; the count of large totals follows in every round."""
    draw = random.Random(4)
    given = [(n, f"k{draw.randrange(6)}", draw.choice([5, 5, -5, 0, 3, -3])) for n in range(200)]
    lines = spark.createDataFrame([(ts, f"{k},{v}") for ts, k, v in given], "ts long, value string")
    base, rounds = shared_dir(spark, "t_changelog"), []

    def totals(topics):
        parts = F.split("value", ",")
        rows = topics["t"].select(parts[0].alias("k"), parts[1].cast("bigint").alias("v"))
        return rows.groupBy("k").transformWithState(
            KeyedTotals(["k"], ["v"]), "k string, v bigint, sign int", "append", "None")

    def run(topics):
        runner.catch_up(runner.file_sink(totals(topics), f"{base}/out", f"{base}/ck"))
        changes = spark.read.parquet(f"{base}/out")
        now = {r.k: r.v for r in changelog.current(changes, ["k"]).collect()}
        rows, = changelog.rollup(changes, [], {"large": changelog.signed_count(F.col("v") > 4),
                                               "v": changelog.signed_sum("v")}).collect()
        rounds.append((now, rows.rows_ct, rows.large, rows.v))

    runner.feed_rounds(spark, base, {"t": Feed(lines)}, run, 5, partitions=2)
    assert len(rounds) == 5
    for i, (now, rows, large, total) in enumerate(rounds):
        want, edge = Counter(), [39, 78, 117, 156, 200][i]
        for ts, k, v in given:
            if ts < edge:
                want[k] += v
        assert now == dict(want) and rows == len(want)
        assert large == sum(v > 4 for v in want.values()) and total == sum(want.values())


def test_a_group_without_rows_comes_out_empty(spark):
    changes = spark.createDataFrame([("w", "a", 3, 1), ("w", "a", 3, -1), ("x", "a", 9, 1)], "g string, k string, v long, sign int")
    got = {r.g: (r.rows_ct, r.v) for r in changelog.rollup(changes, ["g"], {"v": changelog.signed_sum("v")}).collect()}
    assert got == {"w": (0, 0), "x": (1, 9)}
    assert [tuple(r) for r in changelog.current(changes, ["g", "k"]).collect()] == [("x", "a", 9)]


def test_keyword_changes_are_withdrawn(spark):
    line = '{"stt":"s","edt":"e","sku_name":"%s","click_ct":%d,"order_ct":0,"cart_ct":0}'
    lines = spark.createDataFrame([(0, line % ("red ring", 4)), (100, line % ("ring", 7))], "ts long, value string")
    out = runner.replay(spark, "t_words", {"p": Feed(lines)}, lambda t: jobs.keyword_changes(t["p"]), partitions=2)
    assert sorted((r.keyword, r.source, r.ct, r.sign) for r in out.collect()) == [
        ("red", "click", 4, 1), ("ring", "click", 4, -1), ("ring", "click", 4, 1), ("ring", "click", 11, 1)]
    row, = jobs.keyword_rollup(out).collect()
    assert (row.rows_ct, row.ct, row.popular_ct) == (2, 15, 1)
