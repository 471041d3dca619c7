"""Interval joins with hot keys against brute force, and the sizes of their cells."""

import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import spread as spreads
from tidemart.operators.spread import CELL, spread, spread_interval_join

ROWS = "k string, n long, ms long"
BOUNDS = (-3_000, 2_000)
CHUNK = 100


def side(spark, rows, prefix):
    frame = spark.createDataFrame(rows, ROWS).withColumn("ts", F.timestamp_millis("ms")).repartition(5)
    return frame.withColumnsRenamed({c: prefix + c for c in frame.columns})


def drawn(seed, n, hot, pile):
    """Half of the rows have one key; of these a part ``pile`` lies at one time. Keys and times may be null."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if draw.random() < hot else draw.choice(["a", "b", None])
        ms = 50_000 if key == "hot" and draw.random() < pile else draw.choice([None, *[draw.randint(-9_000, 400_000)] * 20])
        rows.append((key, i, ms))
    return rows


def brute(left, right):
    return sorted((a, b) for k, a, s in left for o, b, t in right
                  if k is not None and k == o and None not in (s, t) and s + BOUNDS[0] <= t <= s + BOUNDS[1])


CASES = {
    "both sides": (drawn(1, 1200, .5, 0), drawn(2, 1500, .5, 0)),
    "piles of one time": (drawn(3, 700, .5, .5), drawn(4, 900, .5, .6)),
    "many left rows": (drawn(5, 3000, .6, .3), drawn(6, 60, .2, 0)),
    "many right rows": (drawn(7, 60, .2, 0), drawn(8, 3000, .6, .3)),
}


@pytest.fixture(autouse=True)
def counted_at_any_size(monkeypatch):
    monkeypatch.setattr(spreads, "ROW_BYTES", 0)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("slice_ms", [None, 10_000_000])
def test_every_pair_once(spark, case, slice_ms):
    left, right = CASES[case]
    given = side(spark, left, "l_"), side(spark, right, "r_"), "l_k", "r_k", "l_ts", "r_ts", *BOUNDS, slice_ms
    pairs = spread_interval_join(*given, chunk_rows=CHUNK)
    assert pairs.columns == [*given[0].columns, *given[1].columns]
    assert sorted((r.l_n, r.r_n) for r in pairs.select("l_n", "r_n").collect()) == brute(left, right)
    cells = spread(*given, CHUNK)
    if cells is not None:
        for rows in cells:
            assert rows.groupBy(*CELL).count().agg(F.max("count")).first()[0] <= 3 * CHUNK
    assert cells is not None or slice_ms is None


def test_repeated_rows_and_empty_tables(spark):
    left = [("hot", 1, 0)] * 150 + [("hot", 2, 10_000_000)]
    right = [("hot", 7, 1_000)] * 130
    given = side(spark, left, "l_"), side(spark, right, "r_")
    names = "l_k", "r_k", "l_ts", "r_ts", *BOUNDS
    assert spread_interval_join(*given, *names, chunk_rows=CHUNK).count() == 150 * 130
    none = given[0].where("false")
    assert spread_interval_join(none, given[1], *names, chunk_rows=CHUNK).count() == 0
    assert spread_interval_join(none, given[1].where("false"), *names, chunk_rows=CHUNK).count() == 0


def test_large_lists_of_cuts_are_joined_with_salts(spark, monkeypatch):
    monkeypatch.setattr(spreads, "small_lookup", lambda *a, **b: lookup(*a, **b, limit=0, salts=4))
    from tidemart.operators.joins import small_lookup as lookup
    left, right = CASES["piles of one time"]
    pairs = spread_interval_join(side(spark, left, "l_"), side(spark, right, "r_"), "l_k", "r_k", "l_ts", "r_ts",
                                 *BOUNDS, chunk_rows=CHUNK)
    assert sorted((r.l_n, r.r_n) for r in pairs.select("l_n", "r_n").collect()) == brute(left, right)
