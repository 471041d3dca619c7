"""Physical plans: what reaches the scans, how groups are shuffled, what is never used."""

import pytest
from compare import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tidemart.operators import joins, sequences
from tidemart.plans import catalog, stream_catalog
from tidemart.session import ADVISORY


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


TABLE_QUERIES = sorted(catalog.TABLE_QUERIES)


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_python_and_no_all_pairs(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, SMALL))
    # The 24 hours of one day meet in one row.
    single = () if name == "visitor_24h_day" else ("SinglePartition",)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", *single):
        assert word not in plan, word


@pytest.mark.parametrize("name", ["gmv_by_brand_day", "visitor_24h_day", "keyword_score_day"])
def test_one_day_opens_one_partition(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, SMALL))
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_only_needed_columns_are_read(spark, sample):
    plan = plan_of(catalog.order_wide_base(sample).select("order_id", "split_total_amount"))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert any(s == "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" for s in schemas)
    assert all("l_suppkey" not in s and "o_orderpriority" not in s for s in schemas)


def test_filter_reaches_the_scan(spark, sample):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan_of(sample.favors())


def test_distinct_orders_without_sets_and_expand(spark, sample):
    plan = plan_of(catalog.product_table(sample))
    assert "collect_set" not in plan and "Expand" not in plan
    assert "partial_sum" in plan


def test_time_slices_are_part_of_the_shuffle_key(spark, sample):
    assert "_slice" in plan_of(sequences.bounces(catalog.pages(sample))).split("hashpartitioning(")[1][:60]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.order_wide_base(sample))
        assert "SortMergeJoin [o_id" in plan and "_lslice" in plan
        full = plan_of(catalog.order_wide_table(sample))
        assert "BroadcastHashJoin" not in full  # no dimension is broadcast against the size limit
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repair_joins_by_record_not_by_device_alone(spark, sample):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(sequences.repair_is_new(sample.log()))
        assert "SortMergeJoin [rec_id" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("set_to, left", [("128m", "16777216b"), ("67108864b", "16777216b"), ("8m", "8m")])
def test_merged_shuffle_partitions_stay_small(spark, set_to, left):
    """Hash tables of words take many times their shuffled size, so tables are asked with small partitions."""
    before = spark.conf.get(ADVISORY)
    try:
        spark.conf.set(ADVISORY, set_to)
        entry_points.queries()["keyword_score"](spark, SMALL)
        assert spark.conf.get(ADVISORY) == left
    finally:
        spark.conf.set(ADVISORY, before)


def test_large_small_side_is_not_broadcast(spark):
    facts = spark.range(100).withColumn("k", F.col("id") % 3)
    large = spark.range(1_000_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert joins.planned_bytes(large) > 1_000_000
    assert "_salt" in plan_of(joins.small_lookup(facts, large, ["k"], ["id"], limit=1_000_000))
    assert "_salt" not in plan_of(joins.small_lookup(facts, large, ["k"], ["id"], limit=1 << 30))


def test_replays_write_to_their_state_without_reading_it_first(spark, monkeypatch):
    name, seen = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", []
    before = spark.conf.get(name, None)
    for run in ("replay", "replay_batches"):
        monkeypatch.setattr(stream_catalog.runner, run, lambda spark, **options: seen.append(spark.conf.get(name)))
    stream_catalog.replay(spark)
    stream_catalog.replay_batches(spark)
    assert seen == ["false", "false"] and spark.conf.get(name, None) == before
