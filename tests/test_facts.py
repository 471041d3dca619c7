"""Wide facts, change routing, keywords, statistics and dashboard on hand-made rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions import times
from tidemart.operators import cdc, dashboard, joins, keywords, stats, wide
from tidemart.plans import warehouse
from tidemart.schemas import (
    CHANGE, COMMENT_INFO, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAYMENT_INFO, PAYMENT_WIDE)

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def text(seconds):
    return (T0 + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def frame(spark, schema, *rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_order_interval_edges(spark):
    orders = frame(spark, ORDER_INFO, dict(id=1, create_time=text(0), user_id=5, total_amount=Decimal("9.00")))
    details = frame(spark, ORDER_DETAIL, *[
        dict(id=i, order_id=order, create_time=text(s), split_total_amount=Decimal("3.00"))
        for i, (order, s) in enumerate([(1, -300), (1, 300), (1, -301), (1, 301), (2, 0), (None, 0)])])
    base = wide.order_wide_base(orders, details)
    assert base.columns == ORDER_WIDE.fieldNames()
    assert sorted(r["detail_id"] for r in base.collect()) == [0, 1]
    row = base.first()
    assert row["create_date"] == "2024-03-01" and row["create_hour"] == "12"
    assert row["split_feight_fee"] is None and row["user_id"] == 5


def test_payment_interval_edges_and_clashes(spark):
    payment = frame(spark, PAYMENT_INFO, dict(
        id=7, order_id=1, user_id=50, total_amount=Decimal("8.00"), create_time=text(0)))
    lines = frame(spark, ORDER_WIDE, *[
        dict(detail_id=i, order_id=1, user_id=5, total_amount=Decimal("9.00"), create_time=text(s))
        for i, s in enumerate([-2700, 5, -2701, 6])])
    paid = wide.payment_wide(payment, lines)
    assert paid.columns == PAYMENT_WIDE.fieldNames()
    assert sorted(r["detail_id"] for r in paid.collect()) == [0, 1]
    row = paid.where("detail_id = 0").first()
    assert (row["user_id"], row["total_amount"], row["payment_id"]) == (50, Decimal("8.00"), 7)
    assert row["payment_create_time"] == text(0) and row["order_create_time"] == text(-2700)


def test_interval_join_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)

    def side(n):
        return [(i, 0 if rng.random() < 0.4 else rng.randrange(40), rng.randrange(0, 400) * 250)
                for i in range(n)]

    left, right = side(300), side(500)
    want = sorted((a, b) for a, ka, ta in left for b, kb, tb in right
                  if ka == kb and ta - 2000 <= tb <= ta + 750)
    as_frame = [spark.createDataFrame(rows, f"{p}id long, {p}k long, {p}ms long").withColumn(
        f"{p}t", F.timestamp_millis(f"{p}ms")) for p, rows in (("l", left), ("r", right))]
    for slice_ms in (2750, 1000, 100_000, None):
        got = joins.interval_join(*as_frame, "lk", "rk", "lt", "rt", -2000, 750, slice_ms)
        assert sorted(tuple(r) for r in got.select("lid", "rid").collect()) == want


def test_interval_join_is_exact_over_a_clock_change(spark):
    """Two days are 48 hours, also in a zone whose clock changes in between."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        start, two_days = 1711796400_000, 2 * 86_400_000  # 2024-03-30 12:00 in Berlin
        left = spark.range(1).select(F.col("id").alias("lk"), F.timestamp_millis(F.lit(start)).alias("lt"))
        right = spark.range(-1, 2).select(F.lit(0).alias("rk"), F.col("id").alias("off"),
                                          F.timestamp_millis(F.lit(start + two_days) + F.col("id")).alias("rt"))
        got = joins.interval_join(left, right, "lk", "rk", "lt", "rt", 0, two_days)
        assert sorted(r["off"] for r in got.collect()) == [-1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_dimension_gives_nulls(spark, sample):
    lines = frame(spark, ORDER_WIDE, dict(detail_id=1, sku_id=-5, user_id=None, province_id=3,
                                          sku_name="old", create_time=text(0)))
    row = wide.add_dimensions(lines, sample.dims(), F.to_timestamp(F.lit("2024-01-01"))).first()
    assert row["sku_name"] is None and row["tm_name"] is None and row["user_age"] is None
    assert row["province_name"] == "NATION_3"


def test_age_counts_years_of_365_days(spark):
    row = spark.sql("SELECT DATE'2000-01-01' AS b, TIMESTAMP'2001-01-01 00:00:00' AS a, "
                    "TIMESTAMP'2000-12-30 23:00:00' AS c, TIMESTAMP'1999-12-31 00:00:00' AS d")
    ages = row.select(*[times.age_in_years(F.col("b"), F.col(x)) for x in "acd"]).first()
    assert tuple(ages) == (1, 0, 0)


def test_bad_times_are_null(spark):
    given = ["2024-01-02 03:04:05", "2024-01-02", "nonsense", "2024-13-02 03:04:05", None]
    got = spark.createDataFrame([(x,) for x in given], "t string").select(times.to_millis(F.col("t"))).collect()
    assert [r[0] for r in got] == [1704164645000, None, None, None, None]


def change(table="order_info", kind="insert", data='{"id":"1","a":"x","b":"y"}', ts=1, **more):
    return dict(database="shop", table=table, type=kind, ts=ts, xid=0, xoffset=0, data=data) | more


def routes(spark):
    return spark.sql("""SELECT * FROM VALUES
        ('order_info','insert','kafka','dwd_order','id,a','id',NULL),
        ('user_info','update','hbase','dim_user','id,a',NULL,NULL),
        ('other','insert','file','lost','id',NULL,NULL)
        AS t(source_table,operate_type,sink_type,sink_table,sink_columns,sink_pk,sink_extend)""")


def test_clean_route_and_prune(spark):
    changes = frame(spark, CHANGE, change(), change(kind="bootstrap-insert"), change(kind="delete"),
                    change(kind="bootstrap-start"), change(data="{}"), change(data=None),
                    change(database=None), change(kind=None), change(kind="update"),
                    change("user_info", "update"), change("other"), change("unknown"))
    clean = cdc.clean_changes(changes)
    assert clean.count() == 6
    routed = cdc.route_changes(clean, routes(spark))
    facts, dims = cdc.split_routes(routed)
    assert [r["data"] for r in facts.collect()] == [{"id": "1", "a": "x"}] * 2
    assert dims.first()["sink_table"] == "dim_user"
    assert {tuple(r) for r in cdc.route_counts(routed).collect()} == {
        ("kafka", "dwd_order", 2), ("hbase", "dim_user", 1)}


def test_salted_lookup_equals_broadcast(spark):
    facts = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), "id")
    small = spark.sql("SELECT * FROM VALUES ('hot', 1), ('k1', 2), ('k2', 3) AS t(k, v)")
    broadcast = joins.small_lookup(facts, small, ["k"], ["id"])
    salted = joins.small_lookup(facts, small, ["k"], ["id"], limit=0, salts=8)
    assert "_salt" not in salted.columns
    assert sorted(map(tuple, broadcast.collect())) == sorted(map(tuple, salted.collect()))


def test_dim_upsert(spark):
    existing = spark.createDataFrame([("1", "old"), ("2", None)], "id string, a string")
    changes = frame(spark, CHANGE, change("user_info", "update", '{"id":"1","a":"new"}', 5),
                    change("user_info", "update", '{"id":"1","a":"newer"}', 6),
                    change("user_info", "update", '{"id":"3"}', 1))
    _, dims = cdc.split_routes(cdc.route_changes(changes, routes(spark)))
    after = cdc.dim_upsert(existing, dims, ["id", "a"])
    assert sorted(map(tuple, after.collect())) == [("1", "newer"), ("2", ""), ("3", "")]


def test_keyword_unpivot(spark):
    split = spark.createDataFrame(
        [("s", "e", w, c, o, k) for words, c, o, k in (
            (["小米", "手机"], 10, 20, 40), (["华为", "手机"], 15, 25, 55), (["none"], 0, 0, 0)) for w in words],
        "stt string, edt string, word string, click_ct long, order_ct long, cart_ct long")
    rows = keywords.unpivot_counts(keywords.sum_words(split))
    got = {(r["keyword"], r["source"]): r["ct"] for r in rows.collect()}
    assert got == {("小米", "click"): 10, ("小米", "order"): 20, ("小米", "cart"): 40,
                   ("华为", "click"): 15, ("华为", "order"): 25, ("华为", "cart"): 55,
                   ("手机", "click"): 25, ("手机", "order"): 45, ("手机", "cart"): 95}


def test_one_order_twice_counts_once_per_kind(spark):
    facts = spark.createDataFrame(
        [(1, 1000, 1, "order", 7), (1, 2000, 1, "order", 7), (1, 2500, 0, "payment", 7), (1, 9000, 1, "order", 7)],
        "sku_id long, ts long, order_sku_num long, order_kind string, order_id long")
    for name in ("display_ct", "click_ct", "favor_ct", "cart_ct", "comment_ct", "good_comment_ct"):
        facts = facts.withColumn(name, F.lit(0).cast("bigint"))
    for name in ("order_amount", "payment_amount", "refund_amount"):
        facts = facts.withColumn(name, F.lit("1.50").cast("decimal(20,2)"))
    rows = stats.product_measures(facts.withColumn("et", F.timestamp_millis("ts"))).orderBy("stt").collect()
    assert [(r["order_ct"], r["paid_order_ct"], r["refund_order_ct"], r["order_sku_num"], r["ts"])
            for r in rows] == [(1, 1, 0, 2, 1000), (1, 0, 0, 1, 9000)]
    assert rows[0]["order_amount"] == Decimal("4.50")


def test_good_comments(spark):
    rows = frame(spark, COMMENT_INFO, *[dict(id=i, sku_id=1, appraise=a) for i, a in enumerate(
        ["1205", "1204", "1203", None])])
    assert rows.agg(F.sum(stats.good_comment())).first()[0] == 2


def day_stats(spark):
    return spark.createDataFrame(
        [("2024-03-01 00:00:00", "b", Decimal("2.00")), ("2024-03-01 05:00:00", "a", Decimal("2.00")),
         ("2024-03-01 06:00:00", "c", Decimal("1.00")), ("2024-03-02 00:00:00", "c", Decimal("9.00"))],
        "stt string, tm_name string, order_amount decimal(20,2)")


def test_top_list_of_one_day_and_of_every_day(spark):
    one = dashboard.gmv_by_brand(day_stats(spark), 20240301, 2)
    assert [tuple(r) for r in one.collect()] == [("a", Decimal("2.00")), ("b", Decimal("2.00"))]
    every = dashboard.gmv_by_brand(day_stats(spark), None, 2)
    assert {(r["dt"], r["tm_name"]) for r in every.collect()} == {
        (20240301, "a"), (20240301, "b"), (20240302, "c")}
    assert dashboard.gmv_total(day_stats(spark), 20240302).first()[0] == Decimal("9.00")
    assert dashboard.gmv_total(day_stats(spark)).first()[0] is None  # today


def test_24_hours_without_gaps(spark):
    visits = spark.createDataFrame(
        [("2024-03-01 05:00:00", 1, 2, 3), ("2024-03-01 05:30:00", 1, 1, 1)],
        "stt string, uv_ct long, pv_ct long, uj_ct long")
    rows = sorted(map(tuple, dashboard.visitor_24h(visits, 20240301).collect()))
    assert [r[0] for r in rows] == [f"{h:02d}" for h in range(24)]
    assert rows[5] == ("05", 3, 2, 4) and rows[6] == ("06", 0, 0, 0)
    assert sum(r[1] for r in dashboard.visitor_24h(visits, 20240309).collect()) == 0


def test_keyword_weights(spark):
    rows = spark.createDataFrame(
        [("2024-03-01 00:00:00", "w", s, 1) for s in ("search", "click", "order", "cart")],
        "stt string, keyword string, source string, ct long")
    assert dashboard.keyword_score(rows, 20240301).first()["score"] == 25


def test_default_windows_are_those_of_the_warehouse():
    params = warehouse.Params()
    assert (params.visitor_window, params.product_window, params.province_window, params.keyword_window) == (
        "5 seconds", "5 seconds", "5 seconds", "10 seconds")
    assert (params.order_lower_ms, params.order_upper_ms) == (-300_000, 300_000)
    assert (params.payment_lower_ms, params.payment_upper_ms) == (-2_700_000, 5_000)
