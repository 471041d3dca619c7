"""The given tables in the shape of the warehouse's topics and dimensions.

Every column is computed from the given rows by a fixed formula, so that the SQL check can repeat
it. No row is left out and none is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.texts import to_lines
from tidemart.functions.times import at_second
from tidemart.operators.wide import Dims
from tidemart.sources.tables import read_table

DAY_ONE = "2024-01-01 00:00:00"
_MONEY = "DECIMAL(20,2)"
_STAMP = "'yyyy-MM-dd HH:mm:ss'"


class Sample:
    """Readers bound to one folder of given tables; each table's schema is read once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # ------------------------------------------------------------ logs

    def log(self) -> DataFrame:
        """``events`` as application log: errors are app starts, all others are pages."""
        parts = {"ar": 7, "os": 2, "ch": 4, "md": 5, "vc": 3, "ba": 6}
        c = {name: f"'{name}', concat('{name}', pmod(user_id, {n}))" for name, n in parts.items()}
        return self.table("events").selectExpr(
            f"""named_struct({c['ar']}, 'uid', CAST(user_id AS STRING), {c['os']}, {c['ch']},
                'is_new', CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END, {c['md']},
                'mid', CAST(user_id AS STRING), {c['vc']}, {c['ba']}) AS common""",
            """CASE WHEN event_type <> 'error' THEN named_struct(
                'page_id', CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'good_list'
                    WHEN 'signup' THEN 'home' WHEN 'purchase' THEN 'payment' END,
                'during_time', CAST(floor(CAST(value AS DECIMAL(18,2)) * 1000) AS BIGINT),
                'last_page_id', CASE WHEN event_type NOT IN ('signup', 'view') THEN 'home' END,
                'item', get_json_object(props, '$.k'), 'item_type', 'sku_id') END AS page""",
            """CASE WHEN event_type = 'error' THEN named_struct('entry', 'icon',
                'loading_time', event_id % 1000, 'open_ad_id', CAST(NULL AS STRING)) END AS start""",
            """CASE WHEN event_id % 5 <> 0 THEN transform(sequence(1L, event_id % 4 + 1), i -> named_struct(
                'item', CAST((event_id * 7 + i) % 100 AS STRING),
                'item_type', CASE WHEN i % 2 = 1 THEN 'sku_id' ELSE 'promotion_id' END,
                'order', i)) END AS displays""",
            "unix_millis(ts) AS ts", "event_id AS rec_id")

    def log_lines(self) -> DataFrame:
        return to_lines(self.log())

    def search_log(self) -> DataFrame:
        """``documents`` as searches: one page record per document, one minute apart."""
        return self.table("documents").selectExpr(
            "named_struct('page_id', 'good_list', 'item', text) AS page",
            f"unix_millis(TIMESTAMP '{DAY_ONE}') + doc_id * 60000 AS ts",
            "doc_id AS rec_id").withColumn("et", at_second(F.col("ts")))

    # ------------------------------------------------------------ orders

    def orders(self) -> DataFrame:
        activity, coupon = f"CAST(o_orderkey % 10 AS {_MONEY})", f"CAST(o_orderkey % 5 AS {_MONEY})"
        return self.table("orders").selectExpr(
            "o_orderkey AS id", "o_custkey % 25 AS province_id", "o_orderstatus AS order_status",
            "o_custkey AS user_id", f"CAST(o_totalprice AS {_MONEY}) AS total_amount",
            f"{activity} AS activity_reduce_amount", f"{coupon} AS coupon_reduce_amount",
            f"CAST(CAST(o_totalprice AS {_MONEY}) + {activity} + {coupon} AS {_MONEY}) AS original_total_amount",
            f"CAST(o_orderkey % 20 AS {_MONEY}) AS feight_fee",
            f"date_format(o_orderdate + INTERVAL 15 MINUTES, {_STAMP}) AS expire_time",
            f"date_format(o_orderdate, {_STAMP}) AS create_time",
            "CAST(NULL AS STRING) AS operate_time", "unix_millis(o_orderdate) AS create_ts")

    def details(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS order_id", "l_partkey AS sku_id",
            f"CAST(l_extendedprice AS {_MONEY}) AS order_price", "CAST(l_quantity AS BIGINT) AS sku_num",
            "concat('line ', l_partkey) AS sku_name", f"date_format(l_shipdate, {_STAMP}) AS create_time",
            f"CAST(l_extendedprice AS {_MONEY}) AS split_total_amount",
            f"CAST(l_linenumber AS {_MONEY}) AS split_activity_amount",
            f"CAST(l_linenumber % 3 AS {_MONEY}) AS split_coupon_amount",
            "unix_millis(l_shipdate) AS create_ts")

    def payments(self) -> DataFrame:
        """Every order, paid up to 59 minutes after the order."""
        paid = "timestamp_millis(unix_millis(o_orderdate) + o_orderkey % 60 * 60000)"
        return self.table("orders").selectExpr(
            "o_orderkey + 1000000000 AS id", "o_orderkey AS order_id", "o_custkey AS user_id",
            f"CAST(o_totalprice AS {_MONEY}) AS total_amount", "concat('order ', o_orderkey) AS subject",
            "o_orderpriority AS payment_type", f"date_format({paid}, {_STAMP}) AS create_time",
            f"date_format({paid} + INTERVAL 5 SECONDS, {_STAMP}) AS callback_time",
            f"unix_millis({paid}) AS create_ts")

    def _shop_events(self, kind: str, *more: str) -> DataFrame:
        return self.table("events").where(F.col("event_type") == kind).selectExpr(
            "event_id AS id", "CAST(get_json_object(props, '$.k') AS BIGINT) AS sku_id", *more,
            f"date_format(ts, {_STAMP}) AS create_time", "unix_millis(date_trunc('SECOND', ts)) AS create_ts")

    def favors(self) -> DataFrame:
        return self._shop_events("view")

    def carts(self) -> DataFrame:
        return self._shop_events("click")

    def refunds(self) -> DataFrame:
        return self._shop_events(
            "purchase", "event_id % 50 AS order_id", f"CAST(value AS {_MONEY}) AS refund_amount")

    def comments(self) -> DataFrame:
        return self._shop_events("signup", "CAST(1200 + event_id % 6 AS STRING) AS appraise")

    # ------------------------------------------------------------ dimensions

    def dims(self) -> Dims:
        brand = "CAST(substring(p_brand, 7, 10) AS BIGINT)"
        kind = "CAST(ascii(p_type) * 1000 + length(p_type) AS BIGINT)"
        part = self.table("part").selectExpr(
            "*", f"{brand} AS brand", f"{kind} AS kind", "p_partkey div 4 AS spu")
        return Dims(
            user=self.table("customer").selectExpr(
                "c_custkey AS id", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
                "date_add(DATE '1960-01-01', CAST(c_custkey % 15000 AS INT)) AS birthday"),
            province=self.table("nation").join(
                self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").selectExpr(
                "CAST(n_nationkey AS BIGINT) AS id", "n_name AS name",
                "concat('ISO-', n_nationkey) AS iso_code", "r_name AS area_code",
                "concat('CN-', n_nationkey) AS iso_3166_2"),
            sku=part.selectExpr(
                "p_partkey AS id", "p_name AS sku_name", f"CAST(p_retailprice AS {_MONEY}) AS price",
                "spu AS spu_id", "brand AS tm_id", "kind AS category3_id"),
            spu=part.groupBy(F.col("spu").alias("id")).agg(F.min("p_name").alias("spu_name")),
            tm=part.groupBy(F.col("brand").alias("id")).agg(F.min("p_brand").alias("tm_name")),
            category3=part.groupBy(F.col("kind").alias("id")).agg(F.min("p_type").alias("name")))

    # ------------------------------------------------------------ changes

    def change_lines(self) -> DataFrame:
        """``orders`` and ``customer`` rows as change-log lines of all kinds, clean and dirty."""
        def line(table: str, key: str, name: str, body: dict[str, str]) -> DataFrame:
            # Every seventh record has an empty body; to_json leaves null fields out.
            data = ", ".join(f"'{k}', CASE WHEN {key} % 7 <> 5 THEN {v} END" for k, v in body.items())
            return self.table(table).selectExpr(f"""to_json(named_struct(
                'database', CASE WHEN {key} % 11 <> 10 THEN 'shop' END, 'table', '{name}',
                'type', element_at(array('insert', 'update', 'bootstrap-insert', 'delete',
                    'bootstrap-start', 'insert', 'insert'), CAST({key} % 7 + 1 AS INT)),
                'ts', {key} + 1600000000, 'xid', {key}, 'xoffset', 0L,
                'data', named_struct({data}))) AS value""")

        orders = line("orders", "o_orderkey", "order_info", {
            "id": "o_orderkey", "user_id": "o_custkey", "order_status": "o_orderstatus",
            "note": "o_orderpriority"})
        users = line("customer", "c_custkey", "user_info", {
            "id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"})
        return orders.unionByName(users)

    def routes(self) -> DataFrame:
        """Route changes for the two tables of ``change_lines``: a snapshot, later edits, a delete."""
        return self.spark.sql("""
            SELECT * FROM VALUES
              ('order_info', 'insert', 'kafka', 'dwd_order_old', 'id', 'id', CAST(NULL AS STRING), 'snapshot', 1L),
              ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,user_id,order_status', 'id', CAST(NULL AS STRING), 'update', 5L),
              ('order_info', 'update', 'kafka', 'dwd_order_update', 'id,order_status', CAST(NULL AS STRING), CAST(NULL AS STRING), 'snapshot', 2L),
              ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name', CAST(NULL AS STRING), CAST(NULL AS STRING), 'snapshot', 3L),
              ('user_info', 'update', 'hbase', 'dim_user_info', 'id,name', 'id', 'SALT_BUCKETS = 4', 'insert', 4L),
              ('user_info', 'update', 'hbase', 'dim_gone', 'id', 'id', CAST(NULL AS STRING), 'delete', 6L)
            AS t(source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend, op, seq)
        """)

    def config_changes(self) -> DataFrame:
        """``orders`` as a long history of route edits, many per (source table, operation)."""
        return self.table("orders").selectExpr(
            "concat('table_', o_custkey) AS source_table",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'insert' ELSE 'update' END AS operate_type",
            "CASE WHEN o_orderstatus = 'P' THEN 'hbase' ELSE 'kafka' END AS sink_type",
            "concat('sink_', o_orderkey % 40) AS sink_table", "concat('id,c', o_orderkey % 9) AS sink_columns",
            "CASE WHEN o_orderkey % 3 = 0 THEN 'id' END AS sink_pk", "CAST(NULL AS STRING) AS sink_extend",
            """CASE WHEN o_orderkey % 10 = 9 THEN 'delete' WHEN o_orderkey % 10 = 0 THEN 'snapshot'
                WHEN o_orderkey % 10 < 5 THEN 'insert' ELSE 'update' END AS op""",
            "o_orderkey AS seq")

    def route_history(self) -> DataFrame:
        """``orders`` and ``customer`` as route edits of the two tables of ``change_lines``, with their times.

        An edit comes up to four seconds before the changes that its key's neighbours make.
        """
        def edits(table: str, key: str, name: str, columns: str, topic: str) -> DataFrame:
            return self.table(table).selectExpr(
                f"'{name}' AS source_table", f"CASE WHEN {key} % 2 = 0 THEN 'insert' ELSE 'update' END AS operate_type",
                f"CASE WHEN {key} % 3 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type",
                f"concat('{topic}_', {key} % 13) AS sink_table", f"'{columns}' AS sink_columns",
                "CAST(NULL AS STRING) AS sink_pk", "CAST(NULL AS STRING) AS sink_extend",
                f"""CASE WHEN {key} % 10 = 9 THEN 'delete' WHEN {key} % 10 = 0 THEN 'snapshot'
                    WHEN {key} % 10 < 5 THEN 'insert' ELSE 'update' END AS op""",
                f"{key} + 1600000000 - {key} % 5 AS at", f"{key} AS seq")

        return edits("orders", "o_orderkey", "order_info", "id,order_status", "orders").unionByName(
            edits("customer", "c_custkey", "user_info", "id,name", "users"))
