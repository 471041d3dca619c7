"""The registered queries again as plain SQL, written independently of the operators.

The text runs on any engine with window functions and the given tables as views; the check uses
DuckDB. Each query is a list of named common tables followed by its final select.
"""

from __future__ import annotations

from tidemart.plans.catalog import AS_OF, AS_OF_MS
from tidemart.plans.stream_catalog import LATE_AFTER, TWINS

FMT = "'%Y-%m-%d %H:%M:%S'"
SIX_HOURS = 21_600_000


def label(ts: str) -> str:
    return f"strftime({ts}, {FMT})"


def from_ms(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def bucket(ts: str, width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


def bounds(ts: str, width: str) -> str:
    start = bucket(ts, width)
    return f"{label(start)} AS stt, {label(f'{start} + INTERVAL {chr(39)}{width}{chr(39)}')} AS edt"


TABLES: dict[str, str] = {}

TABLES["log"] = """
SELECT event_id AS rec_id, epoch_us(ts) // 1000 AS ts, CAST(user_id AS VARCHAR) AS mid,
  'ar' || (user_id % 7) AS ar, 'ch' || (user_id % 4) AS ch, 'vc' || (user_id % 3) AS vc,
  CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new, event_type AS kind,
  CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'good_list'
    WHEN 'signup' THEN 'home' WHEN 'purchase' THEN 'payment' END AS page_id,
  CASE WHEN event_type NOT IN ('signup', 'view', 'error') THEN 'home' END AS last_page_id,
  CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS item,
  CASE WHEN event_type <> 'error'
    THEN CAST(floor(CAST(value AS DECIMAL(18,2)) * 1000) AS BIGINT) END AS during_time
FROM events"""

TABLES["page"] = "SELECT * FROM log WHERE kind <> 'error'"

TABLES["display"] = """
SELECT l.ts, l.page_id, l.mid, l.vc, CAST((l.rec_id * 7 + n.i) % 100 AS VARCHAR) AS item,
  CASE WHEN n.i % 2 = 1 THEN 'sku_id' ELSE 'promotion_id' END AS item_type, n.i AS "order"
FROM log l JOIN (SELECT unnest(range(1, 5)) AS i) n ON n.i <= l.rec_id % 4 + 1
WHERE l.kind <> 'error' AND l.rec_id % 5 <> 0"""

TABLES["numbered"] = """
SELECT *, row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, rec_id) AS nth_of_day,
  lead(ts) OVER w AS next_ts,
  lead(coalesce(last_page_id, '') = '') OVER w AS next_is_entry
FROM page WINDOW w AS (PARTITION BY mid ORDER BY ts, rec_id)"""

TABLES["first_visit"] = "SELECT * EXCLUDE (nth_of_day, next_ts, next_is_entry) FROM numbered WHERE nth_of_day = 1"

TABLES["bounce"] = f"""
SELECT * EXCLUDE (nth_of_day, next_ts, next_is_entry) FROM numbered
WHERE coalesce(last_page_id, '') = ''
  AND (next_ts IS NULL OR next_ts - ts >= {SIX_HOURS} OR next_is_entry)"""

# Places of the nearest later product page and payment page of each page of a device.
TABLES["walk"] = """
SELECT rec_id, ts, mid, page_id, nth,
  min(CASE WHEN page_id = 'good_detail' THEN nth END) OVER later AS next_product,
  min(CASE WHEN page_id = 'payment' THEN nth END) OVER later AS next_payment
FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, rec_id) AS nth FROM page)
WINDOW later AS (PARTITION BY mid ORDER BY nth ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""

TABLES["slow_bounce"] = f"""
SELECT * EXCLUDE (nth_of_day, next_ts, next_is_entry) FROM numbered
WHERE coalesce(last_page_id, '') = '' AND (next_ts IS NULL OR next_ts - ts >= {SIX_HOURS})"""

_HOURLY = bounds(from_ms("ts"), "1 hour")
TABLES["visitor"] = f"""
SELECT {_HOURLY}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
  CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
  CAST(sum(dur) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM (
  SELECT ts, vc, ch, ar, is_new, 0 AS uv, 1 AS pv, 0 AS sv, 0 AS uj, during_time AS dur FROM page
  UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM first_visit
  UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 1, 0, 0 FROM page WHERE coalesce(last_page_id, '') = ''
  UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM bounce)
GROUP BY 1, 2, 3, 4, 5, 6"""

TABLES["oi"] = f"""
SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
  o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(20,2)) AS total_amount,
  CAST(o_orderkey % 10 AS DECIMAL(20,2)) AS activity_reduce_amount,
  CAST(o_orderkey % 5 AS DECIMAL(20,2)) AS coupon_reduce_amount,
  CAST(o_totalprice AS DECIMAL(20,2)) + CAST(o_orderkey % 10 AS DECIMAL(20,2))
    + CAST(o_orderkey % 5 AS DECIMAL(20,2)) AS original_total_amount,
  CAST(o_orderkey % 20 AS DECIMAL(20,2)) AS feight_fee,
  {label("o_orderdate + INTERVAL 15 MINUTE")} AS expire_time,
  {label("o_orderdate")} AS create_time, o_orderdate AS ct
FROM orders"""

TABLES["od"] = """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
  CAST(l_extendedprice AS DECIMAL(20,2)) AS price, CAST(l_quantity AS BIGINT) AS sku_num,
  'line ' || l_partkey AS sku_name, CAST(l_linenumber AS DECIMAL(20,2)) AS split_activity_amount,
  CAST(l_linenumber % 3 AS DECIMAL(20,2)) AS split_coupon_amount, l_shipdate AS ct
FROM lineitem"""

TABLES["base"] = """
SELECT od.id AS detail_id, od.order_id, od.sku_id, od.price AS order_price, od.sku_num, od.sku_name,
  oi.province_id, oi.order_status, oi.user_id, oi.total_amount, oi.activity_reduce_amount,
  oi.coupon_reduce_amount, oi.original_total_amount, oi.feight_fee,
  CAST(NULL AS DECIMAL(20,2)) AS split_feight_fee, od.split_activity_amount,
  od.split_coupon_amount, od.price AS split_total_amount, oi.expire_time, oi.create_time,
  CAST(NULL AS VARCHAR) AS operate_time, substr(oi.create_time, 1, 10) AS create_date,
  substr(oi.create_time, 12, 2) AS create_hour, oi.ct
FROM oi JOIN od ON od.order_id = oi.id
  AND od.ct BETWEEN oi.ct - INTERVAL 30 DAY AND oi.ct + INTERVAL 30 DAY"""

TABLES["owide"] = f"""
SELECT b.* EXCLUDE (sku_name, order_price), p.p_name AS sku_name,
  CAST(p.p_retailprice AS DECIMAL(20,2)) AS order_price,
  n.n_name AS province_name, r.r_name AS province_area_code, 'ISO-' || n.n_nationkey AS province_iso_code,
  'CN-' || n.n_nationkey AS province_3166_2_code,
  CAST((epoch_ms(TIMESTAMP '{AS_OF}')
    - epoch_ms(CAST(DATE '1960-01-01' + CAST(c.c_custkey % 15000 AS INTEGER) AS TIMESTAMP)))
    // 86400000 // 365 AS INTEGER) AS user_age,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'F' WHEN c.c_custkey % 2 = 1 THEN 'M' END AS user_gender,
  p.p_partkey // 4 AS spu_id, CAST(substr(p.p_brand, 7) AS BIGINT) AS tm_id,
  CAST(ascii(p.p_type) * 1000 + length(p.p_type) AS BIGINT) AS category3_id,
  s.spu_name, p.p_brand AS tm_name, p.p_type AS category3_name
FROM base b LEFT JOIN part p ON p.p_partkey = b.sku_id
  LEFT JOIN (SELECT p_partkey // 4 AS spu_id, min(p_name) AS spu_name FROM part GROUP BY 1) s
    ON s.spu_id = p.p_partkey // 4
  LEFT JOIN customer c ON c.c_custkey = b.user_id
  LEFT JOIN nation n ON n.n_nationkey = b.province_id
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""

TABLES["pay"] = f"""
SELECT o_orderkey + 1000000000 AS id, o_orderkey AS order_id, o_custkey AS user_id,
  CAST(o_totalprice AS DECIMAL(20,2)) AS total_amount, 'order ' || o_orderkey AS subject,
  o_orderpriority AS payment_type, ct, {label("ct")} AS create_time,
  {label("ct + INTERVAL 5 SECOND")} AS callback_time
FROM (SELECT *, o_orderdate + to_minutes(CAST(o_orderkey % 60 AS BIGINT)) AS ct
      FROM orders)"""

_PAID = """w.ct BETWEEN pay.ct - INTERVAL 45 MINUTE AND pay.ct + INTERVAL 5 SECOND"""
TABLES["pwide"] = f"""
SELECT pay.id AS payment_id, pay.subject, pay.payment_type, pay.create_time AS payment_create_time,
  pay.callback_time, pay.user_id, pay.total_amount, w.create_time AS order_create_time,
  w.* EXCLUDE (user_id, total_amount, create_time, expire_time, operate_time, create_date, create_hour, ct)
FROM pay JOIN owide w ON w.order_id = pay.order_id AND {_PAID}"""

TABLES["shop"] = f"""
SELECT event_id AS id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id,
  epoch_ms(date_trunc('second', ts)) AS ts, CAST(value AS DECIMAL(20,2)) AS amount
FROM events"""

_GRADE = "CASE WHEN 1200 + id % 6 IN (1204, 1205) THEN 1 ELSE 0 END"
_ZERO = dict(display=0, click=0, favor=0, cart=0, num=0, oamt=0, pamt=0, ramt=0, cmt=0, good=0,
             oid="NULL", pid="NULL", rid="NULL")


def _fact(source: str, sku: str, ts: str, **given: str) -> str:
    cols = ", ".join(f"{value} AS {name}" for name, value in {**_ZERO, **given}.items())
    return f"SELECT {sku} AS sku_id, {ts} AS ts, {cols} FROM {source}"


TABLES["fact"] = "\nUNION ALL ".join([
    _fact("page WHERE page_id = 'good_detail'", "CAST(item AS BIGINT)", "ts", click="1"),
    _fact("display WHERE item_type = 'sku_id'", "CAST(item AS BIGINT)", "ts", display="1"),
    _fact("shop WHERE kind = 'view'", "sku_id", "ts", favor="1"),
    _fact("shop WHERE kind = 'click'", "sku_id", "ts", cart="1"),
    _fact("base", "sku_id", "epoch_ms(ct)", oamt="split_total_amount", num="sku_num", oid="order_id"),
    _fact(f"(SELECT w.sku_id, pay.ct AS pct, w.split_total_amount, w.order_id FROM pay JOIN base w "
          f"ON w.order_id = pay.order_id AND {_PAID})",
          "sku_id", "epoch_ms(pct)", pamt="split_total_amount", pid="order_id"),
    _fact("shop WHERE kind = 'purchase'", "sku_id", "ts", ramt="amount", rid="id % 50"),
    _fact("shop WHERE kind = 'signup'", "sku_id", "ts", cmt="1", good=_GRADE),
])

TABLES["pstat"] = f"""
SELECT {bounds(from_ms("ts"), "6 hours")}, sku_id,
  CAST(sum(display) AS BIGINT) AS display_ct, CAST(sum(click) AS BIGINT) AS click_ct,
  CAST(sum(favor) AS BIGINT) AS favor_ct, CAST(sum(cart) AS BIGINT) AS cart_ct,
  CAST(sum(num) AS BIGINT) AS order_sku_num, sum(oamt) AS order_amount,
  count(DISTINCT oid) AS order_ct, sum(pamt) AS payment_amount, count(DISTINCT pid) AS paid_order_ct,
  count(DISTINCT rid) AS refund_order_ct, sum(ramt) AS refund_amount,
  CAST(sum(cmt) AS BIGINT) AS comment_ct, CAST(sum(good) AS BIGINT) AS good_comment_ct, min(ts) AS ts
FROM fact GROUP BY 1, 2, 3"""

TABLES["product"] = """
SELECT t.*, p.p_name AS sku_name, CAST(p.p_retailprice AS DECIMAL(20,2)) AS sku_price,
  p.p_partkey // 4 AS spu_id, s.spu_name, CAST(substr(p.p_brand, 7) AS BIGINT) AS tm_id,
  p.p_brand AS tm_name, CAST(ascii(p.p_type) * 1000 + length(p.p_type) AS BIGINT) AS category3_id,
  p.p_type AS category3_name
FROM pstat t LEFT JOIN part p ON p.p_partkey = t.sku_id
  LEFT JOIN (SELECT p_partkey // 4 AS spu_id, min(p_name) AS spu_name FROM part GROUP BY 1) s
    ON s.spu_id = p.p_partkey // 4"""

TABLES["province"] = f"""
SELECT {bounds("ct", "1 day")}, province_id, province_name, province_area_code AS area_code,
  province_iso_code AS iso_code, province_3166_2_code AS iso_3166_2,
  sum(split_total_amount) AS order_amount, count(DISTINCT order_id) AS order_count,
  CAST({AS_OF_MS} AS BIGINT) AS ts
FROM owide GROUP BY 1, 2, 3, 4, 5, 6, 7"""

TABLES["word"] = r"""
SELECT TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS et,
  unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS word
FROM documents"""

TABLES["searched"] = f"""
SELECT {bounds("et", "1 day")}, word AS keyword, 'search' AS source, count(*) AS ct,
  CAST({AS_OF_MS} AS BIGINT) AS ts
FROM word GROUP BY 1, 2, 3"""

TABLES["pword"] = r"""
SELECT stt, edt, word, sum(click_ct) AS click_ct, sum(order_ct) AS order_ct, sum(cart_ct) AS cart_ct
FROM (SELECT stt, edt, click_ct, order_ct, cart_ct,
        unnest(list_distinct(regexp_extract_all(lower(sku_name), '[\p{L}\p{N}]+'))) AS word
      FROM product WHERE click_ct > 0 OR order_ct > 0 OR cart_ct > 0)
GROUP BY 1, 2, 3"""

TABLES["pkey"] = f"""
SELECT stt, edt, word AS keyword, source, CAST(ct AS BIGINT) AS ct, CAST({AS_OF_MS} AS BIGINT) AS ts
FROM (SELECT stt, edt, word, 'click' AS source, click_ct AS ct FROM pword
      UNION ALL SELECT stt, edt, word, 'order', order_ct FROM pword
      UNION ALL SELECT stt, edt, word, 'cart', cart_ct FROM pword)
WHERE ct > 0"""

TABLES["change"] = """
SELECT 'order_info' AS "table", o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id,
  CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status, o_orderpriority AS note,
  NULL AS name, NULL AS segment FROM orders
UNION ALL SELECT 'user_info', c_custkey, CAST(c_custkey AS VARCHAR), NULL, NULL, NULL, c_name,
  c_mktsegment FROM customer"""

TABLES["clean"] = """
SELECT *, CASE k % 7 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'bootstrap-insert'
  ELSE 'insert' END AS type
FROM change WHERE k % 7 IN (0, 1, 2, 6) AND k % 11 <> 10"""

TABLES["routed"] = """
SELECT *, CASE WHEN "table" = 'user_info' THEN 'dim_user_info' WHEN type = 'update'
  THEN 'dwd_order_update' ELSE 'dwd_order_info' END AS sink_table,
  CASE WHEN "table" = 'user_info' THEN 'hbase' ELSE 'kafka' END AS sink_type
FROM clean"""

_EDIT = """
SELECT '{name}' AS "table", CASE WHEN {key} % 2 = 0 THEN 'insert' ELSE 'update' END AS operate_type,
  CASE WHEN {key} % 3 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type, '{topic}_' || ({key} % 13) AS sink_table,
  CASE WHEN {key} % 10 <> 0 THEN {key} + 1600000000 - {key} % 5 ELSE -9223372036854775808 END AS at_, {key} AS seq
FROM {given} WHERE {key} % 10 <> 9"""
TABLES["edit"] = "\nUNION ALL ".join([
    _EDIT.format(name="order_info", key="o_orderkey", topic="orders", given="orders"),
    _EDIT.format(name="user_info", key="c_custkey", topic="users", given="customer")])

# Of edits at one time the last one counts.
TABLES["in_force"] = """
SELECT "table", operate_type, at_, arg_max(sink_type, seq) AS sink_type, arg_max(sink_table, seq) AS sink_table
FROM edit GROUP BY ALL"""

# Which common tables each one reads.
NEEDS: dict[str, tuple[str, ...]] = {
    "page": ("log",), "display": ("log",), "numbered": ("page",), "first_visit": ("numbered",),
    "bounce": ("numbered",), "walk": ("page",), "slow_bounce": ("numbered",),
    "visitor": ("page", "first_visit", "bounce"), "base": ("oi", "od"), "owide": ("base",),
    "pwide": ("pay", "owide"), "fact": ("page", "display", "shop", "base", "pay"),
    "pstat": ("fact",), "product": ("pstat",), "province": ("owide",), "searched": ("word",),
    "pword": ("product",), "pkey": ("pword",), "clean": ("change",), "routed": ("clean",),
    "in_force": ("edit",),
}

PAGE_COLUMNS = "rec_id, ts, mid, is_new, page_id, last_page_id, item, during_time"
WIDE_COLUMNS = """* EXCLUDE (ct) REPLACE (CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount,
  CAST(original_total_amount AS DOUBLE) AS original_total_amount, CAST(feight_fee AS DOUBLE) AS feight_fee,
  CAST(split_feight_fee AS DOUBLE) AS split_feight_fee,
  CAST(split_activity_amount AS DOUBLE) AS split_activity_amount,
  CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
  CAST(split_total_amount AS DOUBLE) AS split_total_amount, CAST(order_price AS DOUBLE) AS order_price)"""
PRODUCT_COLUMNS = """* REPLACE (CAST(order_amount AS DOUBLE) AS order_amount,
  CAST(payment_amount AS DOUBLE) AS payment_amount, CAST(refund_amount AS DOUBLE) AS refund_amount,
  CAST(sku_price AS DOUBLE) AS sku_price)"""
DAY_OF_STT = "CAST(replace(substr(stt, 1, 10), '-', '') AS INTEGER)"
VISITS = "CAST(sum(pv_ct) AS BIGINT) AS pv, CAST(sum(uv_ct) AS BIGINT) AS uv, CAST(sum(uj_ct) AS BIGINT) AS uj"


def _top(source: str, name: str, measure: str, alias: str, limit: int) -> str:
    return f"""
SELECT dt, {name}, {alias} FROM (
  SELECT *, row_number() OVER (PARTITION BY dt ORDER BY {alias} DESC, {name} ASC NULLS FIRST) AS n
  FROM (SELECT {DAY_OF_STT} AS dt, {name}, {measure} AS {alias} FROM {source} GROUP BY 1, 2))
WHERE n <= {limit}"""


_AMOUNT = "CAST(sum(order_amount) AS DOUBLE)"
_EMPTY_DIMS = ", ".join(
    f"CAST(NULL AS {kind}) AS {name}" for kind, names in {
        "VARCHAR": ("province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
                    "user_gender", "spu_name", "tm_name", "category3_name"),
        "BIGINT": ("spu_id", "tm_id", "category3_id"), "INTEGER": ("user_age",)}.items() for name in names)

# query -> (common tables, final select)
FINAL: dict[str, tuple[tuple[str, ...], str]] = {
    "json_log_scan": (("log",), f"SELECT {PAGE_COLUMNS}, {label(from_ms('ts // 1000 * 1000'))} AS et FROM log"),
    "config_latest": ((), """
SELECT source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend FROM (
  SELECT 'table_' || o_custkey AS source_table,
    CASE WHEN o_orderkey % 2 = 0 THEN 'insert' ELSE 'update' END AS operate_type,
    CASE WHEN o_orderstatus = 'P' THEN 'hbase' ELSE 'kafka' END AS sink_type,
    'sink_' || (o_orderkey % 40) AS sink_table, 'id,c' || (o_orderkey % 9) AS sink_columns,
    CASE WHEN o_orderkey % 3 = 0 THEN 'id' END AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend,
    row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderkey DESC) AS n
  FROM orders WHERE o_orderkey % 10 <> 9)
WHERE n = 1"""),
    "sql_with_args": (("oi",), """
SELECT order_status, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS total FROM oi
WHERE create_time >= '1996-01-01 00:00:00' AND user_id <> 7 GROUP BY order_status"""),
    "dim_upsert": (("routed",), """
SELECT CAST(c_custkey AS VARCHAR) AS id, coalesce(r.name, '') AS name
FROM customer LEFT JOIN (SELECT * FROM routed WHERE sink_type = 'hbase') r ON r.k = c_custkey"""),
    "to_json_rows": (("pay",), """
SELECT '{"id":' || id || ',"order_id":' || order_id || ',"payment_type":"' || payment_type
  || '","create_time":"' || create_time || '"'
  || CASE WHEN id % 2 = 0 THEN ',"subject":"' || subject || '"' ELSE '' END || '}' AS value FROM pay"""),
    "cdc_clean": (("clean",), """
SELECT 'shop' AS database, "table", type, k + 1600000000 AS ts, k AS xid FROM clean"""),
    "cdc_prune_columns": (("routed",), """
SELECT "table", k AS xid, sink_table, id,
  CAST(CASE sink_table WHEN 'dwd_order_info' THEN 3 ELSE 2 END AS INTEGER) AS n_columns,
  CASE WHEN sink_table = 'dwd_order_info' THEN user_id END AS user_id,
  order_status, name, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS segment FROM routed"""),
    "cdc_routes_as_of": (("clean", "in_force"), """
SELECT c."table", replace(c.type, 'bootstrap-', '') AS operate_type, c.k + 1600000000 AS ts, c.k AS xid, f.sink_type,
  f.sink_table, CAST(2 AS INTEGER) AS n_columns, c.id
FROM (SELECT *, replace(type, 'bootstrap-', '') AS operate_type, k + 1600000000 AS ts FROM clean) c
ASOF JOIN in_force f ON c."table" = f."table" AND c.operate_type = f.operate_type AND c.ts >= f.at_"""),
    "cdc_route_counts": (("routed",), "SELECT sink_type, sink_table, count(*) AS n FROM routed GROUP BY 1, 2"),
    "log_split_counts": (("log", "display"), """
SELECT CASE kind WHEN 'error' THEN 'start' ELSE 'page' END AS stream, count(*) AS n FROM log GROUP BY 1
UNION ALL SELECT 'display', count(*) FROM display"""),
    "display_explode": (("display",), "SELECT * FROM display"),
    "session_entries": (("page",), f"SELECT {PAGE_COLUMNS} FROM page WHERE coalesce(last_page_id, '') = ''"),
    "product_clicks": (("page",), "SELECT CAST(item AS BIGINT) AS sku_id, ts FROM page WHERE page_id = 'good_detail'"),
    "product_displays": (("display",), "SELECT CAST(item AS BIGINT) AS sku_id, ts FROM display WHERE item_type = 'sku_id'"),
    "good_comments": (("shop",), f"""
SELECT sku_id, count(*) AS comment_ct, CAST(sum({_GRADE}) AS BIGINT) AS good_comment_ct
FROM shop WHERE kind = 'signup' GROUP BY 1"""),
    "search_keywords": (("word",), f"SELECT {label('et')} AS et, word FROM word"),
    "any_positive": (("product",), """
SELECT stt, edt, sku_id, sku_name, click_ct, order_ct, cart_ct FROM product
WHERE click_ct > 0 OR order_ct > 0 OR cart_ct > 0"""),
    "coalesce_merge": (("oi",), "SELECT id, order_status, CAST(total_amount AS DOUBLE) AS total_amount, user_id FROM oi"),
    "scalar_time_functions": ((), f"""
SELECT o_orderkey, {label("make_timestamp((epoch_ms(o_orderdate) + o_orderkey) // 1000 * 1000000)")} AS whole_second,
  epoch_ms(o_orderdate) AS millis, CASE WHEN o_orderkey % 2 = 0 THEN epoch_ms(o_orderdate) END AS checked,
  CAST({AS_OF_MS} AS BIGINT) AS now_ms, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
  strftime(o_orderdate, '%H') AS create_hour,
  CAST(({AS_OF_MS} - epoch_ms(o_orderdate)) // 86400000 // 365 AS INTEGER) AS age,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_number,
  CAST(hour(make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000)) AS INTEGER) AS hour,
  strftime(make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000), '%H') AS hour_label,
  lower(o_orderstatus) AS plain_type
FROM orders"""),
    "scalar_text_functions": (("log",), """
SELECT rec_id, coalesce(item, 'none') AS item, coalesce(contains(page_id, 'good'), false) AS has_good,
  coalesce(length(page_id), 0) > 4 AS is_long, last_page_id IS NULL AS is_entry,
  last_page_id IS NOT NULL AS is_next, coalesce(page_id IN ('home', 'good_list'), false) AS is_listed,
  'DIM_USER_INFO:' || mid AS cache_key, coalesce(CAST(during_time AS VARCHAR), '') AS during_text,
  coalesce(last_page_id, page_id, 'start') AS first_known FROM log"""),
    "order_wide_base": (("base",), f"SELECT {WIDE_COLUMNS}, {_EMPTY_DIMS} FROM base"),
    "order_wide": (("owide",), f"SELECT {WIDE_COLUMNS} FROM owide"),
    "order_lines_hot_key": (("oi", "od"), """
SELECT strftime(oi.ct, '%Y-%m-%d') AS create_date, oi.order_status, count(*) AS n_pairs,
  CAST(sum(od.price) AS DOUBLE) AS amount, CAST(sum(oi.total_amount) AS DOUBLE) AS total
FROM oi JOIN od ON CASE WHEN oi.id % 2 = 0 THEN 0 ELSE oi.id END = CASE WHEN od.order_id % 2 = 0 THEN 0 ELSE od.order_id END
  AND od.ct BETWEEN oi.ct - INTERVAL 1 DAY AND oi.ct + INTERVAL 1 DAY GROUP BY 1, 2"""),
    "payment_wide": (("pwide",), f"SELECT {WIDE_COLUMNS.replace(' EXCLUDE (ct)', '')} FROM pwide"),
    "repair_is_new": (("log",), """
SELECT rec_id, ts, mid, page_id, last_page_id, item, during_time, CASE WHEN row_number()
  OVER (PARTITION BY mid ORDER BY ts, rec_id) = 1 THEN '1' ELSE '0' END AS is_new FROM log"""),
    "daily_first_visit": (("first_visit",), f"SELECT {PAGE_COLUMNS} FROM first_visit"),
    "funnel_three_steps": (("walk",), f"""
SELECT rec_id, ts, mid, CASE WHEN payment_id IS NOT NULL THEN 'match' ELSE 'timeout' END AS outcome,
  CAST(1 + CAST(product_id IS NOT NULL AS INTEGER) + CAST(payment_id IS NOT NULL AS INTEGER) AS INTEGER) AS reached,
  product_id, payment_id
FROM (SELECT l.rec_id, l.ts, l.mid, CASE WHEN p.ts - l.ts < {SIX_HOURS} THEN p.rec_id END AS product_id,
        CASE WHEN y.ts - l.ts < {SIX_HOURS} THEN y.rec_id END AS payment_id
      FROM walk l LEFT JOIN walk p ON p.mid = l.mid AND p.nth = l.next_product
      LEFT JOIN walk y ON y.mid = p.mid AND y.nth = p.next_payment
      WHERE l.page_id = 'good_list')"""),
    "jump_timeout_only": (("slow_bounce",), f"SELECT {PAGE_COLUMNS} FROM slow_bounce"),
    "jump_detail": (("bounce",), f"SELECT {PAGE_COLUMNS} FROM bounce"),
    "visitor_stats": (("visitor",), "SELECT * FROM visitor"),
    "product_stats": (("product",), f"SELECT {PRODUCT_COLUMNS} FROM product"),
    "province_stats": (("province",), "SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount) FROM province"),
    "keyword_stats": (("searched",), "SELECT * FROM searched"),
    "product_keywords": (("pkey",), "SELECT * FROM pkey"),
    "gmv_total": (("product",), f"SELECT {DAY_OF_STT} AS dt, {_AMOUNT} AS order_amount FROM product GROUP BY 1"),
    "gmv_by_brand": (("product",), _top("product", "tm_name", _AMOUNT, "order_amount", 5)),
    "gmv_by_category": (("product",), _top("product", "category3_name", _AMOUNT, "order_amount", 5)),
    "gmv_by_spu": (("product",), _top("product", "spu_name", _AMOUNT, "order_amount", 100)),
    "province_map": (("province",), f"""
SELECT {DAY_OF_STT} AS dt, province_name, {_AMOUNT} AS order_amount,
  CAST(sum(order_count) AS BIGINT) AS order_count FROM province GROUP BY 1, 2"""),
    "visitor_by_hour": (("visitor",), f"""
SELECT {DAY_OF_STT} AS dt, CAST(substr(stt, 12, 2) AS INTEGER) AS hour, {VISITS} FROM visitor GROUP BY 1, 2"""),
    "visitor_by_is_new": (("visitor",), f"SELECT {DAY_OF_STT} AS dt, is_new, {VISITS} FROM visitor GROUP BY 1, 2"),
    "visitor_24h": (("visitor",), f"""
SELECT d.dt, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hour, coalesce(v.pv, 0) AS pv, coalesce(v.uv, 0) AS uv,
  coalesce(v.uj, 0) AS uj
FROM (SELECT DISTINCT {DAY_OF_STT} AS dt FROM visitor) d CROSS JOIN (SELECT unnest(range(24)) AS h) h
LEFT JOIN (SELECT {DAY_OF_STT} AS dt, CAST(substr(stt, 12, 2) AS INTEGER) AS h, {VISITS}
           FROM visitor GROUP BY 1, 2) v ON v.dt = d.dt AND v.h = h.h"""),
    "keyword_score": (("searched", "pkey"), _top(
        "(SELECT * FROM searched UNION ALL SELECT * FROM pkey)", "keyword",
        "CAST(sum(ct * CASE source WHEN 'search' THEN 10 WHEN 'click' THEN 8 WHEN 'order' THEN 5 ELSE 2 END) AS BIGINT)",
        "score", 10)),
}


def sql_text(needed: tuple[str, ...], final: str) -> str:
    """The final select behind every common table it needs, each after those it reads itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    with_part = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in ordered)
    return f"WITH {with_part}\n{final.strip()}" if ordered else final.strip()




def _last_day(name: str) -> tuple[tuple[str, ...], str]:
    """The answers about every day, less all days but the last."""
    needed, final = FINAL[name]
    return needed, f"SELECT * EXCLUDE (dt) FROM ({final.strip()}) q QUALIFY dt = max(dt) OVER ()"


FINAL |= {f"{name}_day": _last_day(name) for name in ("gmv_by_brand", "visitor_24h", "keyword_score")}
# The position of a line is the id that the other form has in the line itself.
FINAL["repair_is_new_raw"] = FINAL["repair_is_new"]


def table_sql() -> dict[str, str]:
    return {name: sql_text(needed, final) for name, (needed, final) in FINAL.items()}


# Arrival rounds cut the span of arrival times into three equal parts.
LATE_ROWS = f"""
SELECT rec_id, ts, mid FROM (
  SELECT *, (SELECT max(e.ts) FROM rounds e WHERE e.round < r.round) AS high FROM rounds r)
WHERE (ts // 3600000 + 1) * 3600000 <= high - 5000"""
TABLES["arrival"] = f"""
SELECT *, ts + CASE WHEN rec_id % 10 = 3 THEN {LATE_AFTER} ELSE 0 END AS arrived FROM log"""
TABLES["rounds"] = """
SELECT a.*, CAST(arrived >= low + step AS INTEGER) + CAST(arrived >= low + 2 * step AS INTEGER) AS round
FROM arrival a, (SELECT min(arrived) AS low, (max(arrived) - min(arrived)) // 3 AS step FROM arrival)"""
NEEDS["arrival"] = ("log",)
NEEDS["rounds"] = ("arrival",)


def stream_sql() -> dict[str, str]:
    tables = table_sql()
    return {
        **{stream: tables[table] for stream, table in TWINS.items()},
        "stream_cdc_routes": sql_text(("routed",), """
SELECT sink_table AS topic, count(*) AS n FROM routed WHERE sink_type = 'kafka' GROUP BY 1"""),
        "stream_dim_upsert": sql_text(("routed",), """
SELECT id, coalesce(name, '') AS name FROM routed WHERE sink_type = 'hbase'"""),
        "stream_keyword_rollup": sql_text(("pkey",), """
SELECT stt, edt, source, count(*) AS keyword_ct, CAST(sum(ct) AS BIGINT) AS ct,
  count(*) FILTER (ct >= 10) AS popular_ct FROM pkey GROUP BY 1, 2, 3"""),
        "late_rows": sql_text(("rounds",), LATE_ROWS),
    }
