"""SQL (DuckDB) over the given tables for every batch query, written without the change events."""

from __future__ import annotations

from brookmart.samples import RENAMED
from brookmart.schemas import TABLE_COLUMNS

DT = "'%Y-%m-%d %H:%M:%S'"
HOUR, DAY, MONTH, YEAR, MINUTE = 3600, 86400, 30 * 86400, 365 * 86400, 60


def dt(t: str) -> str:
    return f"strftime({t}, {DT})"


def win(ms: str, seconds: int) -> str:
    """stt and edt of the epoch-aligned window holding the epoch milliseconds ``ms``."""
    start = f"(({ms}) // {seconds * 1000}) * {seconds * 1_000_000}"
    return f"{dt(f'make_timestamp({start})')} AS stt, {dt(f'make_timestamp({start} + {seconds * 1_000_000})')} AS edt"


def full(table: str, given: dict[str, str]) -> str:
    """All columns of a source table: the given expressions, and nulls for the rest."""
    return ", ".join(f"{given.get(c, 'NULL::VARCHAR')} AS {c}" for c in TABLE_COLUMNS[table])


def money(x: str) -> str:
    return f"cast({x} AS DECIMAL(18,2))"


# ---- logs --------------------------------------------------------------------------------------

EV = """
ev AS (
  SELECT event_id AS seq, user_id, event_type AS kind, epoch_us(ts) // 1000 AS ts, json_extract(props, '$.k')::BIGINT AS k,
         'mid_' || user_id AS mid, 'ch' || (event_id % 4) AS ch, 'v' || (user_id % 3) AS vc, 'ar' || (user_id % 5) AS ar,
         CASE WHEN event_type IN ('view', 'signup') THEN '1' ELSE '0' END AS is_new,
         CASE event_type WHEN 'click' THEN 'home' WHEN 'purchase' THEN 'good_detail' WHEN 'signup' THEN 'login'
                         WHEN 'error' THEN 'search' END AS last_page_id,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'trade'
                         WHEN 'signup' THEN 'login' ELSE 'good_list' END AS page_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE user_id::VARCHAR END AS uid,
         CASE WHEN event_type = 'signup' THEN 0 ELSE json_extract(props, '$.k')::BIGINT * 1000 END AS during_time
  FROM events)"""


def repaired(source: str) -> str:
    return f"""
st AS (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN ts // 86400000 ELSE ts // 86400000 - 1 END)
            OVER (PARTITION BY mid ORDER BY ts, seq) AS first_day
  FROM {source}),
fixed AS (
  SELECT * EXCLUDE (is_new),
         CASE WHEN is_new = '1' AND ts // 86400000 <> first_day THEN '0' ELSE is_new END AS is_new
  FROM st)"""


GOOD = "good AS (SELECT * FROM ev WHERE seq % 25 <> 0)"
SHOWN = "CASE WHEN kind IN ('click', 'purchase') THEN k % 4 ELSE 0 END"

VISITS = """
uv AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, seq) AS rn
                 FROM ev WHERE last_page_id IS NULL) WHERE rn = 1)"""

BOUNCES = """
nx AS (
  SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_start
  FROM ev WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)),
uj AS (
  SELECT * FROM nx WHERE last_page_id IS NULL
  AND (next_ts IS NULL OR next_ts - ts >= 21600000 OR next_start))"""

LOGINS = """
ld AS (
  SELECT uid, ts // 86400000 AS day, min(ts) AS ts FROM ev
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login') GROUP BY 1, 2),
lg AS (
  SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY uid ORDER BY day) > 7 THEN 1 ELSE 0 END::BIGINT AS back_ct FROM ld)"""

# ---- trade -------------------------------------------------------------------------------------

CODES = """
code AS (
  SELECT * FROM (VALUES
    ('2401', 'search'), ('2402', 'promotion'), ('2403', 'recommendation'), ('1101', 'card'), ('1102', 'transfer'),
    ('1103', 'wallet'), ('1104', 'voucher'), ('1105', 'cash'), ('1001', 'unpaid'), ('1002', 'paid'),
    ('0701', 'requested'), ('0705', 'paid out'), ('1501', 'refund'), ('1502', 'return'), ('1301', 'quality'),
    ('1302', 'size'), ('1303', 'late'), ('1304', 'changed mind'), ('1305', 'other'), ('1201', 'good'),
    ('1202', 'fair'), ('1203', 'poor'), ('1204', 'none')) AS t(dic_code, dic_name))"""

PRICE, DISC, TAX = money("l_extendedprice"), "cast(l_discount AS DECIMAL(4,2))", "cast(l_tax AS DECIMAL(4,2))"
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_ms(l_shipdate))"

LINES = f"""
line AS (
  SELECT {full("order_detail", {
      "id": LINE_ID, "order_id": "l_orderkey::VARCHAR", "sku_id": "l_partkey::VARCHAR", "sku_name": "'sku ' || l_partkey",
      "order_price": f"{PRICE}::VARCHAR", "sku_num": "l_quantity::INT::VARCHAR", "create_time": dt("l_shipdate"),
      "source_type": "'240' || (l_linenumber % 3 + 1)", "source_id": "l_suppkey::VARCHAR",
      "split_total_amount": f"{money(f'{PRICE} * (1 - {DISC})')}::VARCHAR",
      "split_activity_amount": f"CASE WHEN {DISC} > 0 THEN {money(f'{PRICE} * {DISC}')}::VARCHAR END",
      "split_coupon_amount": f"CASE WHEN {TAX} > 0 THEN {money(f'{PRICE} * {TAX}')}::VARCHAR END",
  })}, epoch_ms(l_shipdate) AS ts FROM lineitem)"""

_ORDER = {
    "id": "o_orderkey::VARCHAR", "consignee": "'consignee ' || o_custkey", "total_amount": f"{money('o_totalprice')}::VARCHAR",
    "order_status": "status", "user_id": "o_custkey::VARCHAR", "payment_way": "substr(o_orderpriority, 1, 1)",
    "out_trade_no": "'T' || o_orderkey", "create_time": dt("o_orderdate"),
    "operate_time": f"CASE WHEN type = 'update' THEN {dt('o_orderdate + to_days(after)')} END",
    "province_id": "(o_custkey % 28)::VARCHAR", "original_total_amount": f"{money('o_totalprice')}::VARCHAR",
}

INFO = f"""
oc AS (
  SELECT *, 'insert' AS type, '1001' AS status, 0 AS after, false AS moved FROM orders
  UNION ALL SELECT *, 'update', '1003', 1, true FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT *, 'update', '1005', 2, true FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT *, 'update', '1006', 3, true FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0
  UNION ALL SELECT *, 'update', '1003', 4, false FROM orders WHERE o_orderstatus = 'O'),
info AS (
  SELECT {full("order_info", _ORDER)}, type, moved, epoch_ms(o_orderdate + to_days(after)) AS change_ts FROM oc)"""

WIDE = f"""{CODES}, {LINES}, {INFO},
act AS (SELECT {LINE_ID} AS order_detail_id, (l_partkey % 10)::VARCHAR AS activity_id,
               (l_suppkey % 10)::VARCHAR AS activity_rule_id FROM lineitem WHERE l_discount > 0.05::DOUBLE),
cpn AS (SELECT {LINE_ID} AS order_detail_id, (l_partkey % 7)::VARCHAR AS coupon_id,
               (l_suppkey % 7)::VARCHAR AS coupon_use_id FROM lineitem WHERE l_tax > 0.04::DOUBLE),
wide AS (
  SELECT line.*, activity_id, activity_rule_id, coupon_id, coupon_use_id, info.* EXCLUDE (id, create_time),
         dic_name AS source_name
  FROM line LEFT JOIN act ON line.id = act.order_detail_id LEFT JOIN cpn ON line.id = cpn.order_detail_id
  JOIN info ON line.order_id = info.id JOIN code ON source_type = dic_code),
placed AS (SELECT * EXCLUDE (type, moved) FROM wide WHERE type = 'insert')"""

PAID = f"""
pay AS (
  SELECT o_orderkey::VARCHAR AS paid_order_id, 'P' || o_orderkey AS payment_out_trade_no,
         o_custkey::VARCHAR AS payment_user_id, '110' || substr(o_orderpriority, 1, 1) AS payment_type,
         'N' || o_orderkey AS trade_no, {money('o_totalprice')}::VARCHAR AS payment_total_amount, 'order' AS subject,
         '1002' AS payment_status, {dt('o_orderdate')} AS payment_create_time,
         {dt('o_orderdate + to_days(1)')} AS callback_time, NULL::VARCHAR AS callback_content,
         epoch_ms(o_orderdate + to_days(1)) AS payment_ts
  FROM orders WHERE o_orderstatus = 'F'),
paid AS (
  SELECT placed.*, pay.* EXCLUDE (paid_order_id), c1.dic_name AS payment_status_name, c2.dic_name AS payment_type_name
  FROM placed JOIN pay ON order_id = paid_order_id JOIN code c1 ON payment_status = c1.dic_code
  JOIN code c2 ON payment_type = c2.dic_code)"""

_REFUND = {
    "id": LINE_ID, "user_id": "l_suppkey::VARCHAR", "order_id": "l_orderkey::VARCHAR", "sku_id": "l_partkey::VARCHAR",
    "refund_type": "'150' || (l_linenumber % 2 + 1)", "refund_num": "l_quantity::INT::VARCHAR",
    "refund_amount": f"{PRICE}::VARCHAR", "refund_reason_type": "'130' || (l_partkey % 5 + 1)",
    "refund_reason_txt": "'reason ' || (l_partkey % 9)", "refund_status": "status", "create_time": dt("l_shipdate"),
}

REQUESTS = f"""
rc AS (
  SELECT *, 'insert' AS type, '0701' AS status, 0 AS after FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT *, 'update', '0705', 1 FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
req AS (SELECT {full("order_refund_info", _REFUND)}, type, epoch_ms(l_shipdate + to_days(after)) AS ts FROM rc)"""

REFUND_WIDE = f"""{REQUESTS},
rw AS (
  SELECT placed.*, req.user_id AS refund_user_id, refund_type, refund_num, refund_amount, refund_reason_type,
         refund_reason_txt, refund_status, req.create_time AS refund_create_time, req.ts AS refund_ts, req.type AS type,
         dic_name AS refund_status_name
  FROM placed JOIN req ON placed.order_id = req.order_id AND placed.sku_id = req.sku_id
  JOIN code ON refund_status = dic_code)"""

REFUND_PAID = f"""
rp AS (
  SELECT {LINE_ID} AS id, 'R' || l_orderkey AS refund_out_trade_no, l_orderkey::VARCHAR AS order_id,
         l_partkey::VARCHAR AS sku_id, '110' || (l_suppkey % 3 + 1) AS payment_type, 'RN' || l_orderkey AS trade_no,
         {PRICE}::VARCHAR AS refund_total_amount, 'refund' AS subject, '0705' AS paid_status,
         {dt('l_shipdate + to_days(2)')} AS callback_time, NULL::VARCHAR AS callback_content,
         epoch_ms(l_shipdate + to_days(2)) AS paid_ts
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')"""

_NEWEST = "change_ts DESC, ts DESC, " + ", ".join(
    f"{c} DESC NULLS LAST" for c in ("sku_id", "order_price", "sku_num", "split_total_amount", "split_activity_amount",
                                     "split_coupon_amount", "activity_id", "coupon_id"))
NEWEST = f"""
newest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_NEWEST}) AS rn FROM placed) WHERE rn = 1)"""

DIMS = """
sku_dim AS (SELECT p_partkey::VARCHAR AS id, p_name AS sku_name, p_size::VARCHAR AS category3_id,
                   split_part(p_brand, '#', 2) AS trademark_id, (p_partkey % 50)::VARCHAR AS spu_id FROM part),
spu_dim AS (SELECT DISTINCT (p_partkey % 50)::VARCHAR AS id, 'spu ' || (p_partkey % 50) AS spu_name FROM part),
c3_dim AS (SELECT DISTINCT p_size::VARCHAR AS id, 'category ' || p_size AS category3_name,
                  (p_size % 10)::VARCHAR AS category2_id FROM part WHERE p_size <> 13),
c2_dim AS (SELECT DISTINCT (p_size % 10)::VARCHAR AS id, 'group ' || (p_size % 10) AS category2_name,
                  (p_size % 10 % 3)::VARCHAR AS category1_id FROM part),
c1_dim AS (SELECT DISTINCT (p_size % 10 % 3)::VARCHAR AS id, 'section ' || (p_size % 10 % 3) AS category1_name FROM part),
tm_dim AS (SELECT DISTINCT split_part(p_brand, '#', 2) AS id, p_brand AS trademark_name FROM part)"""

_CATEGORIES = """
  LEFT JOIN c3_dim ON category3_id = c3_dim.id LEFT JOIN c2_dim ON category2_id = c2_dim.id
  LEFT JOIN c1_dim ON category1_id = c1_dim.id LEFT JOIN tm_dim ON trademark_id = tm_dim.id"""

_LINE_AMOUNTS = f"""
  {money('cast(order_price AS DECIMAL(18,2)) * cast(sku_num AS DECIMAL(10,0))')} AS original_amount,
  coalesce(cast(split_activity_amount AS DECIMAL(18,2)), 0) AS activity_amount,
  coalesce(cast(split_coupon_amount AS DECIMAL(18,2)), 0) AS coupon_amount,
  coalesce(cast(split_total_amount AS DECIMAL(18,2)), 0) AS order_amount"""
_AMOUNTS = ("original_amount", "activity_amount", "coupon_amount", "order_amount")


def sku_result(agg: str) -> str:
    return f"""
WITH {WIDE}, {NEWEST}, {DIMS},
{agg}
SELECT stt, edt, trademark_id, trademark_name, category1_id, category1_name, category2_id, category2_name, category3_id,
       category3_name, sku_id, sku_name, sku_dim.spu_id AS spu_id, spu_name, order_count, {", ".join(_AMOUNTS)}
FROM agg LEFT JOIN sku_dim ON sku_id = sku_dim.id LEFT JOIN spu_dim ON sku_dim.spu_id = spu_dim.id {_CATEGORIES}"""


def sku_agg(rows: str, count: str) -> str:
    sums = ", ".join(f"cast(sum({a}) AS DOUBLE) AS {a}" for a in _AMOUNTS)
    return f"""
amounts AS (SELECT id, order_id, sku_id, create_time, {_LINE_AMOUNTS} FROM newest),
{rows},
agg AS (SELECT {win("epoch_ms(strptime(create_time, " + DT + "))", YEAR)}, sku_id, {count} AS order_count, {sums}
        FROM r GROUP BY 1, 2, 3)"""


# Straight from the order lines, without the derived identifiers and joins that the query goes through.
_PLAIN_SKU = f"""
agg AS (
  SELECT {win("epoch_ms(l_shipdate)", YEAR)}, l_partkey::VARCHAR AS sku_id, count(DISTINCT l_orderkey) AS order_count,
         cast(sum({money(f"{PRICE} * l_quantity::INT")}) AS DOUBLE) AS original_amount,
         cast(sum(CASE WHEN {DISC} > 0 THEN {money(f"{PRICE} * {DISC}")} ELSE 0 END) AS DOUBLE) AS activity_amount,
         cast(sum(CASE WHEN {TAX} > 0 THEN {money(f"{PRICE} * {TAX}")} ELSE 0 END) AS DOUBLE) AS coupon_amount,
         cast(sum({money(f"{PRICE} * (1 - {DISC})")}) AS DOUBLE) AS order_amount
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1, 2, 3)"""


def users_sql(source: str, time: str, day_name: str, new_name: str) -> str:
    return f"""
WITH {source},
d AS (SELECT user_id, {time} // 86400000 AS day, min({time}) AS t FROM rows_ GROUP BY 1, 2),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM d)
SELECT {win("t", DAY)}, count(*) AS {day_name}, sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END)::BIGINT AS {new_name}
FROM f GROUP BY 1, 2"""


_CART = {
    "id": LINE_ID, "user_id": "(l_orderkey % 500)::VARCHAR", "sku_id": "l_partkey::VARCHAR", "cart_price": f"{PRICE}::VARCHAR",
    "sku_num": "num", "sku_name": "'sku ' || l_partkey", "is_checked": "'1'", "create_time": dt("l_shipdate"),
    "operate_time": f"CASE WHEN later = 1 THEN {dt('l_shipdate + to_days(1)')} END", "is_ordered": "'0'",
    "source_type": "'240' || (l_linenumber % 4 + 1)", "source_id": "l_suppkey::VARCHAR",
}
CARTS = f"""{CODES},
cc AS (
  SELECT *, l_quantity::INT::VARCHAR AS num, 0 AS later FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL SELECT *, (l_quantity::INT - l_linenumber * 7)::VARCHAR, 1 FROM lineitem
  WHERE l_linestatus = 'F' AND l_partkey % 3 <> 0 AND l_quantity::INT > l_linenumber * 7),
carts AS (
  SELECT b.*, dic_name AS source_name
  FROM (SELECT {full("cart_info", _CART)}, epoch_ms(l_shipdate + to_days(later)) AS ts FROM cc) b
  JOIN code ON source_type = dic_code)"""

_USER_T = "make_timestamp((1704067200 + c_custkey * 97) * 1000000)"


def coupon_sql(where: str, status: str, days: int, **more: str) -> str:
    cols = full("coupon_use", {
        "id": "o_orderkey::VARCHAR", "coupon_id": "(o_custkey % 20)::VARCHAR", "user_id": "o_custkey::VARCHAR",
        "order_id": "o_orderkey::VARCHAR", "coupon_status": f"'{status}'", "create_time": dt("o_orderdate"),
        "get_time": dt("o_orderdate"), "expire_time": dt("o_orderdate + to_days(30)"), **more,
    })
    return f"SELECT {cols}, epoch_ms(o_orderdate + to_days({days})) AS ts FROM orders WHERE {where}"


def words(text: str, seconds: int, ms: str, source: str) -> str:
    return f"""
WITH w AS (SELECT {ms} AS ms, unnest(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')) AS word FROM {source})
SELECT {win("ms", seconds)}, 'search' AS source, lower(word) AS keyword, count(*) AS keyword_count FROM w GROUP BY ALL"""


_COUNTS = f"""
SELECT t AS "table", type, count(*) AS n, sum(ts)::BIGINT AS ts_sum, count(CASE WHEN old THEN 1 END) AS with_old FROM (
  SELECT 'order_info' AS t, type, change_ts AS ts, type = 'update' AS old FROM info
  UNION ALL SELECT 'order_detail', 'insert', epoch_ms(l_shipdate), false FROM lineitem
  UNION ALL SELECT 'order_detail_activity', 'insert', epoch_ms(l_shipdate), false FROM lineitem WHERE l_discount > 0.05::DOUBLE
  UNION ALL SELECT 'order_detail_coupon', 'insert', epoch_ms(l_shipdate), false FROM lineitem WHERE l_tax > 0.04::DOUBLE
  UNION ALL SELECT 'payment_info', 'insert', epoch_ms(o_orderdate), false FROM orders
  UNION ALL SELECT 'payment_info', 'update', epoch_ms(o_orderdate + to_days(1)), true FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 'order_refund_info', 'insert', epoch_ms(l_shipdate), false FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'order_refund_info', 'update', epoch_ms(l_shipdate + to_days(1)), true FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'refund_payment', 'insert', epoch_ms(l_shipdate), false FROM lineitem
            WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  UNION ALL SELECT 'refund_payment', 'update', epoch_ms(l_shipdate + to_days(2)), true FROM lineitem
            WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  UNION ALL SELECT 'cart_info', 'insert', epoch_ms(l_shipdate), false FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL SELECT 'cart_info', 'update', epoch_ms(l_shipdate + to_days(1)), true FROM lineitem WHERE l_linestatus = 'F'
  UNION ALL SELECT 'coupon_use', 'insert', epoch_ms(o_orderdate), false FROM orders
  UNION ALL SELECT 'coupon_use', 'update', epoch_ms(o_orderdate + to_days(1)), true FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 'coupon_use', 'update', epoch_ms(o_orderdate + to_days(2)), true FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'coupon_use', 'update', epoch_ms(o_orderdate + to_days(3)), true FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'favor_info', CASE event_type WHEN 'click' THEN 'insert' ELSE 'update' END, epoch_us(ts) // 1000,
            event_type = 'purchase' FROM events WHERE event_type IN ('click', 'purchase')
  UNION ALL SELECT 'comment_info', 'insert', (1704067200 + doc_id) * 1000, false FROM documents
  UNION ALL SELECT 'user_info', 'insert', (1704067200 + c_custkey * 97) * 1000, false FROM customer
  UNION ALL SELECT 'user_info', 'update', (1704153600 + c_custkey * 97) * 1000, true FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'user_info', 'delete', (1704240000 + c_custkey * 97) * 1000, false FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT 'sku_info', 'bootstrap-insert', (1704067200 + p_partkey) * 1000, false FROM part
  UNION ALL SELECT 'sku_info', 'update', (1704153600 + p_partkey) * 1000, true FROM part WHERE p_partkey % 4 = 0)
GROUP BY 1, 2"""

ORACLES = {
    "json_props": "SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events",
    "quarantined_logs": "SELECT event_id AS seq, CASE WHEN event_id % 25 = 0 THEN 'bad' ELSE 'good' END AS verdict FROM events",
    "log_split_counts": f"""
WITH {EV}, {GOOD}, {repaired("good")}
SELECT kind, is_new, count(*) AS n FROM (
  SELECT 'error' AS kind, is_new FROM fixed WHERE kind = 'error' OR (kind = 'signup' AND k % 10 = 0)
  UNION ALL SELECT 'start', is_new FROM fixed WHERE kind = 'signup'
  UNION ALL SELECT 'page', is_new FROM fixed WHERE kind <> 'signup'
  UNION ALL SELECT 'display', is_new FROM fixed, range({SHOWN}) i
  UNION ALL SELECT 'action', is_new FROM fixed WHERE kind = 'purchase')
GROUP BY 1, 2""",
    "log_pages": f"""
WITH {EV}, {GOOD}, {repaired("good")}
SELECT seq, mid, is_new, page_id, last_page_id, ts FROM fixed WHERE kind <> 'signup'""",
    "log_errors": f"""
WITH {EV}, {GOOD}
SELECT seq, mid, k AS error_code, 'error ' || k AS msg, (kind = 'signup')::INT AS on_start, ts FROM good
WHERE kind = 'error' OR (kind = 'signup' AND k % 10 = 0)""",
    "log_starts": f"""
WITH {EV}, {GOOD}, {repaired("good")}
SELECT seq, mid, is_new, k * 10 AS loading_time, k AS open_ad_id, ts FROM fixed WHERE kind = 'signup'""",
    "log_displays": f"""
WITH {EV}, {GOOD}
SELECT seq, 'query' AS display_type, (k + i)::VARCHAR AS item, 'sku_id' AS item_type, i AS display_order, k % 5 AS pos_id,
       page_id, mid, ts
FROM (SELECT *, unnest(range({SHOWN})) AS i FROM good)""",
    "log_actions": f"""
WITH {EV}, {GOOD}
SELECT seq, 'cart_add' AS action_id, k::VARCHAR AS item, 'sku_id' AS item_type, page_id, mid,
       CASE WHEN k % 3 <> 0 THEN ts + k ELSE ts END AS ts
FROM good WHERE kind = 'purchase'""",
    "changes_by_table": f"WITH {INFO} {_COUNTS}",
    "unique_visits": f"WITH {EV}, {VISITS} SELECT mid, ch, ts, seq FROM uv",
    "bounce_visits": f"WITH {EV}, {BOUNCES} SELECT mid, ch, ts, seq FROM uj",
    "is_new_repair": f"WITH {EV}, {repaired('ev')} SELECT mid, ts, seq, is_new FROM fixed",
    "traffic_by_segment": f"""
WITH {EV}, {VISITS}, {BOUNCES},
m AS (
  SELECT vc, ch, ar, is_new, ts, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, 1 AS pv, during_time AS dur,
         0 AS uj FROM ev
  UNION ALL SELECT vc, ch, ar, is_new, ts, 1, 0, 0, 0, 0 FROM uv
  UNION ALL SELECT vc, ch, ar, is_new, ts, 0, 0, 0, 0, 1 FROM uj)
SELECT {win("ts", HOUR)}, vc, ch, ar, is_new, sum(uv)::BIGINT AS uv_ct, sum(sv)::BIGINT AS sv_ct, sum(pv)::BIGINT AS pv_ct,
       sum(dur)::BIGINT AS dur_sum, sum(uj)::BIGINT AS uj_ct
FROM m GROUP BY 1, 2, 3, 4, 5, 6""",
    "page_uniques": f"""
WITH {EV},
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, ts // 86400000 ORDER BY ts, seq) AS rn
                     FROM ev WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1)
SELECT {win("ts", HOUR)}, sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END)::BIGINT AS home_uv_ct,
       sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END)::BIGINT AS good_detail_uv_ct
FROM v GROUP BY 1, 2""",
    "keyword_counts": words("text", MINUTE, "1704067200000 + doc_id * 1000", "documents"),
    "keyword_counts_parts": words("p_name", MONTH, "epoch_ms(l_shipdate)", "lineitem JOIN part ON l_partkey = p_partkey"),
    "users_registered": f"""
SELECT {full("user_info", {
    "id": "c_custkey::VARCHAR", "login_name": "lower(c_name)", "nick_name": "c_mktsegment", "name": "c_name",
    "user_level": "(c_nationkey % 3)::VARCHAR", "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "create_time": dt(_USER_T)})}, epoch_ms({_USER_T}) AS ts FROM customer""",
    "favourites_added": f"""
SELECT {full("favor_info", {
    "id": "event_id::VARCHAR", "user_id": "user_id::VARCHAR", "sku_id": "(event_id % 200)::VARCHAR",
    "spu_id": "(event_id % 20)::VARCHAR", "is_cancel": "'0'", "create_time": dt("ts")})}, epoch_us(events.ts) // 1000 AS ts
FROM events WHERE event_type = 'click'""",
    "comments_added": f"""
WITH {CODES}, c AS (
  SELECT {full("comment_info", {
      "id": "doc_id::VARCHAR", "user_id": "(doc_id % 150)::VARCHAR", "nick_name": "source", "sku_id": "(doc_id % 200)::VARCHAR",
      "spu_id": "(doc_id % 20)::VARCHAR", "order_id": "(doc_id % 999)::VARCHAR", "appraise": "'120' || (doc_id % 5 + 1)",
      "comment_txt": "text", "create_time": dt("make_timestamp((1704067200 + doc_id) * 1000000)")})},
      (1704067200 + doc_id) * 1000 AS ts FROM documents)
SELECT c.*, dic_name AS appraise_name FROM c JOIN code ON appraise = dic_code""",
    "registrations": f"SELECT {win(f'epoch_ms({_USER_T})', HOUR)}, count(*) AS register_ct FROM customer GROUP BY 1, 2",
    "returning_users": f"""
WITH {EV}, {LOGINS}
SELECT uid, strftime(make_timestamp(day * 86400000000), '%Y-%m-%d') AS day, ts, 1::BIGINT AS uu_ct, back_ct FROM lg""",
    "login_activity": f"""
WITH {EV}, {LOGINS}
SELECT {win("ts", HOUR)}, sum(back_ct)::BIGINT AS back_ct, count(*) AS uu_ct FROM lg GROUP BY 1, 2""",
    "cart_adds": f"WITH {CARTS} SELECT * FROM carts",
    "cart_adds_as_of": f"""
WITH {CARTS} SELECT * REPLACE (CASE WHEN ts >= {RENAMED} AND source_type IN ('2401', '2403') THEN source_name || ' (new)' ELSE source_name END
                               AS source_name) FROM carts""",
    "cart_uniques": f"""
WITH {CARTS}, d AS (SELECT user_id, ts // 86400000 AS day, min(ts) AS t FROM carts GROUP BY 1, 2)
SELECT {win("t", MONTH)}, count(*) AS cart_add_uu_ct FROM d GROUP BY 1, 2""",
    "order_wide": f"WITH {WIDE} SELECT * EXCLUDE (moved) FROM wide",
    "orders_placed": f"WITH {WIDE} SELECT * FROM placed",
    "orders_cancelled": f"""
WITH {WIDE} SELECT * EXCLUDE (type, moved) FROM wide WHERE type = 'update' AND order_status = '1003' AND moved""",
    "payments_succeeded": f"WITH {WIDE}, {PAID} SELECT * FROM paid",
    "order_users": users_sql(
        f"{WIDE}, rows_ AS (SELECT user_id, epoch_ms(strptime(create_time, {DT})) AS t0 FROM placed)", "t0",
        "order_unique_user_count", "order_new_user_count"),
    "payment_users": users_sql(
        f"{WIDE}, {PAID}, rows_ AS (SELECT user_id, epoch_ms(strptime(callback_time, {DT})) AS t0 FROM paid)", "t0",
        "payment_suc_unique_user_count", "payment_suc_new_user_count"),
    "newest_order_lines": f"""
WITH {WIDE}, {NEWEST}
SELECT id, order_id, sku_id, order_price, sku_num, create_time, activity_id, coupon_id, change_ts FROM newest""",
    "sku_orders": sku_result(_PLAIN_SKU),
    "sku_orders_dedup": sku_result(sku_agg("""
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, sku_id ORDER BY create_time, id) AS rn FROM amounts)
      WHERE rn = 1)""", "count(*)")),
    "province_orders": f"""
WITH a AS (
  SELECT {win("epoch_ms(o_orderdate)", MONTH)}, (o_custkey % 28)::VARCHAR AS province_id, count(*) AS order_count,
         cast(sum({money('o_totalprice')}) AS DOUBLE) AS order_amount
  FROM orders GROUP BY 1, 2, 3)
SELECT stt, edt, province_id, n_name AS province_name, order_count, order_amount
FROM a LEFT JOIN nation ON province_id = n_nationkey::VARCHAR""",
    "coupons_received": coupon_sql("true", "1401", 0),
    "coupons_ordered": coupon_sql("o_orderstatus <> 'P'", "1402", 1, using_time=dt("o_orderdate + to_days(1)")),
    "coupons_paid": coupon_sql("o_orderstatus = 'F'", "1403", 2, used_time=dt("o_orderdate + to_days(2)")),
    "refund_requests_wide": f"WITH {WIDE}, {REFUND_WIDE} SELECT * FROM rw",
    "refund_requests": f"""
WITH {CODES}, {REQUESTS}, {INFO}
SELECT req.id, req.user_id, req.order_id, req.sku_id, info.province_id, req.create_time, refund_type AS refund_type_code,
       c1.dic_name AS refund_type_name, refund_reason_type AS refund_reason_type_code,
       c2.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num, refund_amount, req.ts AS ts
FROM req JOIN info ON req.order_id = info.id AND info.order_status = '1005' AND info.moved
JOIN code c1 ON refund_type = c1.dic_code JOIN code c2 ON refund_reason_type = c2.dic_code
WHERE req.type = 'insert'""",
    "refunds_paid_wide": f"""
WITH {WIDE}, {REFUND_WIDE}, {REFUND_PAID}
SELECT rw.* EXCLUDE (type), rp.* EXCLUDE (id, order_id, sku_id), dic_name AS payment_type_name
FROM rw JOIN rp ON rw.order_id = rp.order_id AND rw.sku_id = rp.sku_id JOIN code ON payment_type = dic_code""",
    "refunds_paid": f"""
WITH {CODES}, {REQUESTS}, {REFUND_PAID}, {INFO}
SELECT rp.id, info.user_id, rp.order_id, rp.sku_id, info.province_id, payment_type AS payment_type_code,
       dic_name AS payment_type_name, rp.callback_time, req.refund_num, rp.refund_total_amount AS refund_amount, rp.paid_ts AS ts
FROM rp JOIN info ON rp.order_id = info.id AND info.order_status = '1006' AND info.moved
JOIN req ON rp.order_id = req.order_id AND rp.sku_id = req.sku_id AND req.type = 'update'
JOIN code ON payment_type = dic_code""",
    "refunds_by_brand_category_user": f"""
WITH {DIMS},
a AS (
  SELECT {win("epoch_ms(r.l_shipdate)", MONTH)}, category3_id, trademark_id, o_custkey::VARCHAR AS user_id,
         cast(sum({money("r.l_extendedprice")}) AS DOUBLE) AS refund_amount, count(*) AS refund_count
  FROM lineitem r JOIN lineitem l ON r.l_orderkey = l.l_orderkey AND r.l_partkey = l.l_partkey
  JOIN orders ON r.l_orderkey = o_orderkey LEFT JOIN sku_dim ON r.l_partkey::VARCHAR = sku_dim.id
  WHERE r.l_returnflag = 'R' GROUP BY 1, 2, 3, 4, 5)
SELECT stt, edt, trademark_id, trademark_name, category1_id, category1_name, category2_id, category2_name, category3_id,
       category3_name, user_id, refund_amount, refund_count
FROM a {_CATEGORIES}""",
    "interval_pairs": """
SELECT c.user_id, c.event_id AS click_id, p.event_id AS buy_id FROM events c JOIN events p ON c.user_id = p.user_id
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
AND p.ts BETWEEN c.ts - INTERVAL 2 HOUR AND c.ts + INTERVAL 1 HOUR""",
    "customer_geography": """
SELECT c_custkey, c_nationkey, n_name AS nation_name, n_regionkey AS region_key, r_name AS region_name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) n ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""",
    "sku_enriched": f"""
WITH {DIMS}
SELECT sku_dim.id AS sku_id, sku_name, sku_dim.spu_id AS spu_id, category3_id, trademark_id, spu_name, category3_name,
       category2_id, category2_name, category1_id, category1_name, trademark_name
FROM sku_dim LEFT JOIN spu_dim ON sku_dim.spu_id = spu_dim.id {_CATEGORIES}""",
    "first_orders": """
SELECT o_custkey, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "latest_order_status": f"""
WITH {INFO} SELECT id, arg_max(order_status, change_ts) AS order_status, max(change_ts) AS ts FROM info GROUP BY id""",
    "dim_sync": """
SELECT 'dim_user_info' AS sink_table, c_custkey::VARCHAR AS pk, 8::BIGINT AS n_columns,
       CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_mktsegment ELSE c_mktsegment END AS name,
       (1704067200 + c_custkey * 97 + CASE WHEN c_custkey % 2 = 0 THEN 86400 ELSE 0 END) * 1000 AS ts FROM customer
UNION ALL
SELECT 'dim_sku_info', p_partkey::VARCHAR, 5, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' v2' ELSE p_name END,
       (1704067200 + p_partkey + CASE WHEN p_partkey % 4 = 0 THEN 86400 ELSE 0 END) * 1000 FROM part""",
}

# ---- streams -----------------------------------------------------------------------------------

_LINE_MARK = f"(SELECT max(epoch_ms(l_shipdate)) - 2000 FROM lineitem)"

STREAM_ORACLES = {
    "live_unique_visits": f"""
WITH {EV} SELECT DISTINCT mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day FROM ev WHERE last_page_id IS NULL""",
    "live_bounce_visits": ORACLES["bounce_visits"],
    "live_daily_visits": ORACLES["unique_visits"],
    "live_traffic_by_segment": ORACLES["traffic_by_segment"],
    "live_page_uniques": f"""
WITH {EV}, v AS (SELECT DISTINCT mid, page_id, ts // 86400000 AS day FROM ev WHERE page_id IN ('home', 'good_detail'))
SELECT {win("day * 86400000", DAY)}, sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END)::BIGINT AS home_uv_ct,
       sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END)::BIGINT AS good_detail_uv_ct
FROM v GROUP BY 1, 2""",
    "live_keyword_counts": ORACLES["keyword_counts"],
    "live_log_split_counts": ORACLES["log_split_counts"],
    "live_returning_users": ORACLES["returning_users"],
    "live_log_pages": ORACLES["log_pages"],
    "live_order_users": ORACLES["order_users"],
    "live_payment_users": ORACLES["payment_users"],
    "live_sku_orders": ORACLES["sku_orders"],
    "live_sku_orders_dedup": ORACLES["sku_orders_dedup"],
    "live_refund_requests_wide": ORACLES["refund_requests_wide"],
    "live_refunds_paid_wide": ORACLES["refunds_paid_wide"],
    "live_refunds_by_brand_category_user": ORACLES["refunds_by_brand_category_user"],
    "live_province_orders": ORACLES["province_orders"],
    "live_registrations": ORACLES["registrations"],
    "live_cart_adds": ORACLES["cart_adds"],
    "live_cart_adds_as_of": ORACLES["cart_adds_as_of"],
    "live_sku_order_lines": f"""
WITH {LINES}, {DIMS}, a AS (SELECT sku_id, order_id, ts, {_LINE_AMOUNTS} FROM line)
SELECT {win("ts", YEAR)}, sku_id, trademark_name, count(DISTINCT order_id) AS order_count,
       cast(sum(original_amount) AS DOUBLE) AS original_amount, cast(sum(order_amount) AS DOUBLE) AS order_amount
FROM a LEFT JOIN sku_dim ON sku_id = sku_dim.id LEFT JOIN tm_dim ON trademark_id = tm_dim.id
WHERE (ts // {YEAR * 1000} + 1) * {YEAR * 1000} <= {_LINE_MARK} GROUP BY 1, 2, 3, 4""",
    "live_refunds_paid": ORACLES["refunds_paid"],
    "live_order_wide": ORACLES["order_wide"],
    "live_orders_placed": ORACLES["orders_placed"],
    "live_orders_cancelled": ORACLES["orders_cancelled"],
    "live_payments_succeeded": ORACLES["payments_succeeded"],
    "live_refund_requests": ORACLES["refund_requests"],
    "live_cart_uniques": ORACLES["cart_uniques"],
    "live_login_activity": ORACLES["login_activity"],
    "live_interval_pairs": ORACLES["interval_pairs"],
    "live_dim_sync": """
SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_mktsegment ELSE c_mktsegment END AS name,
       (c_nationkey % 3)::VARCHAR AS attribute FROM customer
UNION ALL SELECT p_partkey::VARCHAR, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' v2' ELSE p_name END,
       (p_partkey % 50)::VARCHAR FROM part""",
}
