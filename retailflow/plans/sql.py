"""The logical tables of adapters.py as SQL common table expressions."""

NS = "(SELECT count(*) FROM supplier)"

FLOW = f"""flow AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, event_type,
    CASE WHEN event_id % 5 = 0 THEN '-' WHEN event_id % 7 = 0 THEN '0' ELSE CAST(user_id AS VARCHAR) END AS uid,
    'm' || user_id AS mid, user_id || '_' || (event_id % 7) || '_' || (event_id % 13) AS sid,
    CASE WHEN event_id % 11 = 0 THEN '' ELSE user_id || '_' || (event_id % 7) || '_' || (event_id % 13) END AS session,
    CASE WHEN event_id % 3 = 0 THEN 'click' ELSE 'browse' END AS dest_type, CAST(user_id AS VARCHAR) AS visitor,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % {NS} AS shop_id,
    (event_id * 2654435761) % 4294967296 AS ip_num, '/item?id=' || CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS url
  FROM events WHERE event_type IN ('view', 'click'))"""

ORDERS = f"""biz AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % {NS} AS seller_id, user_id AS buyer_id, 1 + event_id % 3 AS buy_amount,
    CAST(round(value * 100) AS BIGINT) AS fee, CAST(event_type = 'purchase' AS INTEGER) AS is_pay, CAST(event_type = 'signup' AS INTEGER) AS is_new,
    1 AS is_detail, CAST(event_id % 2 AS INTEGER) AS is_main
  FROM events WHERE event_type IN ('purchase', 'signup'))"""

UNIFIED = f"""{FLOW}, {ORDERS}, rows_ AS (
  SELECT ts, shop_id AS seller_id, item_id, visitor, 1 AS view, 0 AS is_new, 0 AS is_pay, 0 AS qty, 0 AS fee FROM flow
  UNION ALL SELECT ts, seller_id, item_id, CAST(buyer_id AS VARCHAR), 0, is_new, is_pay, buy_amount, fee FROM biz)"""

KPI = """CAST(sum(view) AS BIGINT) AS pv, CAST(sum(is_new) AS BIGINT) AS tn, CAST(sum(is_pay) AS BIGINT) AS atn,
    CAST(sum(CASE WHEN is_pay = 1 THEN qty ELSE 0 END) AS BIGINT) AS an, CAST(sum(CASE WHEN is_pay = 1 THEN fee ELSE 0 END) AS BIGINT) AS amt,
    count(DISTINCT CASE WHEN view = 1 THEN visitor END) AS iuv, count(DISTINCT CASE WHEN is_pay = 1 THEN visitor END) AS auv"""

RATIOS = """CASE WHEN iuv <> 0 THEN auv * 10000 // iuv ELSE 0 END AS ar, CASE WHEN tn <> 0 THEN atn * 10000 // tn ELSE 0 END AS az,
    CASE WHEN iuv <> 0 THEN amt * 100 // iuv ELSE 0 END AS au"""

HALF_UP = """CASE WHEN iuv <> 0 THEN (2 * auv * 10000 + iuv) // (2 * iuv) ELSE 0 END AS ar, CASE WHEN tn <> 0 THEN (2 * atn * 10000 + tn) // (2 * tn) ELSE 0 END AS az,
    CASE WHEN iuv <> 0 THEN (2 * amt * 100 + iuv) // (2 * iuv) ELSE 0 END AS au"""

CHILDREN = """children AS (
  SELECT l_orderkey AS parent_id, l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS order_id, l_linenumber AS line_no,
    l_partkey AS item_id, l_suppkey AS seller_id, o_custkey AS buyer_id, CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT) AS price,
    CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) AS discount, CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) AS adjust,
    CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS pay_status, epoch_us(l_shipdate) // 1000 AS order_modified_t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PAYMENTS = """payments AS (
  SELECT o_orderkey AS order_id, CAST(round(o_totalprice * 100) AS BIGINT) AS actual_total_fee FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 <> 0)"""

CHANGES = f"""changes AS (
  SELECT o_orderkey AS order_id, CAST(o_custkey % {NS} AS VARCHAR) AS seller_id, o_custkey AS buyer_id,
    CASE o_orderkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update:16,13' WHEN 2 THEN 'update: 6 ,17' ELSE 'update:113,32,10' END AS db_action,
    CASE o_orderkey % 3 WHEN 0 THEN 'order_0000' WHEN 1 THEN 'tc_biz_order' ELSE 'tc_pay_order' END AS log_src,
    CASE o_orderstatus WHEN 'F' THEN 'TRADE_FINISHED' WHEN 'O' THEN 'TRADE_SUCCESS' ELSE 'WAIT_SELLER_SEND_GOODS' END AS trade_status,
    CASE WHEN o_orderkey % 5 < 3 THEN 2 ELSE 1 END AS pay_status,
    CASE WHEN o_orderkey % 17 = 0 THEN 800 WHEN o_orderkey % 13 = 0 THEN 10000 ELSE 200 END AS biz_type,
    CASE WHEN o_orderkey % 2 = 0 THEN 'a:1;stepss:2;b:3' ELSE 'stepss:1' END AS attributes,
    CASE WHEN o_orderkey % 6 = 0 THEN '\\N' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS pay_time,
    CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS gmt_modified,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS gmt_create, CAST(round(o_totalprice * 100) AS BIGINT) AS actual_total_fee
  FROM orders), flagged AS (
  SELECT *, CASE WHEN db_action LIKE 'insert%' AND trade_status NOT IN ('TRADE_FINISHED', 'TRADE_CLOSED', 'TRADE_REFUSE', 'TRADE_REFUSE_DEALING', 'TRADE_CANCEL') THEN 1 ELSE 0 END AS is_new_generated,
    CASE WHEN db_action LIKE 'insert%' AND log_src = 'order_0000' AND trade_status IN ('TRADE_SUCCESS', 'WAIT_SELLER_SEND_GOODS') THEN 1
      WHEN db_action LIKE 'update:%' AND list_contains(list_transform(string_split(substr(db_action, 8), ','), lambda x: trim(x)),
        CASE WHEN log_src = 'order_0000' THEN '10' WHEN log_src = 'tc_biz_order' AND pay_status = 2 THEN '13' WHEN log_src = 'tc_pay_order' AND pay_status = 2 THEN '6' END) THEN 1 ELSE 0 END AS is_pay
  FROM changes)"""

SHOPS = """shops AS (
  SELECT s_suppkey AS shop_id, s_name AS nick, CAST(s_suppkey % 2 AS INTEGER) AS shop_type, s_suppkey + 1000 AS user_id, s_suppkey % 10 AS unit_id,
    CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS is_active, 1704067200 + s_suppkey * 3600 AS init_time, s_suppkey % 40 AS days FROM supplier)"""

SHOP_SELLERS = "shop_sellers AS (SELECT s_suppkey AS shop_id, s_suppkey + 5000 AS seller_id FROM supplier WHERE s_suppkey % 5 <> 4)"

IP = """ip AS (
  SELECT (n_nationkey * 10 + k) * CAST(17179869 AS BIGINT) AS start_ip, (n_nationkey * 10 + k) * CAST(17179869 AS BIGINT) + 9999999 AS end_ip,
    CAST(n_nationkey AS BIGINT) AS country, CAST(n_regionkey AS BIGINT) AS province, CAST(k AS BIGINT) AS city, CAST(n_nationkey * 65536 + n_regionkey * 256 + k AS BIGINT) AS location_id
  FROM nation, range(10) t(k))"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
