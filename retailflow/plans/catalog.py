"""Registered queries of the retail operators, each beside its SQL."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mapping, scalars
from ..operators import classify, enrich, kpi, orders, sinks, stats, visitors
from ..sources import dimensions, logs
from ..sources.stored import OrderTables, StoredLog, VersionedTable
from ..streaming import flush as flushes
from ..streaming import queries as streams
from ..streaming import state as states
from . import adapters as a
from . import rule_tables as t
from . import sql as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

NOW_S = 1_706_745_600  # the moment that queries take for now: 2024-02-01
DAY = "2024-01-15"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def stamp(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


KPI_COLUMNS = ("pv", "tn", "atn", "an", "amt", "iuv", "auv", "ar", "az", "au")


def _kpi(spark: SparkSession, sf_dir: str, unit: str, rounding: str) -> DataFrame:
    found = kpi.kpi_ratios(kpi.item_kpi(a.unified(spark, sf_dir), unit), rounding)
    return found.select(stamp("bucket"), "seller_id", "item_id", *KPI_COLUMNS)


def _kpi_sql(unit: str, ratios: str) -> str:
    return f"""{s.with_(s.UNIFIED)}, k AS (SELECT {s.stamp(f"date_trunc('{unit}', ts)")} AS bucket, seller_id, item_id, {s.KPI} FROM rows_ GROUP BY ALL)
    SELECT *, {ratios} FROM k"""


for _name, _unit, _rounding in (("kpi_daily", "day", "trunc"), ("kpi_hourly", "hour", "trunc"), ("kpi_ratios_half_up", "day", "half_up"), ("kpi_ratios", "hour", "half_up")):
    query(_name, _kpi_sql(_unit, s.RATIOS if _rounding == "trunc" else s.HALF_UP))(lambda spark, d, u=_unit, r=_rounding: _kpi(spark, d, u, r))

_ITEM = {"item_pv": ("pv",), "item_iuv": ("iuv",), "item_paid": ("atn", "an", "amt", "auv"), "item_new_orders": ("tn",)}
for _name, _columns in _ITEM.items():

    @query(_name, f"{s.with_(s.UNIFIED)} SELECT item_id, {', '.join(_columns)} FROM (SELECT item_id, {s.KPI} FROM rows_ GROUP BY item_id)")
    def _item(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = _columns) -> DataFrame:
        return a.unified(spark, sf_dir).groupBy("item_id").agg(*kpi.measures()).select("item_id", *columns)


@query("union_streams", f"{s.with_(s.UNIFIED)} SELECT view, count(*) AS n, CAST(sum(fee) AS BIGINT) AS fee FROM rows_ GROUP BY view")
def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.unified(spark, sf_dir).groupBy("view").agg(F.count(F.lit(1)).alias("n"), F.sum("fee").alias("fee"))


@query("hours_to_day", f"""{s.with_(s.UNIFIED)} SELECT {s.stamp("date_trunc('day', ts)")} AS bucket, seller_id, item_id, {s.KPI.rsplit("count(DISTINCT", 2)[0].rstrip(', \n')} FROM rows_ GROUP BY ALL""")
def hours_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.hours_to_day(kpi.item_kpi(a.unified(spark, sf_dir), "hour")).withColumn("bucket", stamp("bucket"))


RECONCILED = f"""{s.with_(s.UNIFIED)} SELECT {s.stamp("date_trunc('day', ts)")} AS bucket, seller_id, item_id, CAST(sum(view) AS BIGINT) AS pv, true AS agrees FROM rows_ GROUP BY ALL"""


@query("reconcile_hours_vs_day", RECONCILED)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.unified(spark, sf_dir)
    found = kpi.reconcile_hours_vs_day(kpi.item_kpi(rows, "hour"), kpi.item_kpi(rows, "day"))
    return found.select(stamp("bucket"), "seller_id", "item_id", "pv", "agrees")


@query(
    "maint_reader_check",
    f"""{s.with_(s.UNIFIED)}, h AS (SELECT date_trunc('hour', ts) AS h, seller_id, item_id, CAST(sum(view) AS BIGINT) AS pv, CAST(sum(is_pay) AS BIGINT) AS atn FROM rows_ GROUP BY ALL)
    SELECT {s.stamp('h')} AS hour, seller_id, item_id, pv, atn, CAST(sum(pv) OVER w AS BIGINT) AS day_pv, CAST(sum(atn) OVER w AS BIGINT) AS day_atn, true AS agrees FROM h WINDOW w AS (PARTITION BY date_trunc('day', h), seller_id, item_id)""",
)
def maint_reader_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour rows of each item beside its day row, which is computed on its own, and whether all indicators of the hours add up to it."""
    rows = a.unified(spark, sf_dir)
    hours, days = kpi.item_kpi(rows, "hour"), kpi.item_kpi(rows, "day")
    checked = kpi.reconcile_hours_vs_day(hours, days).select(F.col("bucket").alias("day"), "seller_id", "item_id", F.col("pv").alias("day_pv"), F.col("atn").alias("day_atn"), "agrees")
    shown = hours.withColumn("day", F.date_trunc("day", "bucket")).join(checked, ["day", "seller_id", "item_id"], "full")
    return shown.select(stamp("bucket").alias("hour"), "seller_id", "item_id", "pv", "atn", "day_pv", "day_atn", "agrees")


_MERGED = f"""{s.with_(s.UNIFIED)}, k AS (SELECT {s.stamp("date_trunc('day', ts)")} AS bucket, seller_id, item_id, {s.KPI} FROM rows_ GROUP BY ALL)
    SELECT bucket, seller_id, item_id, pv, tn, atn, an, amt, true AS iuv_close, true AS auv_close FROM k"""


@query("kpi_merge", _MERGED)
def kpi_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the first half of each hour merged with those of the second; visitors just those of a sketch of both halves
    in one go, and within 3 % of the exact number."""
    rows = a.unified(spark, sf_dir)
    early, late = rows.filter("minute(ts) < 30"), rows.filter("minute(ts) >= 30")
    merged = kpi.kpi_merge(kpi.item_kpi(early, "day", sketch=True), kpi.item_kpi(late, "day", sketch=True))
    keys = ["bucket", "seller_id", "item_id"]
    exact = kpi.item_kpi(rows, "day").select(*keys, F.col("iuv").alias("x"), F.col("auv").alias("y"))
    # one union of all sketches that a merge could take in, in another order
    once = kpi.union_of_hours(kpi.item_kpi(rows, "hour", sketch=True)).select(*keys, F.col("iuv").alias("x1"), F.col("auv").alias("y1"))
    close = lambda c, e, o: (F.abs(F.col(c) - F.col(e)) <= F.greatest(F.lit(1.0), 0.03 * F.col(e))) & (F.col(c) == F.col(o))
    joined = merged.join(exact, keys).join(once, keys)
    return joined.select(stamp("bucket"), "seller_id", "item_id", *kpi.ADDITIVE, close("iuv", "x", "x1").alias("iuv_close"), close("auv", "y", "y1").alias("auv_close"))


_STATE = f"""{s.with_(s.UNIFIED)}, k AS (SELECT {s.stamp("date_trunc('day', ts)")} AS bucket, seller_id, item_id, {s.KPI} FROM rows_ GROUP BY ALL)
    SELECT bucket, seller_id, item_id, pv, tn, atn, an, amt, true AS iuv_same, true AS auv_same FROM k"""


def _beside_one_go(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Merged totals, and whether their visitors are just those of all hours' sketches united in one go."""
    once = kpi.union_of_hours(kpi.item_kpi(rows, "hour", sketch=True)).select("bucket", "seller_id", "item_id", F.col("iuv").alias("x"), F.col("auv").alias("y"))
    joined = found.join(once, ["bucket", "seller_id", "item_id"], "full")
    return joined.select(stamp("bucket"), "seller_id", "item_id", *kpi.ADDITIVE, (F.col("iuv") == F.col("x")).alias("iuv_same"), (F.col("auv") == F.col("y")).alias("auv_same"))


@query("join_kpi_state", _STATE)
def join_kpi_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the first half of each hour as the state, joined with those of the second half."""
    rows = a.unified(spark, sf_dir)
    state, delta = (kpi.item_kpi(rows.filter(part), "day", sketch=True) for part in ("minute(ts) < 30", "minute(ts) >= 30"))
    return _beside_one_go(kpi.kpi_join_state(state, delta), rows)


@query("sink_kpi_merge", _STATE)
def sink_kpi_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deltas of each day that are merged key by key into a stored table, each written twice, and what is stored then."""
    rows, path = a.unified(spark, sf_dir), _scratch(spark, "sink_kpi_merge")
    columns = ["bucket", "seller_id", "item_id", *kpi.ADDITIVE, "iuv_sketch", "auv_sketch", "dt"]

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return kpi.kpi_merge(old, new).withColumn("dt", F.to_date("bucket").cast("string")).select(*columns)

    sink = sinks.upsert_write(path, ["bucket", "seller_id", "item_id"], "dt", combine)
    for k in range(3):
        delta = kpi.item_kpi(rows.filter(f"hour(ts) % 3 = {k}"), "day", sketch=True).withColumn("dt", F.to_date("bucket").cast("string")).select(*columns)
        sink(delta, k)
        sink(delta, k)
    return _beside_one_go(kpi.with_estimates(VersionedTable(spark, path).live()), rows)


def _running_sql(unit: str) -> str:
    return f"""{s.with_(s.UNIFIED)}, m AS (
      SELECT date_trunc('{unit}', ts) AS b, date_trunc('minute', ts) AS mi, seller_id, item_id, visitor, sum(view) AS pv, sum(is_new) AS tn, sum(is_pay) AS atn,
        sum(CASE WHEN is_pay = 1 THEN qty ELSE 0 END) AS an, sum(CASE WHEN is_pay = 1 THEN fee ELSE 0 END) AS amt, max(view) AS seen, max(is_pay) AS bought FROM rows_ GROUP BY ALL),
    f AS (SELECT *, CASE WHEN seen = 1 AND coalesce(max(seen) OVER w, 0) = 0 THEN 1 ELSE 0 END AS fs, CASE WHEN bought = 1 AND coalesce(max(bought) OVER w, 0) = 0 THEN 1 ELSE 0 END AS fb
      FROM m WINDOW w AS (PARTITION BY b, seller_id, item_id, visitor ORDER BY mi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT b, mi, seller_id, item_id, sum(pv) AS pv, sum(tn) AS tn, sum(atn) AS atn, sum(an) AS an, sum(amt) AS amt, sum(fs) AS iuv, sum(fb) AS auv FROM f GROUP BY ALL),
    r AS (SELECT {s.stamp('b')} AS bucket, {s.stamp('mi')} AS minute, seller_id, item_id, {', '.join(f'CAST(sum({c}) OVER w AS BIGINT) AS {c}' for c in ('pv', 'tn', 'atn', 'an', 'amt', 'iuv', 'auv'))}
      FROM g WINDOW w AS (PARTITION BY b, seller_id, item_id ORDER BY mi ROWS UNBOUNDED PRECEDING))
    SELECT *, {s.RATIOS} FROM r"""


for _name, _unit in (("kpi_running_hour", "hour"), ("kpi_running_day", "day")):

    @query(_name, _running_sql(_unit))
    def _running(spark: SparkSession, sf_dir: str, unit: str = _unit) -> DataFrame:
        found = kpi.kpi_running(a.unified(spark, sf_dir), unit)
        return found.select(stamp("bucket"), stamp("minute"), "seller_id", "item_id", *KPI_COLUMNS)


_SHOP_DAY = f"""{s.with_(s.ORDERS)} SELECT {s.stamp("date_trunc('day', ts)")} AS day, seller_id, CAST(sum(CASE WHEN is_main = 1 AND is_pay = 1 THEN fee ELSE 0 END) AS BIGINT) AS amount,
    {s.stamp("max(CASE WHEN is_main = 1 AND is_pay = 1 THEN ts END)")} AS last_ts FROM biz GROUP BY ALL"""


@query("shop_day_amount", _SHOP_DAY)
def shop_day_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.shop_day_amount(a.order_flow(spark, sf_dir)).select(stamp("day"), "seller_id", "amount", stamp("last_ts"))


BASE = 5_000


@query(
    "sink_shop_upsert",
    f"""{s.with_(s.ORDERS)}, b AS (SELECT date_trunc('day', ts) AS d, seller_id, hour(ts) // 6 AS k, sum(CASE WHEN is_main = 1 AND is_pay = 1 THEN fee ELSE 0 END) AS amount, max(CASE WHEN is_main = 1 AND is_pay = 1 THEN ts END) AS last_ts FROM biz GROUP BY ALL),
    t AS (SELECT *, sum(amount) OVER (PARTITION BY d, seller_id ORDER BY k) // {BASE} AS px FROM b),
    p AS (SELECT *, coalesce(lag(px) OVER (PARTITION BY d, seller_id ORDER BY k), 0) AS earlier FROM t)
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS dt, seller_id, CAST(sum(amount) AS BIGINT) AS amount, {s.stamp('max(last_ts)')} AS last_ts, CAST(max(px) AS BIGINT) AS px, count(*) FILTER (px > earlier) AS n_passed FROM p GROUP BY ALL""",
)
def sink_shop_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of each quarter of the days, added to the sellers' stored totals, each batch twice; and how often each total passed a milestone."""
    path = _scratch(spark, "sink_shop_upsert")
    sink = sinks.shop_upsert_write(path, BASE)
    for k in range(4):
        amounts = kpi.shop_day_amount(a.order_flow(spark, sf_dir).filter(f"hour(ts) div 6 = {k}"))
        batch = amounts.select(F.to_date("day").cast("string").alias("dt"), "seller_id", "amount", "last_ts")
        sink(batch, k)
        sink(batch, k)
    passed = spark.read.parquet(f"{path}/history").groupBy("dt", "seller_id").agg(F.count(F.lit(1)).alias("n_passed"))
    totals = VersionedTable(spark, f"{path}/totals").live().join(passed, ["dt", "seller_id"], "left")
    return totals.select("dt", "seller_id", "amount", stamp("last_ts"), "px", F.coalesce("n_passed", F.lit(0)).cast("bigint").alias("n_passed"))


@query(
    "shop_milestones",
    f"""{s.with_(s.ORDERS)}, f AS (
      SELECT date_trunc('day', ts) AS d, seller_id, to_timestamp(epoch(ts)::BIGINT // 180 * 180)::TIMESTAMP AS fl, sum(fee) AS amount, max(ts) AS ts FROM
        (SELECT * REPLACE (date_trunc('microseconds', ts) AS ts) FROM biz) WHERE is_main = 1 AND is_pay = 1 GROUP BY ALL),
    t AS (SELECT *, CAST(sum(amount) OVER (PARTITION BY d, seller_id ORDER BY fl ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM f),
    p AS (SELECT *, total // {BASE} AS px, coalesce(max(total // {BASE}) OVER (PARTITION BY d, seller_id ORDER BY fl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM t)
    SELECT {s.stamp('d')} AS day, seller_id, {s.stamp('fl')} AS flush, {s.stamp('ts')} AS ts, total, px FROM p WHERE px > earlier""".replace("epoch(ts)::BIGINT", "CAST(floor(epoch(ts)) AS BIGINT)").replace("::TIMESTAMP AS fl", " AT TIME ZONE 'UTC' AS fl"),
)
def shop_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kpi.shop_milestones(a.order_flow(spark, sf_dir), base=BASE)
    return found.select(stamp("day"), "seller_id", stamp("flush"), stamp("ts"), "total", "px")


@query("src_prior_day_amount", f"""WITH d AS ({_SHOP_DAY}) SELECT seller_id, amount, amount // {BASE} AS px FROM d WHERE day = '{DAY} 00:00:00'""")
def prior_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = kpi.shop_day_amount(a.order_flow(spark, sf_dir)).withColumn("dt", scalars.yyyymmdd(F.col("day")))
    return dimensions.prior_shop_amounts(stored, int(DAY.replace("-", "")), BASE).select("seller_id", "amount", "px")


@query("uv_sketch", f"{s.with_(s.UNIFIED)} SELECT item_id, count(DISTINCT visitor) AS uv, true AS within FROM rows_ GROUP BY item_id")
def uv_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kpi.uv_sketch(a.unified(spark, sf_dir), ["item_id"])
    return found.select("item_id", "uv", (F.abs(F.col("uv_estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), 0.03 * F.col("uv"))).alias("within"))


# ---- orders


def _children_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.with_payment(a.children(spark, sf_dir), a.payments(spark, sf_dir))


_ALLOCATED = f"""{s.with_(s.CHILDREN, s.PAYMENTS)}, j AS (
      SELECT c.*, coalesce(p.actual_total_fee, 0) AS paid_total, price * qty - discount + adjust AS line FROM children c LEFT JOIN payments p ON c.parent_id = p.order_id),
    w AS (SELECT *, sum(line) OVER (PARTITION BY parent_id) AS lines FROM j),
    x AS (SELECT *, CAST(CASE WHEN lines <> 0 THEN CAST(paid_total AS HUGEINT) * line // lines ELSE 0 END AS BIGINT) AS share FROM w)"""


@query("order_fee_allocation", f"{_ALLOCATED} SELECT parent_id, order_id, line, share, CASE WHEN pay_status = 2 THEN CASE WHEN share = 0 THEN line ELSE share END END AS fee FROM x")
def order_fee_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_fee_allocation(_children_paid(spark, sf_dir)).select("parent_id", "order_id", "line", "share", "fee")


@query("join_parent_payment", f"{_ALLOCATED} SELECT parent_id, count(*) AS n, CAST(max(paid_total) AS BIGINT) AS paid_total FROM x GROUP BY parent_id")
def join_parent_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _children_paid(spark, sf_dir).groupBy("parent_id").agg(F.count(F.lit(1)).alias("n"), F.max("paid_total").alias("paid_total"))


@query("order_completeness", f"{s.with_(s.CHILDREN)} SELECT o_orderkey AS parent_id, CAST(o_orderkey % 6 AS BIGINT) AS n_expected, count(c.order_id) AS n_children, count(c.order_id) >= o_orderkey % 6 AS complete FROM orders LEFT JOIN children c ON c.parent_id = o_orderkey GROUP BY o_orderkey")
def order_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("parent_id"), (F.col("o_orderkey") % 6).alias("n_expected"))
    return orders.order_completeness(a.children(spark, sf_dir), expected).select("parent_id", "n_expected", "n_children", "complete")


_PARENTS = f"""{s.with_(s.CHILDREN)}, c AS (SELECT *, CASE WHEN line_no IN (5, 6) THEN 1 ELSE 0 END AS is_main, CASE WHEN line_no IN (6, 7) THEN 0 ELSE 1 END AS is_detail FROM children),
    j AS (SELECT CAST(parent_id AS VARCHAR) AS parent_id, item_id, o_orderstatus AS status FROM c JOIN orders ON o_orderkey = parent_id WHERE is_main = 0 AND is_detail = 1
      UNION ALL SELECT order_id, item_id, NULL FROM c WHERE is_main = 1 AND is_detail = 1)
    SELECT parent_id, count(*) AS n, count(DISTINCT item_id) AS items, max(status) AS status FROM j GROUP BY parent_id"""


def _parents_and_children(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders as parents. Lines 5 are their own children, lines 6 parent rows and lines 7 neither; all others are children."""
    parents = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("is_main"), F.lit(0).alias("is_detail"))
    line = F.col("line_no")
    flags = {"is_main": F.when(line.isin(5, 6), 1).otherwise(0), "is_detail": F.when(line.isin(6, 7), 0).otherwise(1)}
    children = a.children(spark, sf_dir).withColumns({"parent_id": F.col("parent_id").cast("string")} | flags)
    return parents, children


def _families(joined: DataFrame) -> DataFrame:
    return joined.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_id").alias("items"), F.max("p_status").alias("status"))


@query("join_parent_children_all", _PARENTS)
def join_parent_children_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _families(orders.parents_with_children(*_parents_and_children(spark, sf_dir)))


def _order_tables(spark: SparkSession, sf_dir: str, name: str) -> OrderTables:
    parents, children = _parents_and_children(spark, sf_dir)
    # lines are at least as many as children; their number is in the files' footers
    rows = max(a.table(spark, sf_dir, t_).count() for t_ in ("orders", "lineitem"))
    tables = OrderTables.of_rows(spark, _scratch(spark, name), rows)
    tables.write(parents=parents, children=children, payments=a.payments(spark, sf_dir))
    return tables


@query("join_parent_children", _PARENTS)
def join_parent_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored tables that share their buckets, joined where they lie."""
    return _families(_order_tables(spark, sf_dir, "join_parent_children").parents_with_children())


@query(
    "order_lookup",
    f"""{s.with_(s.CHILDREN, s.PAYMENTS)} SELECT CAST(p.order_id AS VARCHAR) AS order_id, count(*) AS n_children, min(c.order_id) AS first_child, any_value(actual_total_fee) AS paid FROM payments p JOIN children c ON c.parent_id = p.order_id GROUP BY p.order_id""",
)
def order_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children of each order that is paid for, looked up in the stored index."""
    tables = _order_tables(spark, sf_dir, "order_lookup")
    found = tables.read("payments").hint("merge").join(tables.index(), F.col("order_id") == F.col("index_key"))
    return found.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_children"), F.min("primary_key").alias("first_child"), F.max("actual_total_fee").alias("paid"))


_LATEST = f"{s.with_(s.CHILDREN)} SELECT order_id, max(order_modified_t) AS order_modified_t, count(*) > 0 AS found FROM children GROUP BY order_id"


@query("latest_by_key", _LATEST)
def latest_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.latest_children(a.children(spark, sf_dir)).select("order_id", "order_modified_t", F.lit(True).alias("found"))


@query(
    "join_latest_child",
    f"""{s.with_(s.CHILDREN)}, v AS (SELECT parent_id, order_id, order_modified_t AS t, pay_status FROM children
      UNION ALL SELECT parent_id, order_id, order_modified_t + CASE WHEN line_no % 2 = 1 THEN 86400000 ELSE -86400000 END, 3 FROM children)
    SELECT v.parent_id, v.order_id, max(o_orderstatus) AS status, max(t) AS order_modified_t, arg_max(pay_status, t) AS pay_status FROM v JOIN orders ON o_orderkey = v.parent_id GROUP BY ALL""",
)
def join_latest_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined with the most recent of two rows of each child; the second row of a child with an odd line is the later one."""
    time = F.col("order_modified_t")
    moved = F.when(F.col("line_no") % 2 == 1, 86_400_000).otherwise(-86_400_000)
    # both rows of a child are made of one row, which is joined with its order once, and have the columns that are asked for
    both = F.array(F.struct(time, "pay_status"), F.struct((time + moved).alias("order_modified_t"), F.lit(3).alias("pay_status")))
    versions = a.children(spark, sf_dir).select("parent_id", "order_id", F.inline(both))
    parents = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    joined = orders.parents_with_latest_children(parents, versions)
    return joined.select("parent_id", "order_id", F.col("p_status").alias("status"), "order_modified_t", "pay_status")


@query(
    "join_parent_payment_inner",
    f"""{s.with_(s.CHANGES, s.PAYMENTS)} SELECT f.order_id, is_main, CASE WHEN p.actual_total_fee > 0 THEN p.actual_total_fee ELSE f.actual_total_fee END AS actual_total_fee
    FROM (SELECT *, CAST(order_id % 2 AS INTEGER) AS is_main FROM flagged) f LEFT JOIN payments p ON p.order_id = f.order_id AND is_main = 1
    WHERE is_main = 0 OR (p.order_id IS NOT NULL AND f.pay_time <> '\\N')""",
)
def join_parent_payment_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.order_changes(spark, sf_dir).withColumns({"is_main": (F.col("order_id") % 2).cast("int"), "is_detail": (1 - F.col("order_id") % 2).cast("int")})
    return orders.parents_paid_or_children(rows, a.payments(spark, sf_dir)).select("order_id", "is_main", "actual_total_fee")


@query("order_flags", f"{s.with_(s.CHANGES)} SELECT order_id, is_new_generated, is_pay FROM flagged")
def order_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.order_flags(a.order_changes(spark, sf_dir)).select("order_id", "is_new_generated", "is_pay")


_REASON = """CASE WHEN biz_type = 800 THEN 'distribution' WHEN TRY_CAST(seller_id AS BIGINT) IS NULL OR CAST(seller_id AS BIGINT) = 0 THEN 'seller'
    WHEN biz_type = 10000 AND attributes NOT LIKE '%stepss:2%' THEN 'presale' WHEN is_new_generated <> 1 AND paid <> 1 THEN 'neither' END"""
_ADMITTED = f"""{s.with_(s.CHANGES, s.SHOP_SELLERS)}, p AS (SELECT *, CASE WHEN biz_type = 10000 AND db_action LIKE '%32%' THEN 1 ELSE is_pay END AS paid FROM flagged), why AS (SELECT *, {_REASON} AS reason FROM p)"""


@query("order_admission", f"{_ADMITTED} SELECT order_id, CAST(seller_id AS BIGINT) AS seller_id, paid AS is_pay FROM why WHERE reason IS NULL AND CAST(seller_id AS BIGINT) IN (SELECT shop_id FROM shop_sellers)")
def order_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    enrolled = a.shop_sellers(spark, sf_dir).select(F.col("shop_id").alias("seller_id"))
    return enrich.order_admission(enrich.order_flags(a.order_changes(spark, sf_dir)), enrolled).select("order_id", "seller_id", "is_pay")


@query("admission_stats", f"{_ADMITTED} SELECT count(*) FILTER (reason IS NOT NULL) AS discarded, count(*) FILTER (reason IS NULL AND is_new_generated = 1) AS new_emitted, count(*) FILTER (reason IS NULL AND paid = 1) AS paid_emitted FROM why")
def admission_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.order_flags(a.order_changes(spark, sf_dir))
    return stats.admission_stats(rows, enrich.admission_reason(rows), enrich.paid_flag(rows))


@query("join_enrolled_seller", f"{s.with_(s.CHANGES, s.SHOP_SELLERS)} SELECT order_id FROM changes WHERE CAST(seller_id AS BIGINT) IN (SELECT shop_id FROM shop_sellers)")
def join_enrolled_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.order_changes(spark, sf_dir).withColumn("seller_id", F.col("seller_id").try_cast("bigint"))
    return enrich.join_enrolled_seller(rows, a.shop_sellers(spark, sf_dir).select(F.col("shop_id").alias("seller_id"))).select("order_id")


@query("order_event_time", f"{s.with_(s.CHANGES)} SELECT order_id, CASE WHEN is_pay = 1 AND pay_time <> '\\N' THEN pay_time WHEN gmt_modified <> '' THEN gmt_modified ELSE gmt_create END AS event_time, CASE WHEN pay_time <> '\\N' THEN pay_time WHEN gmt_modified <> '' THEN gmt_modified ELSE gmt_create END AS any_time FROM flagged")
def order_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.order_flags(a.order_changes(spark, sf_dir))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.select("order_id", text(enrich.order_event_time(rows)).alias("event_time"), text(enrich.order_event_time(rows, strict=False)).alias("any_time"))


# ---- page views

_IDENTITY = """CASE WHEN dest_type = 'browse' THEN split_part(sid, '_', 1) ELSE sid END AS sid,
    CASE WHEN dest_type = 'browse' THEN CASE WHEN uid NOT IN ('', '-', '0') THEN uid ELSE mid END END AS uid_mid,
    CASE WHEN dest_type = 'browse' THEN CASE WHEN uid NOT IN ('', '-', '0') THEN uid || ':' ELSE ':' || split_part(sid, '_', 1) END END AS puid"""


@query("visitor_identity", f"{s.with_(s.FLOW)} SELECT event_id, {_IDENTITY} FROM flow")
def visitor_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.visitor_identity(a.flow(spark, sf_dir)).select("event_id", "sid", "uid_mid", "puid")


@query("session_fields", f"{s.with_(s.FLOW)} SELECT event_id, CASE WHEN session = '' THEN substr(md5(mid || '|' || ts_ms || '|' || url), 1, 24) ELSE split_part(session, '_', 1) END AS ss, CASE WHEN session = '' THEN 1 ELSE CAST(split_part(session, '_', 3) AS INTEGER) END AS url_sn FROM flow")
def session_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.session_fields(a.flow(spark, sf_dir).withColumn("uid_mid", F.col("mid"))).select("event_id", "ss", "url_sn")


@query("flow_admission", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT event_id, item_id, flow.shop_id, seller_id FROM flow JOIN shop_sellers USING (shop_id) WHERE item_id <> 0")
def flow_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.flow_admission(a.flow(spark, sf_dir), a.shop_sellers(spark, sf_dir)).select("event_id", "item_id", "shop_id", "seller_id")


@query("join_shop_seller", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT event_id, seller_id FROM flow JOIN shop_sellers USING (shop_id)")
@query("slim_projection", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT event_id, seller_id FROM flow JOIN shop_sellers USING (shop_id)")
def join_shop_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.slim(enrich.join_shop_seller(a.flow(spark, sf_dir), a.shop_sellers(spark, sf_dir)), ["event_id", "seller_id"])


@query("join_shop_info", f"{s.with_(s.FLOW, s.SHOPS)} SELECT event_id, user_id, nick, shop_type, unit_id, '120' AS log_status FROM flow JOIN shops USING (shop_id) WHERE unit_id > 0 AND is_active = 1 AND init_time + days * 86400 > {NOW_S}")
def join_shop_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich.join_shop_info(a.flow(spark, sf_dir), dimensions.active_shops(a.shops(spark, sf_dir), NOW_S))
    return found.select("event_id", "user_id", "nick", "shop_type", "unit_id", "log_status")


@query("src_shop_dim", f"{s.with_(s.SHOPS)} SELECT shop_id, nick, shop_type, user_id, unit_id FROM shops WHERE is_active = 1 AND init_time + days * 86400 > {NOW_S}")
def src_shop_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.active_shops(a.shops(spark, sf_dir), NOW_S)


@query("src_shop_seller_map", "SELECT s_suppkey // 2 AS shop_id, max(s_suppkey) + 5000 AS seller_id FROM supplier GROUP BY 1")
def src_shop_seller_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    lines = a.table(spark, sf_dir, "supplier").select(F.concat_ws("-", F.expr("s_suppkey div 2").cast("string"), (key + 5000).cast("string")).alias("value"), key.alias("line_no"))
    return dimensions.shop_seller_map(lines)


@query("src_ip_ranges", f"{s.with_(s.IP)} SELECT * FROM ip")
def src_ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.ip_ranges(a.ip_lines(spark, sf_dir))


@query("join_ip_location", f"{s.with_(s.FLOW, s.IP)} SELECT event_id, coalesce(location_id, 0) AS location_id FROM flow LEFT JOIN ip ON ip_num BETWEEN start_ip AND end_ip")
def join_ip_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.join_ip_location(a.flow(spark, sf_dir), dimensions.ip_ranges(a.ip_lines(spark, sf_dir))).select("event_id", "location_id")


_RETURN = f"""{s.with_(s.FLOW)}, d AS (SELECT DISTINCT shop_id, visitor, CAST(ts AS DATE) AS day FROM flow),
    f AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY shop_id, visitor ORDER BY day) <= 6 THEN 1 ELSE 0 END AS dp_return FROM d)"""


@query("return_visitor", f"{_RETURN} SELECT event_id, dp_return, 0 AS url_return FROM flow JOIN f ON f.shop_id = flow.shop_id AND f.visitor = flow.visitor AND f.day = CAST(flow.ts AS DATE)")
def return_visitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.return_visitor(a.flow(spark, sf_dir)).select("event_id", "dp_return", "url_return")


@query("uv_probe", f"{s.with_(s.FLOW)} SELECT event_id FROM flow a WHERE ts >= TIMESTAMP '{DAY}' AND EXISTS (SELECT 1 FROM flow b WHERE b.shop_id = a.shop_id AND b.visitor = a.visitor AND b.ts < TIMESTAMP '{DAY}')")
def uv_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, split = a.flow(spark, sf_dir), F.lit(DAY).cast("timestamp")
    return visitors.seen_before(rows.filter(F.col("ts") >= split), rows.filter(F.col("ts") < split)).select("event_id")


ITEM_RULES = [enrich.FieldRules("url", "item", ((2, r"^https?://([^/]+)/[a-z]{2}/(\d+)\.html"), (1, r"/[a-z]{2}/(\d+)\?page="), (1, r"/(\d+)/$")))]
_REGEX = """CASE WHEN regexp_matches(url, '(?i)^https?://([^/]+)/[a-z]{2}/(\\d+)\\.html') THEN regexp_extract(url, '(?i)^https?://([^/]+)/[a-z]{2}/(\\d+)\\.html', 2)
    WHEN regexp_matches(url, '(?i)/[a-z]{2}/(\\d+)\\?page=') THEN regexp_extract(url, '(?i)/[a-z]{2}/(\\d+)\\?page=', 1)
    WHEN regexp_matches(url, '/(\\d+)/$') THEN regexp_extract(url, '/(\\d+)/$', 1) ELSE '' END"""
_RULE = """CASE WHEN regexp_matches(url, '(?i)^https?://([^/]+)/[a-z]{2}/(\\d+)\\.html') THEN 1 WHEN regexp_matches(url, '(?i)/[a-z]{2}/(\\d+)\\?page=') THEN 2 WHEN regexp_matches(url, '/(\\d+)/$') THEN 3 ELSE 0 END"""


@query("regex_extract_fields", f"SELECT page_id, CASE WHEN url IS NOT NULL THEN {_REGEX} END AS item, CASE WHEN url IS NOT NULL THEN {_RULE} END AS item_rule FROM pages")
def regex_extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.regex_extract_fields(a.table(spark, sf_dir, "pages").select("page_id", "url"), ITEM_RULES).select("page_id", "item", "item_rule")


@query("rule_hit_stats", f"SELECT CASE WHEN url IS NOT NULL THEN {_RULE} END AS rule, count(*) AS hits FROM pages GROUP BY 1")
def rule_hit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rule_hit_stats(enrich.regex_extract_fields(a.table(spark, sf_dir, "pages").select("url"), ITEM_RULES), "item_rule")


@query("query_params", """WITH p AS (SELECT page_id, unnest(string_split(regexp_replace(url, '^[^?]*\\?', ''), '&')) AS part FROM pages WHERE contains(url, '?'))
    SELECT page_id, split_part(part, '=', 1) AS name, split_part(part, '=', 2) AS value FROM p WHERE len(string_split(part, '=')) = 2""")
def query_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = a.table(spark, sf_dir, "pages").select("page_id", F.explode(scalars.query_params(F.col("url"))).alias("name", "value"))
    return pages.select("page_id", "name", "value")


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a title and a referrer: every third has none, others the page's own host."""
    k = F.col("page_id")
    return a.table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("Page "), k.cast("string"), F.lit("-site")).alias("title"), F.when(k % 3 == 0, "").otherwise(F.col("url")).alias("refer_url"), F.concat((k % 500).cast("string")).alias("shop_id"))


@query(
    "page_classify",
    """WITH p AS (SELECT page_id, 'Page ' || page_id AS name, 'Page ' || page_id || '-site' AS title, url FROM pages),
    r AS (SELECT *, CASE WHEN regexp_matches(url, '(?i)^https?://[^/]+/(\\w{2})/(\\d+)\\?page=(\\d+)') AND NOT contains(url, '//m.') THEN 'paged'
      WHEN regexp_matches(url, '(?i)^https?://[^/]+/\\w{2}/(\\d+)\\.html') THEN 'item' WHEN regexp_matches(url, '(?i)^https?://[^/]+/(\\w{2})/(\\d+)/$') THEN 'list'
      WHEN regexp_matches(url, '#top$') THEN 'label' WHEN regexp_matches(url, '(?i)^https?://[^/]+/?$') THEN 'home' ELSE '' END AS page_rule FROM p)
    SELECT page_id, page_rule, CASE page_rule WHEN 'paged' THEN '2' WHEN 'item' THEN '4' WHEN 'list' THEN '3' WHEN 'label' THEN '5' WHEN 'home' THEN '7' ELSE '0' END AS page_type,
      CASE page_rule WHEN 'paged' THEN regexp_extract(url, '/(\\d+)\\?page=', 1) WHEN 'item' THEN regexp_extract(url, '/(\\d+)\\.html', 1) WHEN 'list' THEN 'all_items' WHEN 'label' THEN 'label' WHEN 'home' THEN 'home' ELSE '' END AS key_info,
      CASE page_rule WHEN 'item' THEN title ELSE name END AS title_info FROM r""",
)
def page_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.page_classify(_titled(spark, sf_dir), t.PAGE_RULES).select("page_id", "page_rule", "page_type", "key_info", "title_info")


_SOURCES = """WITH p AS (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN '' ELSE url END AS ref, CAST(page_id % 500 AS VARCHAR) AS shop FROM pages),
    r AS (SELECT *, CASE WHEN ref = '' THEN 'direct' WHEN regexp_matches(url, '[?&]utm_source=feed') THEN 'feed' WHEN regexp_matches(ref, '^https?://(?:www|m)\\.') THEN 'shop'
      WHEN regexp_matches(split_part(ref, '?', 1), '^https?://blog\\.') THEN 'blog' WHEN contains(ref, 'example.org') THEN 'engine'
      WHEN contains(split_part(ref, '?', 1), 'example.net') THEN 'partner' ELSE '' END AS source_rule FROM p),
    c AS (SELECT page_id, source_rule,
      CASE source_rule WHEN 'direct' THEN '6' WHEN 'feed' THEN '11' WHEN 'shop' THEN CASE WHEN regexp_extract(ref, '/(\\d+)(?:[/?#.]|$)', 1) = shop THEN '59' ELSE '30' END
        WHEN 'blog' THEN '113' WHEN 'engine' THEN '62' WHEN 'partner' THEN '105' ELSE '74' END AS src_id,
      CASE WHEN source_rule IN ('shop', 'blog') THEN ref ELSE '' END AS ref_url,
      CASE source_rule WHEN 'feed' THEN regexp_extract(url, '/(\\d+)\\?', 1) WHEN 'engine' THEN regexp_extract(ref, '[?&]page=(\\d+)', 1) ELSE '' END AS src_key FROM r)"""


@query("referrer_classify", f"{_SOURCES} SELECT *, CASE WHEN src_key = '' THEN '0' WHEN source_rule = 'feed' THEN '2' ELSE '4' END AS src_key_type FROM c")
def referrer_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.referrer_classify(_titled(spark, sf_dir), t.SOURCE_RULES).select("page_id", "source_rule", "src_id", "ref_url", "src_key", "src_key_type")


def _sampled(spark: SparkSession, sf_dir: str, samples: list[str], name: str) -> F.Column:
    """The sample that falls to an event, with its number."""
    chosen = F.get(F.array(*[F.lit(x) for x in samples]), (F.col("event_id") % len(samples)).cast("int"))
    return F.replace(chosen, F.lit("{n}"), F.col("event_id").cast("string")).alias(name)


def _sampled_sql(samples: list[str], name: str) -> str:
    quoted = ", ".join("'" + x.replace("'", "''") + "'" for x in samples)
    return f"replace(([{quoted}])[event_id % {len(samples)} + 1], '{{n}}', CAST(event_id AS VARCHAR)) AS {name}"


_RULED_PAGES = t.PAGE_SAMPLES + t.UNRULED_PAGES
_RULED = t.page_sql(f"SELECT event_id AS n, {_sampled_sql(_RULED_PAGES, 'url')}, 'Page ' || event_id || '-site' AS title FROM events")


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    rows = a.table(spark, sf_dir, "events").select(n.alias("n"), _sampled(spark, sf_dir, _RULED_PAGES, "url"), F.concat(F.lit("Page "), n.cast("string"), F.lit("-site")).alias("title"))
    return classify.page_classify(rows, t.PAGE_RULES)


@query("page_classify_rules", _RULED)
def page_classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of each form of three platforms for the events, and pages of no rule, under all rules."""
    return _ruled(spark, sf_dir).select("n", "page_rule", "page_type", "key_info", "title_info", "key", "key_type")


_NAMES = lambda rules: "(VALUES " + ", ".join(f"('{r.name}')" for r in rules) + ", ('')) AS v(rule)"


@query("page_rule_hits", f"WITH c AS ({_RULED}) SELECT rule, count(n) AS hits FROM {_NAMES(t.PAGE_RULES)} LEFT JOIN c ON page_rule = rule GROUP BY rule")
def page_rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.rule_hits(_ruled(spark, sf_dir), t.PAGE_RULES, "page_rule")


_RULED_SOURCES = t.SOURCE_SAMPLES + t.ODD_SOURCES
_SOURCED = t.source_sql(f"SELECT event_id AS n, {_sampled_sql([x[0] for x in _RULED_SOURCES], 'url')}, {_sampled_sql([x[1] for x in _RULED_SOURCES], 'ref')}, CAST(event_id - event_id % 2 AS VARCHAR) AS shop FROM events")


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events are on the shop that the referrer names, where it names one."""
    n = F.col("event_id")
    urls, refs = zip(*_RULED_SOURCES, strict=True)
    rows = a.table(spark, sf_dir, "events").select(n.alias("n"), _sampled(spark, sf_dir, [*urls], "url"), _sampled(spark, sf_dir, [*refs], "refer_url"), (n - n % 2).cast("string").alias("shop_id"))
    return classify.referrer_classify(rows, t.SOURCE_RULES)


@query("referrer_classify_rules", _SOURCED)
def referrer_classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the events, in all groups, under all rules."""
    return _sourced(spark, sf_dir).select("n", "source_rule", "src_id", "ref_url", "src_key", "src_key_type")


@query("source_rule_hits", f"WITH c AS ({_SOURCED}) SELECT rule, count(n) AS hits FROM {_NAMES(t.SOURCE_RULES)} LEFT JOIN c ON source_rule = rule GROUP BY rule")
def source_rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.rule_hits(_sourced(spark, sf_dir), t.SOURCE_RULES, "source_rule")


_SEARCHED = _SOURCES.replace("FROM pages)", "FROM (SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'http://shop.example.com/search?q=word' || (page_id % 50) || '&low=' || (page_id % 9) ELSE url END AS url FROM pages))", 1)


@query(
    "keyword_precedence",
    f"""{_SEARCHED}, t AS (SELECT *, CASE WHEN src_key = '' THEN '0' WHEN source_rule = 'feed' THEN '2' ELSE '4' END AS src_key_type FROM c)
    SELECT page_id, CASE WHEN page_id % 4 = 1 AND src_key_type <> '2' THEN 'word' || (page_id % 50) || '||' || (page_id % 9) || '~' ELSE src_key END AS keyword,
      CASE WHEN page_id % 4 = 1 AND src_key_type <> '2' THEN '3' ELSE src_key_type END AS keyword_type FROM t""",
)
def keyword_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth page is a search page, whose own keyword counts unless a paid source brought one."""
    k = F.col("page_id")
    search = F.concat(F.lit("http://shop.example.com/search?q=word"), (k % 50).cast("string"), F.lit("&low="), (k % 9).cast("string"))
    rows = _titled(spark, sf_dir).withColumn("url", F.when(k % 4 == 1, search).otherwise(F.col("url")))
    rows = rows.withColumn("refer_url", F.when(k % 3 == 0, "").otherwise(F.col("url")))
    both = classify.referrer_classify(classify.page_classify(rows, t.PAGE_RULES), t.SOURCE_RULES)
    return classify.keyword_precedence(both).select("page_id", "keyword", "keyword_type")


# ---- scalars


@query("time_buckets", f"""SELECT event_id, {s.stamp("date_trunc('hour', ts)")} AS hour_start, {s.stamp("date_trunc('day', ts)")} AS day_start, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS yyyymmdd, CAST(hour(ts) AS INTEGER) AS hour_of_day,
    {s.stamp("date_trunc('day', ts) + to_minutes(CAST((hour(ts) * 60 + minute(ts)) // 15 * 15 + 15 AS INTEGER))")} AS quarter_end FROM events""")
def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, text = F.col("ts").cast("timestamp"), lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return a.table(spark, sf_dir, "events").select("event_id", text(scalars.hour_start(ts)).alias("hour_start"), text(scalars.day_start(ts)).alias("day_start"), scalars.yyyymmdd(ts).alias("yyyymmdd"), scalars.hour_of_day(ts).alias("hour_of_day"), text(scalars.bucket_end(ts, 15, "minute")).alias("quarter_end"))


@query("id_tagging", f"{s.with_(s.FLOW)} SELECT event_id, item_id * 10 + 1 AS item_tag, shop_id * 10 + 2 AS seller_tag, item_id AS id, 1 AS kind FROM flow")
def id_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.flow(spark, sf_dir).withColumns({"item_tag": scalars.tag_item(F.col("item_id")), "seller_tag": scalars.tag_seller(F.col("shop_id"))})
    return rows.withColumn("u", scalars.untag(F.col("item_tag"))).select("event_id", "item_tag", "seller_tag", "u.id", "u.kind")


_DOTTED = "(ip_num & 255) || '.' || ((ip_num >> 8) & 255) || '.' || ((ip_num >> 16) & 255) || '.' || ((ip_num >> 24) & 255)"


@query("ip_to_dotted", f"{s.with_(s.FLOW)} SELECT event_id, {_DOTTED} AS dotted, (ip_num & 255) * 16777216 + ((ip_num >> 8) & 255) * 65536 + ((ip_num >> 16) & 255) * 256 + ((ip_num >> 24) & 255) AS back FROM flow")
@query("ip_to_long", f"{s.with_(s.FLOW)} SELECT event_id, {_DOTTED} AS dotted, (ip_num & 255) * 16777216 + ((ip_num >> 8) & 255) * 65536 + ((ip_num >> 16) & 255) * 256 + ((ip_num >> 24) & 255) AS back FROM flow")
def ip_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.flow(spark, sf_dir).withColumn("dotted", scalars.ip_to_dotted(F.col("ip_num")))
    return rows.select("event_id", "dotted", scalars.ip_to_long(F.col("dotted")).alias("back"))


#: CRC-32 of a list of bytes, bit by bit from its polynomial.
_CRC = "xor(4294967295, list_reduce(list_concat([4294967295], {0}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"
_BYTES = "list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"


@query(
    "shard_of",
    f"""{s.with_(s.FLOW)}, t AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    v AS (SELECT visitor, {_CRC.format(_BYTES.format('visitor'))} AS cv FROM (SELECT DISTINCT visitor FROM flow), t),
    h AS (SELECT shop_id, {_CRC.format('list_transform(range(8), lambda k: (shop_id >> CAST(56 - 8 * k AS INTEGER)) & 255)')} AS cs FROM (SELECT DISTINCT shop_id FROM flow), t),
    i AS (SELECT item_id, {_CRC.format(_BYTES.format('CAST(item_id AS VARCHAR)'))} AS ci FROM (SELECT DISTINCT item_id FROM flow), t)
    SELECT event_id, CAST(cv % 32 AS INTEGER) AS shard, CAST(cs % 256 AS INTEGER) AS seller_shard, hour(ts) * 4294967296 + ci AS packed FROM flow JOIN v USING (visitor) JOIN h USING (shop_id) JOIN i USING (item_id)""",
)
def shard_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.flow(spark, sf_dir).select("event_id", scalars.shard_of(F.col("visitor")).alias("shard"), scalars.shard_of_long(F.col("shop_id")).alias("seller_shard"), scalars.packed_key(F.hour("ts"), F.col("item_id")).alias("packed"))


@query("clean_text", "SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '[|\\x05]', '', 'g') AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "documents").select("doc_id", scalars.clean_text(F.col("text")).alias("cleaned"))


@query(
    "url_decode_gbk",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN '中国 ' || (page_id % 10) WHEN 1 THEN '￥' || (page_id % 10) || '%' WHEN 2 THEN '%D6%FF+' || (page_id % 10) ELSE url END AS decoded FROM pages""",
)
def url_decode_gbk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-byte characters and a blank, a sign and a lone '%', bytes that are no GBK, and the URLs percent-encoded."""
    k = F.col("page_id")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), ":", "%3A"), "[+]", "%2B")
    digit = (k % 10).cast("string")
    encoded = F.when(k % 4 == 0, F.concat(F.lit("%d6%D0%B9%FA+"), digit)).when(k % 4 == 1, F.concat(F.lit("%A3%A4"), digit, F.lit("%"))).when(k % 4 == 2, F.concat(F.lit("%D6%FF+"), digit)).otherwise(plain)
    return a.table(spark, sf_dir, "pages").select("page_id", scalars.url_decode_gbk(encoded).alias("decoded"))


@query("expr_unescape", """SELECT page_id, CASE page_id % 3 WHEN 0 THEN '中é' || (page_id % 10) || '?' WHEN 1 THEN '?x😀?' ELSE url END AS text FROM pages""")
def expr_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of two and four digits, bad and missing digits, pairs of surrogates, and the URLs with some characters escaped."""
    k = F.col("page_id")
    plain = F.regexp_replace(F.regexp_replace("url", ":", "%3A"), "/", "%u002F")
    escaped = F.when(k % 3 == 0, F.concat(F.lit("%u4E2D%E9"), (k % 10).cast("string"), F.lit("%4"))).when(k % 3 == 1, F.lit("%zzx%uD83D%uDE00%u00g0")).otherwise(plain)
    return a.table(spark, sf_dir, "pages").select("page_id", scalars.unescape(escaped).alias("text"))


# ---- change rows and the mapping language

_LINES = f"""{s.with_(s.CHANGES)}, good AS (SELECT *, order_id % 19 = 0 AS deleted, order_id % 50 = 0 AS bad FROM changes)"""
_MAPPED = """order_id, CAST(seller_id AS VARCHAR) AS seller_id, CAST(buyer_id AS VARCHAR) AS buyer_id, CAST(order_id % 100 AS VARCHAR) AS auction_id, order_id * 3 AS auction_price,
    order_id % 5 AS buy_amount, order_id % 7 AS discount_fee, CAST(order_id % 2 AS INTEGER) AS is_main, biz_type"""


def _change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.changelog(logs.fields_of(a.change_lines(spark, sf_dir).select("value")))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_fields(_change_rows(spark, sf_dir), mapping.ORDER, keep=("order_modified_t", "db_action"))


@query("map_fields", f"{_LINES} SELECT {_MAPPED}, (order_id + 1700000000) * 1000 AS order_modified_t, db_action FROM good WHERE NOT deleted AND NOT bad")
@query("expr_field2", f"{_LINES} SELECT {_MAPPED}, (order_id + 1700000000) * 1000 AS order_modified_t, db_action FROM good WHERE NOT deleted AND NOT bad")
def map_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = mapping.split_rejects(_mapped(spark, sf_dir))
    return good.select(F.col("order_id").cast("bigint").alias("order_id"), "seller_id", "buyer_id", "auction_id", "auction_price", "buy_amount", "discount_fee", "is_main", "biz_type", "order_modified_t", "db_action")


def _row_of(places: dict[int, F.Column]) -> F.Column:
    """A row of a feed with some fields, by position."""
    return F.concat_ws(a.LIST, *[F.coalesce(places[k].cast("string"), F.lit("")) if k in places else F.lit("") for k in range(1, max(places) + 1)])


def _feed(rows: DataFrame, head: list[str], row: F.Column, spec: dict[str, str], shown: tuple[str, str, str, str]) -> DataFrame:
    fields = rows.select(F.array(*[F.lit(h) for h in head], row).alias("fields"))
    mapped = mapping.map_fields(fields, spec)
    return mapped.select("log_src", *[F.col(c).cast("string").alias(n) for c, n in zip(shown, ("id", "first", "second", "third"), strict=True)], "reject")


@query(
    "map_feeds",
    """SELECT 'order_0000' AS log_src, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey % 1000 * 100 AS VARCHAR) AS first, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS second, o_orderstatus AS third, CAST(NULL AS VARCHAR) AS reject FROM orders
    UNION ALL SELECT 'member_cart', CASE WHEN l_partkey % 40 <> 0 THEN CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END, CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), CAST(l_linenumber AS VARCHAR), CASE WHEN l_partkey % 40 = 0 THEN 'cart_id' END FROM lineitem
    UNION ALL SELECT 'collect_info', CAST(c_custkey AS VARCHAR), CAST(c_custkey * 7 AS VARCHAR), CAST(c_nationkey AS VARCHAR), c_mktsegment, NULL FROM customer
    UNION ALL SELECT 'browse_log', url, 'u' || page_id, 'c' || (page_id % 9), '中 ' || page_id, NULL FROM pages""",
)
def map_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds of settlements, carts, favourites and page views, each by its own mapping; some carts can't be read."""
    orders_, lines, customers, pages = (a.table(spark, sf_dir, t_) for t_ in ("orders", "lineitem", "customer", "pages"))
    c, now = F.col, "1700000000000:1"
    settled = _row_of({2: c("o_orderkey"), 7: c("o_orderstatus"), 14: c("o_totalprice"), 33: c("o_custkey"), 35: c("o_custkey"), 38: c("o_orderkey") % 1000, 47: F.lit("track")})
    cart = F.when(c("l_partkey") % 40 == 0, F.lit("bad").cast("string")).otherwise((c("l_orderkey") * 10 + c("l_linenumber")).cast("string"))
    carts = _row_of({1: cart, 2: c("l_suppkey"), 3: c("l_partkey"), 4: c("l_quantity").cast("bigint"), 5: c("l_orderkey"), 6: c("l_linenumber"), 7: F.lit(1), 8: F.lit(2), 9: F.lit("x"), 10: F.lit("y"), 13: F.lit(3)})
    liked = _row_of({2: c("c_custkey"), 4: F.lit("x"), 8: F.lit("y"), 12: F.lit(1), 15: F.lit(2), 18: c("c_nationkey"), 19: c("c_mktsegment"), 21: F.lit(4), 31: F.lit("0"), 32: c("c_custkey") * 7, 38: F.lit("\\N")})
    k = c("page_id").cast("string")
    raw = F.struct(F.concat(F.lit("u"), k).alias("uid"), c("url").alias("url"), k.alias("sid"), F.concat(F.lit("c"), (c("page_id") % 9).cast("string")).alias("cna"), F.concat(F.lit("%u4E2D%20"), k).alias("title"), F.lit("").alias("pre"), F.lit("agent").alias("useragent"))
    viewed = mapping.map_fields(pages.select(F.array(F.lit("")).alias("fields"), raw.alias("raw")), mapping.PAGE_VIEW)
    viewed = viewed.select("log_src", c("url").alias("id"), c("uid").alias("first"), c("mid").alias("second"), c("title").alias("third"), "reject")
    head = [now, "db", "t", "time", "insert"]
    return (
        _feed(orders_, head, settled, mapping.SETTLEMENT, ("trade_no", "auction_price", "actual_total_fee", "trade_status"))
        .unionAll(_feed(lines, head, carts, mapping.CART, ("cart_id", "item_id", "quantity", "status")))
        .unionAll(_feed(customers, [now, "db", "insert", "time"], liked, mapping.FAVOURITE, ("user_id", "item_id", "item_category", "item_title")))
        .unionAll(viewed)
    )


@query("reject_bad_rows", f"{_LINES} SELECT 'buy_amount' AS reject, count(*) AS n FROM good WHERE NOT deleted AND bad")
def reject_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.split_rejects(_mapped(spark, sf_dir))[1].groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


@query("src_delimited_log", f"{_LINES} SELECT order_id, 6 AS n_fields, 44 AS n_row FROM good")
def src_delimited_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.fields_of(a.change_lines(spark, sf_dir))
    return rows.select("order_id", F.size("fields").alias("n_fields"), F.size(F.split(F.get("fields", F.lit(5)), a.LIST, -1)).alias("n_row"))


@query("src_changelog", f"{_LINES} SELECT db_action, count(*) AS n, CAST(max(order_id + 1700000000) * 1000 AS BIGINT) AS last_t FROM good WHERE NOT deleted GROUP BY db_action")
def src_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_rows(spark, sf_dir).groupBy("db_action").agg(F.count(F.lit(1)).alias("n"), F.max("order_modified_t").alias("last_t"))


@query("src_changelog_us", f"{_LINES} SELECT 'update:1' AS db_action, count(*) AS n, CAST(max(order_id + 1700000000) AS BIGINT) AS last_t FROM good")
def src_changelog_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines read as microseconds; the action is field three, here set to an update."""
    rows = logs.fields_of(a.change_lines(spark, sf_dir)).withColumn("fields", F.concat(F.slice("fields", 1, 2), F.array(F.lit("UPDATE:1")), F.slice("fields", 4, 3)))
    return logs.changelog(rows, action_pos=3, ts_unit="us").groupBy("db_action").agg(F.count(F.lit(1)).alias("n"), F.max("order_modified_t").alias("last_t"))


@query("src_topic_filter", f"{_LINES} SELECT CASE WHEN order_id % 2 = 0 THEN 'orders' ELSE 'payments' END AS tag, CASE WHEN order_id % 2 = 0 THEN 'biz_order' ELSE 'pay_order' END AS dest_type, count(*) AS n FROM good WHERE NOT deleted AND order_id % 3 <> 2 GROUP BY ALL")
def src_topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = a.change_lines(spark, sf_dir).withColumn("tag", F.when(F.col("order_id") % 3 == 2, "others").when(F.col("order_id") % 2 == 0, "orders").otherwise("payments"))
    routed = logs.route_by_tag(logs.changelog(logs.fields_of(lines)), {"orders": mapping.ORDER, "payments": mapping.PAYMENT})
    return routed.groupBy("tag", "dest_type").agg(F.count(F.lit(1)).alias("n"))


@query("src_pageview", f"{s.with_(s.FLOW)} SELECT event_id, ts_ms // 1000 * 1000 AS ts, {_DOTTED} AS ip, CAST(shop_id AS VARCHAR) AS shopid FROM flow WHERE event_id % 4 <> 3")
def src_pageview(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, shop = F.col("event_id"), F.concat(F.lit("b_"), F.col("shop_id").cast("string"))
    raw = a.flow(spark, sf_dir).select("event_id", F.expr("ts_ms div 1000").alias("time"), F.col("ip_num").alias("ip"), F.when(e % 4 == 0, shop).alias("at_shoptype"), F.when(e % 4 != 3, shop).otherwise("none").alias("at_autype"))
    return logs.normalise_pageviews(raw).select("event_id", "ts", "ip", "shopid")


_START, _END = 1_705_276_800_000, 1_705_363_200_000


def _stored_log(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None) -> StoredLog:
    """All page views, or some rows, stored by day, a few shards to a folder."""
    log = StoredLog(spark, _scratch(spark, name), slot_s=86_400, parts=4)
    log.write(sinks.with_log_key(a.flow(spark, sf_dir).withColumn("puid", F.col("visitor"))) if rows is None else rows)
    return log


@query("src_time_range_scan", f"{s.with_(s.FLOW)} SELECT event_id FROM flow WHERE ts_ms >= {_START} AND ts_ms < {_END} - 180000")
def src_time_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of a stored log of all page views: other slots are not opened."""
    return _stored_log(spark, sf_dir, "src_time_range_scan").scan_range(_START, _END, now_ms=_END).select("event_id")


@query("sink_range_dump", f"{s.with_(s.FLOW)} SELECT event_id, ts_ms, visitor, item_id, true AS bounded FROM flow WHERE ts_ms >= {_START} AND ts_ms < {_END}")
def sink_range_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of the log written to files of at most a hundred rows, and read back."""
    path = _scratch(spark, "sink_range_dump")
    sinks.range_dump(a.flow(spark, sf_dir).select("event_id", "ts_ms", "visitor", "item_id"), path, _START, _END, most_rows=100)
    dumped = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    small = dumped.groupBy("file").agg((F.count(F.lit(1)) <= 100).alias("bounded"))
    return dumped.join(small, "file").drop("file")


@query("src_week_slot_scan", f"{s.with_(s.FLOW)} SELECT event_id, CAST(ts_ms // 1000 % 604800 AS INTEGER) AS slot FROM flow WHERE ts_ms >= {_END} - 7200000 AND ts_ms < {_END} - 180000")
def src_week_slot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two hours before a moment, and their seconds in the week."""
    rows = _stored_log(spark, sf_dir, "src_week_slot_scan").scan_latest(_END, 7_200)
    return rows.select("event_id", "slot")


_SHARDS = (3, 4, 17)
_DAYS_READ = "count(DISTINCT ts_ms // 86400000)"


@query(
    "log_scan_files",
    f"""{s.with_(s.FLOW)}, w AS (SELECT *, CAST(ts_ms // 1000 % 604800 AS INTEGER) AS slot FROM flow)
    SELECT 'range' AS scan, count(*) FILTER (ts_ms >= {_START} AND ts_ms < {_END}) AS n_rows, {_DAYS_READ} FILTER (ts_ms // 86400000 BETWEEN {_START} // 86400000 AND ({_END} - 1) // 86400000) AS n_slots, {_DAYS_READ} AS n_all FROM w
    UNION ALL SELECT 'capped', count(*) FILTER (ts_ms >= {_START} AND ts_ms < {_START} + 180000), {_DAYS_READ} FILTER (ts_ms // 86400000 = {_START} // 86400000), {_DAYS_READ} FROM w
    UNION ALL SELECT 'week', count(*) FILTER (slot >= 500000 AND ts_ms >= {_START} - 604800000 AND ts_ms < {_START}),
      {_DAYS_READ} FILTER (ts_ms // 86400000 BETWEEN ({_START} // 604800000 - CASE WHEN {_START} // 1000 % 604800 < 500000 THEN 1 ELSE 0 END) * 7 + 500000 // 86400 AND ({_START} // 604800000 - CASE WHEN {_START} // 1000 % 604800 < 500000 THEN 1 ELSE 0 END) * 7 + 6), {_DAYS_READ} FROM w""",
)
def log_scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans of a stored log: rows, slots whose files are read, and slots that the log has."""
    log = _stored_log(spark, sf_dir, "log_scan_files")
    slots = lambda df: len({f.partition("slot_of_time=")[2].partition("/")[0] for f in df.inputFiles()})
    everything = slots(log.scan_prefix())
    scans = {"range": log.scan_range(_START, _END), "capped": log.scan_range(_START, _END, most_ms=180_000), "week": log.scan_week_slots(500_000, 700_000, _START)}
    out = [df.agg(F.lit(name).alias("scan"), F.count(F.lit(1)).alias("n_rows")).withColumns({"n_slots": F.lit(slots(df)).cast("bigint"), "n_all": F.lit(everything).cast("bigint")}) for name, df in scans.items()]
    return out[0].unionAll(out[1]).unionAll(out[2])


@query("src_prefix_scan", f"{s.with_(s.FLOW)} SELECT event_id FROM flow WHERE event_id % 3 = 2 AND event_id % 2 = 1 AND event_type = 'view'")
def src_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    rows = a.flow(spark, sf_dir).withColumns({"company": e % 3, "is_shop": e % 2, "url_type": F.when(F.col("event_type") == "view", "4").otherwise("0")})
    keyed = sinks.with_log_key(rows.withColumn("puid", F.col("visitor")))
    return logs.scan_prefix(_stored_log(spark, sf_dir, "src_prefix_scan", keyed).scan_prefix()).select("event_id")


_ASKED = f"{s.with_(s.FLOW, s.ORDERS)} SELECT shop_id AS seller_id, item_id, count(*) AS pv FROM flow WHERE item_id IN (SELECT item_id FROM biz) GROUP BY ALL"


@query("src_prior_item_kpi", _ASKED)
@query("distinct_keys", _ASKED)
@query("src_prior_item_kpi_all", _ASKED)
@query("distinct_keys_all", _ASKED)
def src_prior_item_kpi_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page views stored for items, asked for by every order row: its items repeat and are de-duplicated."""
    stored = a.flow(spark, sf_dir).groupBy(F.col("shop_id").alias("seller_id"), "item_id").agg(F.count(F.lit(1)).alias("pv"))
    return dimensions.prior_item_kpi(stored, a.order_flow(spark, sf_dir), ["item_id"]).select("seller_id", "item_id", "pv")


@query("src_header_delimited", f"{s.with_(s.ORDERS)} SELECT event_id AS order_id, fee, is_pay, CAST(NULL AS VARCHAR) AS missing FROM biz")
def src_header_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows written as files whose first line names the columns, and read back as a target schema has them."""
    path = _scratch(spark, "src_header_delimited")
    text = [F.col(c).cast("string").alias(name) for c, name in (("event_id", "order_id"), ("fee", "fee"), ("is_pay", "is_pay"))]
    a.order_flow(spark, sf_dir).select(*text).write.csv(path, header=True, sep="\x01")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("fee", T.LongType()), T.StructField("is_pay", T.IntegerType()), T.StructField("missing", T.StringType())])
    return logs.read_header_delimited(spark, path, schema)


@query("expr_price_cent", "SELECT o_orderkey AS order_id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(trunc(o_totalprice) AS BIGINT) * 100 AS legacy FROM orders")
def expr_price_cent(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_totalprice").cast("string")
    return a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), mapping.price_cent(text).alias("cents"), mapping.price_cent(text, legacy=True).alias("legacy"))


def _expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.fields_of(a.change_lines(spark, sf_dir)).withColumn("raw", F.struct(F.col("order_id").alias("id")))
    spec = {"id": "@member id", "number": "@bigint @field2 6 11", "small": "@int @field2 6 34", "ms": "@mul @bigint @field2 6 10 1000", "constant": "word"}
    return mapping.map_fields(rows, spec)


_EXPRESSIONS = f"{_LINES} SELECT CAST(order_id AS VARCHAR) AS id, CASE WHEN NOT bad THEN order_id % 5 END AS number, 1 AS small, order_id * 3000 AS ms, 'word' AS constant, CASE WHEN bad THEN 'number' END AS reject FROM good"
for _name in ("expr_int", "expr_bigint", "expr_mul", "expr_member", "expr_literal"):
    query(_name, _EXPRESSIONS)(_expressions)


def _list_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change lines with one more field, whose items have parts; the second item of some has one part only."""
    k = F.col("order_id")
    second = F.when(k % 11 == 0, "b").otherwise(F.concat_ws(a.PART, F.lit("b"), (k % 7).cast("string")))
    lists = F.concat_ws(a.LIST, F.concat_ws(a.PART, k.cast("string"), F.lit("a")), second)
    rows = logs.fields_of(a.change_lines(spark, sf_dir).withColumn("value", F.concat_ws(a.FIELD, "value", lists)))
    spec = {"first": "@field1 1", "part": "@field3 7 1 1", "firsts": "@field3 7 0 1", "number": "@bigint @field3 7 2 2"}
    return mapping.map_fields(rows, spec, keep=("order_id",)).select("order_id", "first", "part", F.translate("firsts", a.LIST, ",").alias("firsts"), "number", "reject")


_LIST_PLACES = f"""{_LINES} SELECT order_id, (order_id + 1700000000) * 1000 || ':7' AS first, CAST(order_id AS VARCHAR) AS part, order_id || ',b' AS firsts,
    CASE WHEN order_id % 11 <> 0 THEN order_id % 7 END AS number, CASE WHEN order_id % 11 = 0 THEN 'number' END AS reject FROM good"""
for _name in ("expr_field1_places", "expr_field3_places"):
    query(_name, _LIST_PLACES)(_list_places)


@query("expr_field1", f"{_LINES} SELECT order_id, (order_id + 1700000000) * 1000 || ':7' AS stamp, 'db' AS source, 't_0001' AS place, gmt_create AS time, CASE WHEN deleted THEN 'DELETE' ELSE upper(db_action) END AS action, CAST(NULL AS VARCHAR) AS beyond, 'beyond' AS reject FROM good")
def expr_field1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of level one of all change lines, and one that they do not have."""
    spec = {"stamp": "@field1 1", "source": "@field1 2", "place": "@field1 3", "time": "@field1 4", "action": "@field1 5", "beyond": "@field1 9"}
    return mapping.map_fields(logs.fields_of(a.change_lines(spark, sf_dir)), spec, keep=("order_id",))


@query("expr_field3", f"{_LINES} SELECT order_id, CAST(order_id % 3 AS VARCHAR) AS part, order_id || ',' || order_id % 5 AS heads, CASE WHEN order_id % 11 <> 0 THEN order_id % 7 END AS last, CASE WHEN order_id % 11 = 0 THEN 'last' END AS reject FROM good")
def expr_field3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the items of a list: a single one, the first of every item, and one that some items do not have."""
    k = F.col("order_id")
    text = lambda c: c.cast("string")
    last = F.when(k % 11 == 0, text(k % 5)).otherwise(F.concat_ws(a.PART, text(k % 5), text(k % 7)))
    lists = F.concat_ws(a.LIST, F.concat_ws(a.PART, text(k), text(k % 3)), last)
    rows = logs.fields_of(a.change_lines(spark, sf_dir).withColumn("value", F.concat_ws(a.FIELD, "value", lists)))
    spec = {"part": "@field3 7 1 2", "heads": "@field3 7 0 1", "last": "@bigint @field3 7 2 2"}
    return mapping.map_fields(rows, spec, keep=("order_id",)).select("order_id", "part", F.translate("heads", a.LIST, ",").alias("heads"), "last", "reject")


# ---- sinks and upkeep


@query("sink_route", f"{s.with_(s.FLOW)} SELECT CASE WHEN dest_type = 'browse' THEN 'views' END AS target, count(*) AS n FROM flow WHERE dest_type = 'browse' GROUP BY 1")
def sink_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views put by the sink into the tables of their types, one batch twice, and read back."""
    path = _scratch(spark, "sink_route")
    write = sinks.route_write(path, {"browse": "views", "cart": "carts"})
    rows = a.flow(spark, sf_dir).select("event_id", "dest_type", F.to_date("ts").cast("string").alias("dt"))
    for batch, part in ((0, rows.filter("event_id % 2 = 0")), (1, rows.filter("event_id % 2 = 1")), (1, rows.filter("event_id % 2 = 1"))):
        write(part, batch)
    return sinks.route_stored(spark, path).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("sink_salted_key", f"{s.with_(s.FLOW)}, i AS (SELECT event_id, ts_ms, {_IDENTITY} FROM flow) SELECT event_id, puid, CAST(ts_ms // 1000 % 604800 AS INTEGER) AS slot, true AS in_range FROM i WHERE puid IS NOT NULL AND puid NOT IN (':', ':-')")
def sink_salted_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of visitors that can be told, stored by day and shard, and read back shard by shard."""
    log = _stored_log(spark, sf_dir, "sink_salted_key", sinks.with_log_key(enrich.visitor_identity(a.flow(spark, sf_dir))))
    rows = log.scan_prefix(shards=[*range(32)])
    return rows.select("event_id", "puid", "slot", (F.col("shard") == scalars.shard_of(F.col("puid"))).alias("in_range"))


@query("sink_order_index", f"{s.with_(s.CHILDREN)} SELECT parent_id AS index_key, order_id AS primary_key FROM children WHERE parent_id <> 0")
def sink_order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of children as it is stored, in buckets of the parent's id."""
    return _order_tables(spark, sf_dir, "sink_order_index").index().select(F.col("index_key").cast("bigint").alias("index_key"), "primary_key")


@query("sink_subscriber_fanout", f"{s.with_(s.FLOW)} SELECT 'clicks' AS subscriber, count(*) AS n FROM flow WHERE dest_type = 'click' AND item_id <> 7 UNION ALL SELECT 'all', count(*) FROM flow")
def sink_subscriber_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [sinks.Subscriber("clicks", "dest_type = 'click' and item_id <> 7", ("event_id", "item_id")), sinks.Subscriber("all"), sinks.Subscriber("off", enabled=False)]
    out = [part.agg(F.lit(name).alias("subscriber"), F.count(F.lit(1)).alias("n")) for name, part in sinks.fan_out(a.flow(spark, sf_dir), wanted).items()]
    return out[0].unionByName(out[1])


@query("sink_text_dump", f"""{s.with_(s.SHOPS)} SELECT shop_id || '"' || nick || '"' || user_id AS value FROM shops WHERE unit_id = 3""")
def sink_text_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.text_dump(a.shops(spark, sf_dir), ["shop_id", "nick", "user_id"], unit_id=3)


@query("sink_kpi_put", f"{s.with_(s.UNIFIED)} SELECT item_id, CAST(CASE WHEN item_id % 2 = 0 THEN 2 * sum(view) ELSE sum(view) END AS BIGINT) AS pv FROM rows_ GROUP BY item_id")
def sink_kpi_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all items stored, then those of even items put in their place; what is stored then."""
    table = VersionedTable(spark, _scratch(spark, "sink_kpi_put"), "shard")
    old = a.unified(spark, sf_dir).groupBy("item_id").agg(F.sum("view").alias("pv")).withColumn("shard", scalars.shard_of(F.col("item_id"), 8))
    table.put(old, ["item_id"])
    table.put(old.filter("item_id % 2 = 0").withColumn("pv", 2 * F.col("pv")), ["item_id"])
    return table.live().select("item_id", "pv")


def _by_day(spark: SparkSession, sf_dir: str, name: str) -> VersionedTable:
    """All page views in a stored table, by day."""
    table = VersionedTable(spark, _scratch(spark, name))
    table.put(a.flow(spark, sf_dir).select("event_id", "ts", F.to_date("ts").cast("string").alias("dt")), ["event_id", "dt"])
    return table


@query("maint_retention", f"{s.with_(s.FLOW)} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n FROM flow WHERE CAST(ts AS DATE) > DATE '2024-01-20' - 5 GROUP BY 1")
def maint_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a stored table that are over are taken out of it, unread, and their files removed."""
    table = _by_day(spark, sf_dir, "maint_retention")
    table.retain(5, "2024-01-20")
    table.vacuum(keep=0)
    return table.live().groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("maint_count", f"{s.with_(s.FLOW)} SELECT count(*) AS n FROM flow WHERE CAST(ts AS DATE) = DATE '{DAY}' AND hour(ts) = 3")
def maint_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a stored table one day is read."""
    return sinks.count_rows(_by_day(spark, sf_dir, "maint_count").live([DAY]), f"to_date(ts) = date'{DAY}' and hour(ts) = 3")


@query("maint_delete", f"{s.with_(s.FLOW)} SELECT event_id FROM flow WHERE NOT (CAST(ts AS DATE) = DATE '{DAY}' AND hour(ts) < 12)")
def maint_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stored table that go: one day's version is replaced, the others stay as they are."""
    table = _by_day(spark, sf_dir, "maint_delete")
    table.delete(f"to_date(ts) = date'{DAY}' and hour(ts) < 12", parts=[DAY])
    return table.live().select("event_id")


# ---- counts


@query("route_stats", f"{s.with_(s.FLOW)} SELECT dest_type, count(*) AS n, CAST(sum(strlen(url)) AS BIGINT) AS n_bytes, max(ts_ms) AS last_ts FROM flow GROUP BY dest_type")
def route_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.route_stats(a.flow(spark, sf_dir), F.col("url"))


@query("throughput_stats", f"""{s.with_(s.FLOW)}, p AS (SELECT date_trunc('hour', ts) AS p, count(*) AS n FROM flow GROUP BY 1)
    SELECT {s.stamp('p')} AS period, n, CAST(coalesce(epoch(p) - epoch(lag(p) OVER (ORDER BY p)) - 3600, 0) AS BIGINT) AS stalled_s FROM p""")
def throughput_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.throughput_stats(a.flow(spark, sf_dir)).select(stamp("period"), "n", "stalled_s")


@query("error_log_stats", """WITH l AS (SELECT user_id % 10 AS host, event_id AS line_no, epoch(ts) AS ts, event_type, event_type || ' ' || props AS message FROM events),
    f AS (SELECT * FROM l WHERE event_type = 'error' AND message LIKE '%7%' AND ts > 1706572800 - 864000)
    SELECT host, count(*) AS n_errors, min(line_no) AS first_line FROM f GROUP BY host""")
def error_log_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = a.table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("host"), F.col("event_id").alias("line_no"), F.col("ts").cast("timestamp").cast("double").alias("ts"), F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"), F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", "props").alias("message"))
    marked = lines.withColumn("message", F.concat_ws("\t", F.col("line_no").cast("string"), F.regexp_replace("message", r"^\d+ ", "")))
    only = marked.withColumn("level", F.when(F.substring_index("message", "\t", -1).contains("7"), F.col("level")).otherwise("INFO"))
    found = stats.error_log_stats(only, 1_706_572_800, "error", last_s=864_000)
    return found.select("host", "n_errors", F.substring_index(F.substring_index("first_context", "\n", -1), "\t", 1).cast("bigint").alias("first_line"))


@query("order_by_log_time", f"{s.with_(s.FLOW)} SELECT event_id, ts_ms FROM flow ORDER BY ts_ms, event_id LIMIT 100")
def order_by_log_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred rows in the order of the log: a top-k report."""
    return logs.by_log_time(a.flow(spark, sf_dir).select("event_id", "ts_ms"), first=100)


@query("order_by_log_time_all", f"{s.with_(s.FLOW)} SELECT event_id, ts_ms FROM flow ORDER BY ts_ms, event_id")
def order_by_log_time_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in the order of the log, sorted in ranges of it."""
    return logs.by_log_time(a.flow(spark, sf_dir).select("event_id", "ts_ms"))


# ---- streams: all that is there is read once; results equal those of the batch


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path for a stream's checkpoint and output, in the folder that all machines share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="retailflow-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.stream_of(spark, f"{sf_dir}/events.parquet")


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = a.seller_flow(spark, sf_dir, _events(spark, sf_dir))
    ordered = a.order_flow(spark, sf_dir, _events(spark, sf_dir))
    return kpi.unified(views.withWatermark("ts", streams.FLOW_LAG), ordered.withWatermark("ts", streams.ORDER_LAG))


_ADDITIVE_HOUR = f"""{s.with_(s.UNIFIED)} SELECT {s.stamp("date_trunc('hour', ts)")} AS bucket, seller_id, item_id, {s.KPI.rsplit("count(DISTINCT", 2)[0].rstrip(', \n')}, true AS iuv_close FROM rows_ GROUP BY ALL"""


@query("st_tumbling", _ADDITIVE_HOUR)
def st_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: the watermark ends the state of hours that are over."""
    found = streams.drained(streams.tumbling(_streamed(spark, sf_dir), "1 hour"), _scratch(spark, "st_tumbling"), "update", ("bucket", "seller_id", "item_id"))
    exact = kpi.item_kpi(a.unified(spark, sf_dir), "hour").select("bucket", "seller_id", "item_id", F.col("iuv").alias("x"))
    joined = found.join(exact, ["bucket", "seller_id", "item_id"])
    close = F.abs(F.col("iuv") - F.col("x")) <= F.greatest(F.lit(1.0), 0.03 * F.col("x"))
    return joined.select(stamp("bucket"), "seller_id", "item_id", *kpi.ADDITIVE, close.alias("iuv_close"))


_SHOP_STREAM = f"""{s.with_(s.ORDERS)} SELECT {s.stamp("date_trunc('day', ts)")} AS day, seller_id, CAST(sum(CASE WHEN is_main = 1 AND is_pay = 1 THEN fee ELSE 0 END) AS BIGINT) AS amount FROM biz GROUP BY ALL"""


def _day_amounts(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    rows = a.order_flow(spark, sf_dir, events).withWatermark("ts", streams.ORDER_LAG)
    paid = F.when((F.col("is_main") == 1) & (F.col("is_pay") == 1), F.col("fee")).otherwise(0)
    return rows.groupBy(F.window("ts", "1 day").alias("w"), "seller_id").agg(F.sum(paid).alias("amount")).select(F.col("w.start").alias("day"), "seller_id", "amount")


@query("st_shop_day_amount", _SHOP_STREAM)
def st_shop_day_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = streams.drained(_day_amounts(spark, sf_dir, _events(spark, sf_dir)), _scratch(spark, "st_shop"), "update", ("day", "seller_id"))
    return found.select(stamp("day"), "seller_id", "amount")


@query("st_reset", _SHOP_STREAM.replace("FROM biz GROUP BY ALL", "FROM biz WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM biz) - INTERVAL 180 SECOND GROUP BY ALL"))
def st_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a day's amounts come once, when the day is over for sure, and its state goes; the day that runs is not there yet."""
    found = streams.drained(_day_amounts(spark, sf_dir, _events(spark, sf_dir)), _scratch(spark, "st_reset"))
    return found.select(stamp("day"), "seller_id", "amount")


@query("st_lag", f"{s.with_(s.FLOW)} SELECT {s.stamp("date_trunc('hour', ts)")} AS bucket, count(*) AS pv FROM flow WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM flow) - INTERVAL 60 SECOND GROUP BY 1")
def st_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views by hour, read 60 seconds behind: an hour is given out when no more of it can come."""
    rows = a.flow(spark, sf_dir, _events(spark, sf_dir)).withWatermark("ts", streams.FLOW_LAG)
    found = rows.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("pv")).select(F.col("w.start").alias("bucket"), "pv")
    return streams.drained(found, _scratch(spark, "st_lag")).select(stamp("bucket"), "pv")


@query(
    "align_streams",
    f"""{s.with_(s.FLOW, s.ORDERS)}, both_ AS (SELECT ts, shop_id AS seller_id, 1 AS view, 0 AS fee FROM flow UNION ALL SELECT ts, seller_id, 0, fee FROM biz)
    SELECT {s.stamp("date_trunc('hour', ts)")} AS bucket, seller_id, CAST(sum(view) AS BIGINT) AS pv, CAST(sum(fee) AS BIGINT) AS fee FROM both_
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= least((SELECT max(ts) FROM flow) - INTERVAL 60 SECOND, (SELECT max(ts) FROM biz) - INTERVAL 180 SECOND) GROUP BY ALL""",
)
def align_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views and orders by hour and seller; an hour closes when the slower of the two streams has passed it."""
    views = a.seller_flow(spark, sf_dir, _events(spark, sf_dir)).select("ts", "seller_id", F.lit(1).alias("view"), F.lit(0).cast("bigint").alias("fee"))
    sold = a.order_flow(spark, sf_dir, _events(spark, sf_dir)).select("ts", "seller_id", F.lit(0).alias("view"), "fee")
    hours = streams.aligned(views, sold).groupBy(F.window("ts", "1 hour").alias("w"), "seller_id").agg(F.sum("view").alias("pv"), F.sum("fee").alias("fee"))
    found = streams.drained(hours.select(F.col("w.start").alias("bucket"), "seller_id", "pv", "fee"), _scratch(spark, "align_streams"))
    return found.select(stamp("bucket"), "seller_id", "pv", "fee")


#: Times at which the stored events are split for queries that run a stream several times; half days are split too.
CUTS = ("2024-01-08 12:00:00", "2024-01-16 12:00:00", "2024-01-24 12:00:00")
_RUN = "(" + " + ".join(f"CAST(ts >= TIMESTAMP '{c}' AS INTEGER)" for c in CUTS) + ")"


def _in_runs(spark: SparkSession, sf_dir: str, path: str, stream: Callable[[DataFrame], DataFrame], mode: str, sink: sinks.Sink | None = None) -> DataFrame:
    """The micro-batches of a stream that is started anew from its checkpoint each time that more events are there."""
    run = F.lit(0)
    for c in CUTS:
        run = run + (F.col("ts") >= F.lit(c).cast("timestamp")).cast("int")
    for k in range(len(CUTS) + 1):
        a.table(spark, sf_dir, "events").filter(run == k).write.mode("append").parquet(f"{path}/in")
        query = streams.start(stream(streams.stream_of(spark, f"{path}/in")), f"{path}/checkpoint", sink or streams.batches_into(f"{path}/out"), mode, once=True)
        query.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("st_flush", f"{s.with_(s.ORDERS)} SELECT {s.stamp("date_trunc('day', ts)")} AS day, seller_id, CAST(sum(CASE WHEN is_main = 1 AND is_pay = 1 THEN fee ELSE 0 END) AS BIGINT) AS amount, count(DISTINCT {_RUN}) AS n_flushes FROM biz GROUP BY ALL")
def st_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each flush puts the keys that changed since the last one, with their totals so far; the last put counts."""
    flushed = _in_runs(spark, sf_dir, _scratch(spark, "st_flush"), lambda events: _day_amounts(spark, sf_dir, events), "update")
    n = flushed.groupBy("day", "seller_id").agg(F.count_distinct("batch").alias("n_flushes"))
    last = streams.last_of(flushed, ["day", "seller_id", "amount"], ("day", "seller_id"))
    return last.join(n, ["day", "seller_id"]).select(stamp("day"), "seller_id", "amount", "n_flushes")


@query("st_flush_backlog", f"{s.with_(s.ORDERS)} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, seller_id, CAST(sum(CASE WHEN is_main = 1 AND is_pay = 1 THEN fee ELSE 0 END) AS BIGINT) AS amount, 3 AS n_first, 60 AS narrow_s, 180 AS wide_s FROM biz GROUP BY ALL")
def st_flush_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by day and seller that are put at intervals. Twelve files are there at once, each a micro-batch that stands for a
    minute: while more than six wait flushes are three minutes apart, below three they are one minute apart again."""
    path = _scratch(spark, "st_flush_backlog")
    stored = a.table(spark, sf_dir, "events")
    files = 12
    # a file for each part of the log's time, in its order
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    low, high = stored.agg(F.min(seconds), F.max(seconds)).first()
    place = F.least(F.lit(files - 1), F.floor((seconds - low) / max(high - low, 1.0) * files))
    for k in range(files):
        stored.filter(place == k).coalesce(1).write.mode("append").parquet(f"{path}/in")
    done = [0]
    sink = flushes.BacklogFlush(spark, path, ["dt", "seller_id"], waiting=lambda: files - done[0], clock=lambda: 60.0 * done[0], widen_above=6, narrow_below=3)

    def write(batch: DataFrame, batch_id: int) -> None:
        done[0] = batch_id + 1
        sink.write(batch.select(F.to_date("day").cast("string").alias("dt"), "seller_id", "amount"), batch_id)

    streams.start(_day_amounts(spark, sf_dir, streams.stream_of(spark, f"{path}/in", files=1)), f"{path}/checkpoint", write, "update", once=True).awaitTermination()
    sink.flush()
    intervals = [f[1] for f in sink.flushes if f[1]]
    return sink.table.live().select("dt", "seller_id", "amount", F.lit(max(f[2] for f in sink.flushes)).alias("n_first"), F.lit(int(min(intervals))).alias("narrow_s"), F.lit(int(max(intervals))).alias("wide_s"))


_OVERLAP_MS = 21_600_000
_LATE = "event_id % 3 = 0 AND " + "(" + " OR ".join(f"(ts >= TIMESTAMP '{c}' - INTERVAL 6 HOUR AND ts < TIMESTAMP '{c}')" for c in CUTS) + ")"


@query("st_resume_positions", f"{s.with_(s.FLOW)} SELECT event_id, ts_ms, {_LATE} AS came_late, 1 AS n_times FROM flow")
def st_resume_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored log read in four pulls, each from six hours before the shards' positions. A third of the rows of the last six
    hours come after the pull that should have read them. The third pull is killed when its rows are delivered but its
    position is not stored, and run again."""
    path = _scratch(spark, "st_resume_positions")
    run = F.lit(0)
    for c in CUTS:
        run = run + (F.col("ts") >= F.lit(c).cast("timestamp")).cast("int")
    late = F.expr(_LATE)
    rows = sinks.with_log_key(a.flow(spark, sf_dir).withColumn("puid", F.col("visitor"))).select("event_id", "ts", "ts_ms", "shard", late.alias("came_late"), (run + late.cast("int")).alias("run"))
    log = StoredLog(spark, f"{path}/log", slot_s=86_400, parts=2)
    reader = flushes.PositionedReader(log, path, overlap_ms=_OVERLAP_MS)

    def deliver(new: DataFrame, n: int) -> None:
        new.write.mode("overwrite").parquet(f"{path}/out/pull={n}")

    def deliver_and_die(new: DataFrame, n: int) -> None:
        deliver(new, n)
        raise InterruptedError

    for k, end in enumerate((*CUTS, "2100-01-01 00:00:00")):
        log.write(rows.filter(F.col("run") == k))
        until = int(spark.range(1).select(F.unix_millis(F.lit(end).cast("timestamp"))).first()[0]) + 1
        if k == 2:
            with contextlib.suppress(InterruptedError):
                reader.pull(until, deliver_and_die, lag_ms=0)
        reader.pull(until, deliver, lag_ms=0)
    return spark.read.parquet(f"{path}/out").groupBy("event_id", "ts_ms", "came_late").agg(F.count(F.lit(1)).cast("int").alias("n_times"))


@query("st_resume", f"{s.with_(s.FLOW)} SELECT {_RUN} AS run, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n FROM flow GROUP BY ALL")
def st_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of page views stopped and started again three times: each run goes on where the last one ended."""
    read = _in_runs(spark, sf_dir, _scratch(spark, "st_resume"), lambda events: a.flow(spark, sf_dir, events).select("event_id", "ts"), "append")
    return read.groupBy(F.col("batch").alias("run"), F.to_date("ts").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@query("st_throughput", "SELECT count(*) AS n_rows, true AS has_rates, false AS stalled FROM events")
def st_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener hears of a stream that reads all events: rows, rates of its batches, and no stall."""
    heard = streams.Throughput()
    with streams.watched(spark, heard):
        streams.drained(_events(spark, sf_dir).select("event_id"), _scratch(spark, "st_throughput"))
        stalled = bool(heard.stalled())
    rates = [r for own in heard.seen_rates.values() for r in own]
    return spark.createDataFrame([(sum(heard.rows.values()), any(r > 0 for r in rates), stalled)], "n_rows bigint, has_rates boolean, stalled boolean")


@query("st_late_drop", f"{s.with_(s.ORDERS)} SELECT event_id FROM biz WHERE ts >= TIMESTAMP '{DAY}'")
def st_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule for late orders, which holds for streams and batches alike."""
    rows = a.order_flow(spark, sf_dir, _events(spark, sf_dir))
    late = kpi.drop_late_orders(rows, 1_705_276_800_000).select("event_id")
    return streams.drained(late, _scratch(spark, "st_late"), mode="append")


@query("st_return_state", f"{s.with_(s.FLOW)} SELECT DISTINCT shop_id, visitor, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM flow")
def st_return_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = streams.visits(a.flow(spark, sf_dir, _events(spark, sf_dir)))
    return streams.drained(found, _scratch(spark, "st_visits"), mode="append").withColumn("day", F.col("day").cast("string"))


@query("st_return_flags", f"{_RETURN} SELECT event_id, flow.shop_id, flow.visitor, dp_return FROM flow JOIN f ON f.shop_id = flow.shop_id AND f.visitor = flow.visitor AND f.day = CAST(flow.ts AS DATE)")
def st_return_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag of each page view as it comes, in a stream that is stopped and started again three times, also amid a day."""
    with states.rocksdb_state(spark):
        found = _in_runs(spark, sf_dir, _scratch(spark, "st_return_flags"), lambda events: states.return_flags(a.flow(spark, sf_dir, events)), "append")
    return found.select("event_id", "shop_id", "visitor", "dp_return")


@query(
    "st_pending_outcomes",
    f"""{s.with_(s.ORDERS)} SELECT c.event_id, p.event_id AS parent_event, CASE WHEN p.event_id IS NULL THEN 'timed out' ELSE 'matched' END AS outcome FROM biz c LEFT JOIN biz p ON c.item_id = p.item_id AND p.is_main = 1
    AND abs(epoch_us(p.ts) // 1000 - epoch_us(c.ts) // 1000) <= 600000 WHERE c.is_main = 0 AND (p.event_id IS NOT NULL OR epoch_us(c.ts) // 1000 + 600000 < (SELECT max(epoch_us(ts) // 1000) FROM biz) - 180000)""",
)
def st_pending_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows of one item within ten minutes of each other, as children and parents, and the children that waited in vain; the
    stream is stopped and started again three times."""
    def both(events: DataFrame) -> DataFrame:
        rows = a.order_flow(spark, sf_dir, events).withColumn("parent_id", F.col("item_id"))
        return states.pending(rows.filter("is_main = 0"), rows.filter("is_main = 1"), wait_ms=600_000)

    path = _scratch(spark, "st_pending_outcomes")
    with states.rocksdb_state(spark):
        _in_runs(spark, sf_dir, path, both, "append", states.in_tables(f"{path}/out"))
    return spark.read.parquet(f"{path}/out").select("event_id", "parent_event", "outcome")


@query("st_pending_ttl", f"""{s.with_(s.ORDERS)} SELECT c.event_id, p.event_id AS parent_event FROM biz c JOIN biz p ON c.item_id = p.item_id
    AND p.ts BETWEEN c.ts - INTERVAL 60 SECOND AND c.ts + INTERVAL 60 SECOND WHERE c.is_main = 0 AND p.is_main = 1""")
def st_pending_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows of one item that are within a minute of each other, as children and parents."""
    rows = a.order_flow(spark, sf_dir, _events(spark, sf_dir)).withColumn("parent_id", F.col("item_id"))
    children = rows.filter("is_main = 0").select("event_id", "parent_id", "ts")
    parents = a.order_flow(spark, sf_dir, _events(spark, sf_dir)).filter("is_main = 1").select(F.col("item_id").alias("parent_id"), F.col("ts").alias("p_ts"), F.col("event_id").alias("parent_event"))
    joined = streams.children_with_parents(children, parents).select("event_id", "parent_event")
    return streams.drained(joined, _scratch(spark, "st_pending"), mode="append")


@query("st_dim_refresh", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT seller_id, count(*) AS n FROM flow JOIN shop_sellers USING (shop_id) GROUP BY seller_id")
def st_dim_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views joined in each micro-batch with the dimension as it is then."""
    dim, path = streams.Dimension(lambda: a.shop_sellers(spark, sf_dir)), _scratch(spark, "st_dim")

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich.join_shop_seller(batch, dim.now()).select("seller_id").write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    streams.start(a.flow(spark, sf_dir, _events(spark, sf_dir)).select("event_id", "shop_id"), f"{path}/checkpoint", write, mode="append", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("seller_id").agg(F.count(F.lit(1)).alias("n"))


_SELLER_NOW = f"CAST(seller_id + 10000 * CASE {_RUN} WHEN 3 THEN 2 WHEN 2 THEN 1 ELSE {_RUN} END AS BIGINT)"


def _seller_versions(spark: SparkSession, sf_dir: str, name: str) -> tuple[flushes.DimensionHistory, list[DataFrame]]:
    """A history of shops' sellers, and what is loaded before each run: new sellers, the same once more as an empty reload,
    new ones again with a shop gone."""
    sellers = a.shop_sellers(spark, sf_dir)
    moved = lambda k: sellers.withColumn("seller_id", F.col("seller_id") + 10_000 * k)
    return flushes.DimensionHistory(spark, _scratch(spark, name), ("shop_id",)), [sellers, moved(1), sellers.filter("false"), moved(2).filter("shop_id <> 0")]


@query("st_dim_versions", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT {_RUN} AS run, {_SELLER_NOW} AS seller_id, count(*) AS n FROM flow JOIN shop_sellers USING (shop_id) WHERE {_RUN} < 3 OR shop_id <> 0 GROUP BY ALL")
def st_dim_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views joined with their shop's seller in a stream of four runs, between which the dimension changes."""
    history, loads = _seller_versions(spark, sf_dir, "st_dim_versions")
    path = _scratch(spark, "st_dim_versions")
    dim = streams.Dimension(lambda: history.current())

    def write(batch: DataFrame, batch_id: int) -> None:
        history.load(loads[batch_id], ("2024-01-01 00:00:00", *CUTS)[batch_id])
        enrich.join_shop_seller(batch, dim.now()).select("seller_id").write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    read = _in_runs(spark, sf_dir, path, lambda events: a.flow(spark, sf_dir, events).select("event_id", "shop_id", "ts"), "append", write)
    return read.groupBy(F.col("batch").alias("run"), "seller_id").agg(F.count(F.lit(1)).alias("n"))


@query("join_dim_valid", f"{s.with_(s.FLOW, s.SHOP_SELLERS)} SELECT event_id, {_SELLER_NOW} AS seller_id FROM flow JOIN shop_sellers USING (shop_id) WHERE ts >= TIMESTAMP '2024-01-01' AND ({_RUN} < 3 OR shop_id <> 0)")
def join_dim_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views with the seller that their shop had at the time, from the dimension's history."""
    history, loads = _seller_versions(spark, sf_dir, "join_dim_valid")
    for rows, since in zip(loads, ("2024-01-01 00:00:00", *CUTS), strict=True):
        history.load(rows, since)
    return history.join(a.flow(spark, sf_dir)).select("event_id", "seller_id")


_PUT = f"{s.with_(s.UNIFIED)} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, item_id, CAST(sum(view) AS BIGINT) AS pv FROM rows_ WHERE view = 1 GROUP BY ALL"


@query("st_delivery", _PUT)
def st_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by day and item that a stream merges into a stored table; every batch is written twice, as after a failure."""
    path = _scratch(spark, "st_delivery")

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.select("dt", "item_id", "pv").unionByName(new.select("dt", "item_id", "pv")).groupBy("dt", "item_id").agg(F.sum("pv").alias("pv"))

    sink = sinks.upsert_write(f"{path}/table", ["dt", "item_id"], "dt", combine)

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.to_date("ts").cast("string").alias("dt"), "item_id").agg(F.count(F.lit(1)).alias("pv"))
        sink(counted, batch_id)
        sink(counted, batch_id)

    rows = a.flow(spark, sf_dir, _events(spark, sf_dir)).select("ts", "item_id")
    streams.start(rows, f"{path}/checkpoint", write, mode="append", once=True).awaitTermination()
    return VersionedTable(spark, f"{path}/table").live().select("dt", "item_id", "pv")
