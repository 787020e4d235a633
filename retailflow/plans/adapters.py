"""The logical tables of the library, derived from the supplied tables by plain arithmetic that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD, LIST, PART = "\x02", "\x01", "\x03"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def events(spark: SparkSession, sf_dir: str, types: tuple[str, ...], rows: DataFrame | None = None) -> DataFrame:
    """Events with their time and item; the item is the number in props. rows: a stream of events, in place of the table."""
    df = (table(spark, sf_dir, "events") if rows is None else rows).filter(F.col("event_type").isin(*types))
    return df.withColumns({"ts": F.col("ts").cast("timestamp"), "item_id": F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")})


def n_sellers(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "supplier").count()


def flow(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Page views."""
    user, e = F.col("user_id").cast("string"), F.col("event_id")
    df = events(spark, sf_dir, ("view", "click"), rows)
    return df.select(
        "event_id",
        "ts",
        F.unix_millis("ts").alias("ts_ms"),
        F.when(e % 5 == 0, F.lit("-")).when(e % 7 == 0, F.lit("0")).otherwise(user).alias("uid"),
        F.concat(F.lit("m"), user).alias("mid"),
        F.concat_ws("_", user, (e % 7).cast("string"), (e % 13).cast("string")).alias("sid"),
        F.when(e % 11 == 0, F.lit("")).otherwise(F.concat_ws("_", user, (e % 7).cast("string"), (e % 13).cast("string"))).alias("session"),
        F.when(e % 3 == 0, F.lit("click")).otherwise(F.lit("browse")).alias("dest_type"),
        user.alias("visitor"),
        "item_id",
        (F.col("item_id") % n_sellers(spark, sf_dir)).alias("shop_id"),
        ((e * 2654435761) % 4294967296).alias("ip_num"),
        "event_type",
        F.concat(F.lit("/item?id="), F.col("item_id").cast("string")).alias("url"),
    )


def seller_flow(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Page views as the indicators take them: the shop's seller in place of the shop."""
    df = flow(spark, sf_dir, rows)
    return df.select("ts", "ts_ms", F.col("shop_id").alias("seller_id"), "item_id", F.col("visitor").alias("uid_mid"))


def order_flow(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Order rows for the same items: purchases are paid, sign-ups new."""
    e = F.col("event_id")
    df = events(spark, sf_dir, ("purchase", "signup"), rows)
    return df.select(
        "event_id",
        "ts",
        F.unix_millis("ts").alias("ts_ms"),
        "item_id",
        (F.col("item_id") % n_sellers(spark, sf_dir)).alias("seller_id"),
        F.col("user_id").alias("buyer_id"),
        (1 + e % 3).alias("buy_amount"),
        cents(F.col("value")).alias("fee"),
        (F.col("event_type") == "purchase").cast("int").alias("is_pay"),
        (F.col("event_type") == "signup").cast("int").alias("is_new"),
        F.lit(1).alias("is_detail"),
        (e % 2).cast("int").alias("is_main"),
    )


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.kpi import unified as both

    return both(seller_flow(spark, sf_dir), order_flow(spark, sf_dir))


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child orders: lines of orders. Line numbers repeat, so a child's id is its order's with part, supplier and line."""
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    df = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return df.select(
        F.col("l_orderkey").alias("parent_id"),
        key.alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("o_custkey").alias("buyer_id"),
        cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        cents(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
        cents(F.col("l_extendedprice") * F.col("l_tax")).alias("adjust"),
        F.when(F.col("l_linestatus") == "F", 2).otherwise(1).alias("pay_status"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("order_modified_t"),
        F.lit(0).alias("is_main"),
        F.lit(1).alias("is_detail"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment rows of finished orders; every tenth is missing."""
    df = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' and o_orderkey % 10 <> 0")
    return df.select(F.col("o_orderkey").alias("order_id"), cents(F.col("o_totalprice")).alias("actual_total_fee"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of orders: actions, states and times that exercise every flag."""
    k = F.col("o_orderkey")
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    df = table(spark, sf_dir, "orders")
    return df.select(
        k.alias("order_id"),
        (F.col("o_custkey") % n_sellers(spark, sf_dir)).cast("string").alias("seller_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.when(k % 4 == 0, "insert").when(k % 4 == 1, "update:16,13").when(k % 4 == 2, "update: 6 ,17").otherwise("update:113,32,10").alias("db_action"),
        F.when(k % 3 == 0, "order_0000").when(k % 3 == 1, "tc_biz_order").otherwise("tc_pay_order").alias("log_src"),
        F.when(F.col("o_orderstatus") == "F", "TRADE_FINISHED").when(F.col("o_orderstatus") == "O", "TRADE_SUCCESS").otherwise("WAIT_SELLER_SEND_GOODS").alias("trade_status"),
        F.when(k % 5 < 3, 2).otherwise(1).alias("pay_status"),
        F.when(k % 17 == 0, 800).when(k % 13 == 0, 10000).otherwise(200).alias("biz_type"),
        F.when(k % 2 == 0, "a:1;stepss:2;b:3").otherwise("stepss:1").alias("attributes"),
        F.when(k % 6 == 0, "\\N").otherwise(day).alias("pay_time"),
        F.when(k % 9 == 0, "").otherwise(day).alias("gmt_modified"),
        day.alias("gmt_create"),
        cents(F.col("o_totalprice")).alias("actual_total_fee"),
    )


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shop dimension."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("shop_id"), F.col("s_name").alias("nick"), (s % 2).cast("int").alias("shop_type"), (s + 1000).alias("user_id"), (s % 10).alias("unit_id"), F.when(s % 9 == 0, 0).otherwise(1).alias("is_active"), (F.lit(1_704_067_200) + s * 3600).alias("init_time"), (s % 40).alias("days")
    )


def shop_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops that have a seller: four of five."""
    return table(spark, sf_dir, "supplier").filter("s_suppkey % 5 <> 4").select(F.col("s_suppkey").alias("shop_id"), (F.col("s_suppkey") + 5000).alias("seller_id"))


def ip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of address ranges: some for each nation, with gaps between them."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n"), F.col("n_regionkey").cast("bigint").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
    start = (F.col("n") * 10 + F.col("k")) * 17_179_869
    parts = [start, start + 9_999_999, F.col("n"), F.lit("x"), F.col("r"), F.lit("y"), F.col("k")]
    return n.select(F.concat_ws("\x05", *[p.cast("string") for p in parts]).alias("value"))


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order change rows as lines: level one '\\x02', level two '\\x01', 44 fields in the row; some delete, some are bad."""
    o, k = order_changes(spark, sf_dir), F.col("order_id")
    row = [F.lit("")] * 44
    for place, column in ((1, k), (5, F.col("buyer_id")), (6, F.col("seller_id")), (7, k % 100), (10, k * 3), (11, F.when(k % 50 == 0, F.lit("bad")).otherwise((k % 5).cast("string"))), (12, F.col("biz_type")), (13, F.col("pay_status")), (15, F.col("gmt_create")), (16, F.col("gmt_modified")), (32, F.col("pay_time")), (34, F.lit(1)), (35, k % 2), (37, k - k % 2), (38, F.lit(0)), (39, k % 7), (44, F.col("seller_id"))):
        row[place - 1] = column.cast("string")
    action = F.when(k % 19 == 0, F.lit("DELETE")).otherwise(F.upper("db_action"))
    line = F.concat_ws(FIELD, F.concat(((k + 1_700_000_000) * 1000).cast("string"), F.lit(":7")), F.lit("db"), F.lit("t_0001"), F.col("gmt_create"), action, F.concat_ws(LIST, *row))
    return o.select("order_id", line.alias("value"))
