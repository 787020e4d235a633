"""Enrichment of page views and orders: identities, flags, sessions, admission and dimension joins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]

# Trade states in which an order counts as closed, and the columns whose update means payment.
CLOSED = ("TRADE_CLOSED", "TRADE_FINISHED", "TRADE_CANCEL", "TRADE_REFUSE", "TRADE_REFUSE_DEALING")
PAID_STATES = ("TRADE_SUCCESS", "WAIT_SELLER_SEND_GOODS")
SETTLEMENT, ORDER, PAYMENT = "order_0000", "tc_biz_order", "tc_pay_order"


def pipeline(df: DataFrame, *stages: Stage) -> DataFrame:
    for stage in stages:
        df = df.transform(stage)
    return df


def visitor_identity(df: DataFrame) -> DataFrame:
    """For rows of dest_type 'browse': sid up to its first '_', uid_mid (uid, or else mid) and puid ('uid:' or ':sid')."""
    browse = F.col("dest_type") == "browse"
    cut = F.instr("sid", "_") > 1
    sid = F.when(cut, F.substring_index("sid", "_", 1)).otherwise(F.coalesce("sid", F.lit("")))
    uid = F.coalesce("uid", F.lit(""))
    known = (uid != "") & (uid != "-") & (F.trim(uid) != "0")
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.withColumns(
        {
            "sid": F.when(browse, sid).otherwise(F.col("sid")),
            "uid_mid": F.when(browse, F.when(known, uid).otherwise(F.coalesce("mid", F.lit("")))).otherwise(own("uid_mid")),
            "puid": F.when(browse, F.when(known, F.concat(uid, F.lit(":"))).otherwise(F.concat(F.lit(":"), sid))).otherwise(own("puid")),
        }
    )


def action_columns(action: Column) -> Column:
    """Column numbers of an 'update:1,2' action, as trimmed texts."""
    return F.transform(F.split(F.substring(action, len("update:") + 1, 1 << 20), ","), lambda c: F.trim(c))


def order_flags(df: DataFrame) -> DataFrame:
    """is_new_generated and is_pay of change rows of orders, payments and settlements."""
    action, state = F.coalesce("db_action", F.lit("")), F.coalesce("trade_status", F.lit(""))
    insert, update = action.startswith("insert"), action.startswith("update:")
    src, paid = F.col("log_src"), F.coalesce("pay_status", F.lit(0)) == 2
    column = F.when(src == SETTLEMENT, "10").when((src == ORDER) & paid, "13").when((src == PAYMENT) & paid, "6")
    is_pay = (insert & (src == SETTLEMENT) & state.isin(*PAID_STATES)) | (update & F.array_contains(action_columns(action), column))
    as_int = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return df.withColumns({"is_new_generated": as_int(insert & ~state.isin(*CLOSED)), "is_pay": as_int(is_pay)})


def session_fields(df: DataFrame, cookie: str = "session") -> DataFrame:
    """ss and url_sn: parts 1 and 3 of the session cookie; without a cookie a hash of the view and 1, so retries agree."""
    parts = F.split(cookie, "_", -1)
    made = F.substring(F.md5(F.concat_ws("|", "uid_mid", "ts_ms", "url").cast("binary")), 1, 24)
    empty = F.coalesce(F.col(cookie), F.lit("")) == ""
    return df.withColumns({"ss": F.when(empty, made).otherwise(F.get(parts, F.lit(0))), "url_sn": F.when(empty, F.lit(1)).otherwise(F.get(parts, F.lit(2)).try_cast("int"))})


@dataclass(frozen=True)
class FieldRules:
    """For one output field: (group, pattern) in order; the first that is found wins."""

    source: str
    target: str
    rules: tuple[tuple[int, str], ...]


def regex_extract_fields(df: DataFrame, specs: list[FieldRules]) -> DataFrame:
    """Each target gets the group of the first pattern found in its source, '' if none is, and stays null without a source.

    Also <target>_rule: the number of the pattern, from one, or 0.
    """
    new: dict[str, Column] = {}
    for spec in specs:
        for group, pattern in spec.rules:  # a group that a pattern lacks would fail later, row by row
            if group > pattern.replace("\\(", "").count("(") - pattern.count("(?:"):
                raise ValueError(f"no group {group} in {pattern!r}")
        source = F.col(spec.source)
        value, rule = F.lit(""), F.lit(0)
        for k, (group, pattern) in reversed([*enumerate(spec.rules, 1)]):
            hit = source.rlike("(?i)" + pattern)
            value = F.when(hit, F.regexp_extract(source, "(?i)" + pattern, group)).otherwise(value)
            rule = F.when(hit, F.lit(k)).otherwise(rule)
        new |= {spec.target: F.when(source.isNotNull(), value), f"{spec.target}_rule": F.when(source.isNotNull(), rule)}
    return df.withColumns(new)


def flow_admission(flow: DataFrame, shop_seller: DataFrame) -> DataFrame:
    """Page views with a numeric item other than 0 of a shop that has a seller; seller_id is added."""
    item, shop = F.col("item_id").try_cast("bigint"), F.col("shop_id").try_cast("bigint")
    good = flow.filter(item.isNotNull() & (item != 0) & shop.isNotNull())
    return join_shop_seller(good.withColumns({"item_id": item, "shop_id": shop}), shop_seller)


def admission_reason(df: DataFrame) -> Column:
    """Why an order row is not admitted, or null. Presale rows need 'stepss:2' among their attributes."""
    seller = F.col("seller_id").try_cast("bigint")
    stepss = F.regexp_extract(F.coalesce("attributes", F.lit("")), "(?:^|;)stepss:([^;]*)", 1)
    biz = F.coalesce("biz_type", F.lit(0))
    neither = (F.coalesce("is_new_generated", F.lit(0)) != 1) & (paid_flag(df) != 1)
    return (
        F.when(biz == 800, "distribution")
        .when(seller.isNull() | (seller == 0), "seller")
        .when((biz == 10000) & (stepss != "2"), "presale")
        .when(neither, "neither")
    )


def paid_flag(df: DataFrame) -> Column:
    """is_pay; a presale row whose update holds column 32 counts as paid."""
    listed = F.array_contains(F.split(F.get(F.split("db_action", ":", -1), F.lit(1)), ","), "32")
    return F.when((F.coalesce("biz_type", F.lit(0)) == 10000) & F.coalesce(listed, F.lit(False)), 1).otherwise(F.coalesce("is_pay", F.lit(0)))


def order_admission(orders: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Admitted rows of enrolled sellers."""
    good = orders.withColumn("__why", admission_reason(orders)).withColumn("is_pay", paid_flag(orders)).filter(F.col("__why").isNull()).drop("__why")
    return join_enrolled_seller(good.withColumn("seller_id", F.col("seller_id").try_cast("bigint")), enrolled)


def slim(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def order_event_time(df: DataFrame, strict: bool = True) -> Column:
    """Paid rows' pay time, or else the time of change, or of creation. Not strict: whichever is there, '\\N' aside."""
    time = lambda c: F.try_to_timestamp(F.nullif(F.nullif(F.col(c), F.lit("")), F.lit("\\N")), F.lit("yyyy-MM-dd HH:mm:ss"))
    if strict:
        return F.coalesce(F.when(F.col("is_pay") == 1, time("pay_time")), time("gmt_modified"), time("gmt_create"))
    return F.coalesce(time("pay_time"), time("gmt_modified"), time("gmt_create"))


#: Bytes of a dimension, as text, up to which it is broadcast; larger ones are joined by a shuffle.
DIMENSION_BYTES = 64 << 20


def dimension(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its size, measured here in one pass, allows that."""
    if df.isStreaming:
        return df
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size.bytes <= DIMENSION_BYTES else df


def join_shop_seller(flow: DataFrame, shop_seller: DataFrame) -> DataFrame:
    return flow.join(dimension(shop_seller.select("shop_id", "seller_id")), "shop_id")


def join_enrolled_seller(orders: DataFrame, enrolled: DataFrame) -> DataFrame:
    return orders.join(dimension(enrolled.select("seller_id")), "seller_id", "left_semi")


def join_shop_info(flow: DataFrame, shops: DataFrame, require_enriched: bool = True) -> DataFrame:
    """Page views with user_id, shop_type, nick, unit_id and log_status of their shop."""
    info = dimension(shops.select("shop_id", "user_id", "shop_type", "nick", "unit_id"))
    out = flow.join(info, "shop_id", "inner" if require_enriched else "left").withColumn("log_status", F.when(F.col("unit_id").isNotNull(), "120"))
    return out.filter("unit_id > 0") if require_enriched else out


#: Bits of an address below the bin that ranges and addresses are joined on.
BIN_BITS = 16


def join_ip_location(df: DataFrame, ranges: DataFrame, ip: str = "ip_num") -> DataFrame:
    """location_id of the range that holds each address, ends included; 0 without one. Ranges do not overlap.

    Ranges are spread over the bins that they touch, so the join is an equi-join on the bin with a check of the ends.
    """
    binned = ranges.select("start_ip", "end_ip", "location_id", F.explode(F.sequence(F.shiftright("start_ip", BIN_BITS), F.shiftright("end_ip", BIN_BITS))).alias("__bin"))
    spread = dimension(binned)
    within = (F.shiftright(F.col(ip), BIN_BITS) == F.col("__bin")) & F.col(ip).between(F.col("start_ip"), F.col("end_ip"))
    out = df.drop("location_id").join(spread, within, "left").withColumn("location_id", F.coalesce("location_id", F.lit(0).cast("bigint")))
    return out.drop("__bin", "start_ip", "end_ip")
