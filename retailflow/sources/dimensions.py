"""Readers of dimensions and of stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def active_shops(shops: DataFrame, now_s: int) -> DataFrame:
    """Shops that are active and whose days since init_time (s) have not run out."""
    good = (F.col("is_active") == 1) & (F.col("init_time") + F.col("days") * 86_400 > now_s)
    return shops.filter(good).select("shop_id", "nick", "shop_type", "user_id", "unit_id")


def shop_seller_map(lines: DataFrame, column: str = "value", order: str = "line_no") -> DataFrame:
    """'shopid-sellerid' lines as a table; of lines with the same shop the last wins."""
    parts = F.split(column, "-", -1)
    pairs = lines.filter(F.size(parts) == 2).select(F.get(parts, F.lit(0)).try_cast("bigint").alias("shop_id"), F.get(parts, F.lit(1)).try_cast("bigint").alias("seller_id"), order)
    good = pairs.filter(F.col("shop_id").isNotNull() & F.col("seller_id").isNotNull())
    return good.groupBy("shop_id").agg(F.max_by("seller_id", order).alias("seller_id"))


def ip_ranges(lines: DataFrame, column: str = "value", separator: str = "\x05") -> DataFrame:
    """Address ranges: parts 0 start, 1 end, 2 country, 4 province, 6 city, as numbers; location packs the last three."""
    part = lambda k: F.get(F.split(column, separator, -1), F.lit(k)).try_cast("bigint")
    out = lines.select(part(0).alias("start_ip"), part(1).alias("end_ip"), part(2).alias("country"), part(4).alias("province"), part(6).alias("city"))
    return out.dropna().withColumn("location_id", F.col("country") * 65536 + F.col("province") * 256 + F.col("city"))


def prior_shop_amounts(stored: DataFrame, day: int, base: int) -> DataFrame:
    """A day's stored amounts, to go on from, with the milestone that each has reached."""
    return stored.filter(F.col("dt") == day).withColumn("px", F.expr(f"amount div {base}"))


def prior_item_kpi(stored: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Stored indicators of the keys asked for; keys may repeat."""
    return stored.join(keys.select(*on).dropDuplicates(), on, "left_semi")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A dimension from a database. Credentials are options, never part of the library."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key's rows the one that is last by the order columns."""
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")
