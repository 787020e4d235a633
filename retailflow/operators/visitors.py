"""Returning visitors of shops, exact, from the days on which each visitor was seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RETURN_DAYS = 6


def visit_days(flow: DataFrame) -> DataFrame:
    return flow.filter("shop_id is not null and coalesce(visitor, '') <> ''").select("shop_id", "visitor", F.to_date("ts").alias("day")).distinct()


def return_visitor(flow: DataFrame, days: int = RETURN_DAYS) -> DataFrame:
    """dp_return: 1 if the visitor was on the shop on one of the days before, today aside; url_return: always 0."""
    before = F.lag("day").over(Window.partitionBy("shop_id", "visitor").orderBy("day"))
    flagged = visit_days(flow).withColumn("dp_return", F.coalesce((F.datediff("day", before) <= days).cast("int"), F.lit(0)))
    out = flow.withColumn("day", F.to_date("ts")).join(flagged, ["shop_id", "visitor", "day"], "left")
    return out.withColumns({"dp_return": F.coalesce("dp_return", F.lit(0)), "url_return": F.lit(0)})


def seen_before(flow: DataFrame, history: DataFrame) -> DataFrame:
    """Visits whose (shop, visitor) is in the history: an exact membership test."""
    return flow.join(history.select("shop_id", "visitor").distinct(), ["shop_id", "visitor"], "left_semi")


def new_to(flow: DataFrame, history: DataFrame) -> DataFrame:
    return flow.join(history.select("shop_id", "visitor").distinct(), ["shop_id", "visitor"], "left_anti")
