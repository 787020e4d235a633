"""Orders rebuilt from parent, child and payment rows, with the paid total shared out over the children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.dimensions import latest_by_key


def line_value() -> Column:
    return F.col("price") * F.col("qty") - F.col("discount") + F.col("adjust")


def latest_children(children: DataFrame) -> DataFrame:
    """The most recent row of each child order."""
    return latest_by_key(children, ["order_id"], ["order_modified_t"])


def parents_with_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Rows of children with their parents' columns (p_*). A parent that is its own child stands for itself; rows that
    are neither parent nor child are left out."""
    named = [c for c in parents.columns if c != "order_id"]
    p = parents.filter((F.col("is_main") == 1) & (F.col("is_detail") == 0)).select(F.col("order_id").alias("parent_id"), *[F.col(c).alias(f"p_{c}") for c in named])
    joined = children.filter((F.col("is_main") == 0) & (F.col("is_detail") == 1)).join(p, "parent_id")
    both = children.filter((F.col("is_main") == 1) & (F.col("is_detail") == 1)).withColumn("parent_id", F.col("order_id"))
    alone = both.withColumns({f"p_{c}": F.col(c) if c in children.columns else F.lit(None) for c in named})
    return joined.unionByName(alone.select(*joined.columns))


def parents_with_latest_children(parents: DataFrame, versions: DataFrame) -> DataFrame:
    """The most recent row of each child order, with its parent's columns (p_*); children without a parent are left out."""
    p = parents.select(F.col("order_id").alias("parent_id"), *[F.col(c).alias(f"p_{c}") for c in parents.columns if c != "order_id"])
    return latest_children(versions).join(p, "parent_id")


def with_payment(children: DataFrame, payments: DataFrame, how: str = "left") -> DataFrame:
    """paid_total of each row's parent; 0 where no payment row is there (or, inner, no row)."""
    paid = payments.groupBy(F.col("order_id").alias("parent_id")).agg(F.max("actual_total_fee").alias("paid_total"))
    out = children.join(paid, "parent_id", how)
    return out.withColumn("paid_total", F.coalesce("paid_total", F.lit(0).cast("bigint")))


def order_completeness(children: DataFrame, expected: DataFrame) -> DataFrame:
    """Of each parent: children there, children expected, and whether all are there. expected: parent_id, n_expected."""
    there = children.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_children"))
    out = expected.join(there, "parent_id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    return out.withColumn("complete", F.col("n_children") >= F.col("n_expected"))


def order_fee_allocation(children: DataFrame, largest_remainder: bool = False) -> DataFrame:
    """share: the part of the parent's paid total that falls to a child, in proportion to its line value, cut to cents.

    The rest is lost, or, with largest_remainder, goes to the children with the largest cut-off parts. fee: the share, or
    for paid children with none the line value, else null.
    """
    by_parent = Window.partitionBy("parent_id")
    out = children.withColumn("line", line_value()).withColumn("lines", F.sum("line").over(by_parent))
    # exact beyond 64 bits; both decimals are truncated toward zero
    exact = F.expr("cast(paid_total as decimal(18,0)) * cast(line as decimal(18,0))")
    share = F.when(F.col("lines") != 0, F.expr("cast(cast(paid_total as decimal(18,0)) * cast(line as decimal(18,0)) div lines as bigint)")).otherwise(F.lit(0).cast("bigint"))
    out = out.withColumn("share", share)
    if largest_remainder:
        rest = F.col("paid_total") - F.sum("share").over(by_parent)
        cut = exact - F.col("share") * F.col("lines")
        place = F.row_number().over(by_parent.orderBy(cut.desc(), "order_id", "line_no"))
        out = out.withColumn("share", F.col("share") + F.when((F.col("lines") != 0) & (place <= rest), 1).otherwise(0))
    fee = F.when(F.col("pay_status") == 2, F.when(F.col("share") == 0, F.col("line")).otherwise(F.col("share")))
    return out.withColumn("fee", fee).drop("lines")


def parents_paid_or_children(rows: DataFrame, payments: DataFrame) -> DataFrame:
    """The variant without sharing: children pass; parents only with a payment row, whose fee replaces theirs if above 0."""
    children = rows.filter("is_main = 0 and is_detail = 1")
    paid = payments.groupBy("order_id").agg(F.max("actual_total_fee").alias("__paid"))
    parents = rows.filter("is_main = 1").filter(F.coalesce(F.col("pay_time") != "\\N", F.lit(True))).join(paid, "order_id")
    parents = parents.withColumn("actual_total_fee", F.when(F.col("__paid") > 0, F.col("__paid")).otherwise(F.col("actual_total_fee"))).drop("__paid")
    return parents.unionByName(children.select(*parents.columns))
