"""Sinks for batches and micro-batches, and upkeep of stored tables.

Tables are Parquet, partitioned by day (and hour). A write replaces the partitions that it touches, so a batch that is
written twice leaves the same rows; tables that batches are merged into keep the number of the last one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import shard_of, week_slot
from ..sources.stored import VersionedTable

Sink = Callable[[DataFrame, int], None]


def with_log_key(df: DataFrame, kind: str = "flow", ts: str = "ts_ms") -> DataFrame:
    """shard and slot of each record; rows whose visitor or buyer can't be told are left out."""
    owner, bad = ("puid", (":", ":-")) if kind == "flow" else ("buyer_id", ("0", "-"))
    good = df.filter(F.col(owner).isNotNull() & ~F.col(owner).isin(*bad))
    return good.withColumns({"shard": shard_of(F.col(owner)), "slot": week_slot(F.col(ts))})


def order_index(df: DataFrame, kind: str = "child") -> DataFrame:
    """Lookup rows: children by parent ('0' has none), payments by order."""
    if kind == "child":
        good = df.filter(F.coalesce(F.col("parent_id").cast("string"), F.lit("0")) != "0")
        return good.select(shard_of(F.col("parent_id")).alias("shard"), F.col("parent_id").alias("index_key"), F.col("order_id").alias("primary_key"))
    return df.select(shard_of(F.col("order_id")).alias("shard"), F.col("order_id").alias("index_key"), F.col("order_id").alias("primary_key"))


def routed(df: DataFrame, routes: dict[str, str], by: str = "dest_type") -> DataFrame:
    """Rows with the table that their type goes to; types without one are left out."""
    target = F.coalesce(*[F.when(F.col(by) == t, F.lit(name)) for t, name in routes.items()])
    return df.withColumn("target", target).filter(F.col("target").isNotNull())


def route_write(root: str, routes: dict[str, str], by: str = "dest_type", partition: str = "dt") -> Sink:
    """A sink that writes each record to the table of its type, one write for all tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = routed(batch, routes, by).withColumn("batch", F.lit(batch_id))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("target", partition, "batch").parquet(root)

    return write


def route_stored(spark: SparkSession, root: str) -> DataFrame:
    """All rows that route_write has put, with their `target`; each batch is there once."""
    return spark.read.parquet(root).drop("batch")


@dataclass(frozen=True)
class Subscriber:
    name: str
    condition: str = "true"
    columns: tuple[str, ...] = ()
    enabled: bool = True


def fan_out(df: DataFrame, subscribers: list[Subscriber]) -> dict[str, DataFrame]:
    """What each subscriber that is enabled gets: the rows that its Spark SQL condition holds for, and its columns."""
    return {s.name: df.filter(F.expr(s.condition)).select(*(s.columns or df.columns)) for s in subscribers if s.enabled}


def fan_out_write(root: str, subscribers: list[Subscriber]) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # several filters read one micro-batch
        try:
            for name, part in fan_out(kept, subscribers).items():
                part.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
        finally:
            kept.unpersist()

    return write


def text_dump(df: DataFrame, columns: list[str], unit_id: int | None = None, separator: str = '"') -> DataFrame:
    """Rows as lines, of one unit if named; nulls are empty."""
    some = df if unit_id is None else df.filter(F.col("unit_id") == unit_id)
    return some.select(F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))


def range_dump(df: DataFrame, path: str, start_ms: int, end_ms: int, ts: str = "ts_ms", most_rows: int = 10_000_000) -> None:
    df.filter((F.col(ts) >= start_ms) & (F.col(ts) < end_ms)).write.option("maxRecordsPerFile", most_rows).parquet(path)


def put(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_write(path: str, keys: list[str], partition: str, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> Sink:
    """A sink that puts rows by key, or combines them with those stored, in the partitions of a batch alone.

    The table is a VersionedTable: readers see all of a batch or nothing, a batch that was written is not written again,
    and what neither the last state nor the one before it uses is removed. The names of partitions reach the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, path, partition)
        before = table.manifest()
        after = table.put(batch, keys, combine, "sink", batch_id)
        table.vacuum(parts=[p for p in {*before.parts} | {*after.parts} if before.parts.get(p) != after.parts.get(p)])

    return write


def shop_upsert_write(path: str, base: int) -> Sink:
    """A sink of paid amounts (dt, seller_id, amount, last_ts) that are added to each seller's total of the day.

    Totals are in `totals`; `history` gets a row for each batch in which a total passes a further multiple of base.
    A batch that is written twice counts once in both.
    """

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        before = old.select("dt", "seller_id", F.col("amount").alias("a"), F.col("last_ts").alias("t"), "px")
        more = new.select("dt", "seller_id", F.col("amount").alias("b"), F.col("last_ts").alias("u"))
        both = before.join(more, ["dt", "seller_id"], "full")
        amount = (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).cast("bigint").alias("amount")
        both = both.select("dt", "seller_id", amount, F.greatest("t", "u").alias("last_ts"), F.coalesce("px", F.lit(0)).cast("bigint").alias("before"))
        return both.select("dt", "seller_id", "amount", "last_ts", F.expr(f"amount div {base}").alias("px"), "before")

    put_totals = upsert_write(f"{path}/totals", ["dt", "seller_id"], "dt", combine)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, none = batch.sparkSession, F.lit(None).cast("bigint")
        put_totals(batch.select("dt", "seller_id", "amount", "last_ts", none.alias("px"), none.alias("before")), batch_id)
        # what the batch wrote is the live version that has the last state's number
        table = VersionedTable(spark, f"{path}/totals")
        now = table.manifest()
        if now.batches.get("sink") != batch_id:
            return  # later batches are there: this one's history is, too
        newest = [p for p, v in now.parts.items() if v == now.seq]
        if newest:
            passed = table.live(newest, manifest=now).filter(F.col("px") > F.col("before"))
            passed.select("dt", "seller_id", "amount", "last_ts", "px").write.mode("overwrite").parquet(f"{path}/history/batch={batch_id}")

    return write


def current(versions: DataFrame) -> DataFrame:
    """The latest version of each partition, from a table's files alone. `VersionedTable.live` reads what is live, and no more."""
    last = versions.groupBy("part").agg(F.max("v").alias("v"))
    return versions.join(last, ["part", "v"], "left_semi")


def apply_retention(df: DataFrame, days: int, today: Column, day: str = "dt") -> DataFrame:
    """Rows of the last days; on a table partitioned by day the filter reads those partitions alone."""
    return df.filter(F.col(day) > F.date_sub(today, days))


def count_rows(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(F.expr(condition)).agg(F.count(F.lit(1)).alias("n"))


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is not true."""
    return df.filter(~F.coalesce(F.expr(condition), F.lit(False)))
