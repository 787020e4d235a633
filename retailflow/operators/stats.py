"""Counts about the data that goes through: routes, rules, admission, throughput, error lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def route_stats(df: DataFrame, payload: Column, ts: str = "ts_ms", by: str = "dest_type") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(payload)).alias("n_bytes"), F.max(ts).alias("last_ts"))


def rule_hit_stats(df: DataFrame, rule: str) -> DataFrame:
    return df.groupBy(F.col(rule).alias("rule")).agg(F.count(F.lit(1)).alias("hits"))


def admission_stats(df: DataFrame, reason: Column, is_pay: Column) -> DataFrame:
    """One row: discarded rows, and admitted ones that are new or paid."""
    dropped = reason.isNotNull()
    return df.agg(
        F.count_if(dropped).alias("discarded"),
        F.count_if(~dropped & (F.col("is_new_generated") == 1)).alias("new_emitted"),
        F.count_if(~dropped & (is_pay == 1)).alias("paid_emitted"),
    )


def throughput_stats(df: DataFrame, every: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Rows in each period that has any, rows a second, and seconds without a period since the one before."""
    w = F.window(ts, every)
    counted = df.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("period"), F.col("w.end").alias("until"), "n")
    # one row for each period: a few thousand a year
    gap = F.unix_seconds("period") - F.unix_seconds(F.lag("until").over(Window.orderBy("period")))
    return counted.withColumns({"per_second": F.col("n") / (F.unix_seconds("until") - F.unix_seconds("period")), "stalled_s": F.coalesce(gap, F.lit(0).cast("bigint"))}).drop("until")


def with_context(lines: DataFrame, context: int = 8, block: int = 100_000) -> DataFrame:
    """Each line with its host's lines before it. The lines of a host are split into blocks by number, so that one host's
    lines are sorted by many tasks; the last lines before a block are copied to it.
    """
    own = lines.select("host", F.expr(f"line_no div {block}").alias("block"), "line_no", "ts", "level", "message")
    last = Window.partitionBy("host", "block").orderBy(F.col("line_no").desc())
    tails = own.withColumn("n", F.row_number().over(last)).filter(F.col("n") <= context)
    tails = tails.groupBy("host", "block").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "message"))).alias("tail"))
    # one row for each block; a block has a line at least, so that as many blocks hold all lines needed
    earlier = F.flatten(F.collect_list("tail").over(Window.partitionBy("host").orderBy("block").rowsBetween(-max(context, 1), -1)))
    copied = tails.withColumn("earlier", earlier).select("host", "block", F.posexplode(F.slice("earlier", F.greatest(F.size("earlier") - context, F.lit(0)) + 1, context)).alias("place", "line"))
    copied = copied.select("host", "block", F.lit(0).alias("is_own"), F.col("place").cast("bigint").alias("place"), F.col("line.message").alias("message"))
    both = own.withColumns({"is_own": F.lit(1), "place": F.col("line_no").cast("bigint")}).unionByName(copied, allowMissingColumns=True)
    before = Window.partitionBy("host", "block").orderBy("is_own", "place").rowsBetween(-context, 0)
    return both.withColumn("context", F.array_join(F.collect_list("message").over(before), "\n")).filter("is_own = 1").drop("block", "is_own", "place")


def error_log_stats(lines: DataFrame, now_s: int, marker: str, level: str = "ERROR", last_s: int = 600, context: int = 8, block: int = 100_000, context_s: int | None = None) -> DataFrame:
    """Error lines of the last seconds that hold a marker: their number by host, and the first with the lines before it.

    lines: host, line_no, ts (s), level, message. context_s: if given, older lines than so many seconds before those are
    dropped before any are sorted, and a context ends there.
    """
    recent = lines if context_s is None else lines.filter(F.col("ts") > now_s - last_s - context_s)
    found = with_context(recent, context, block)
    found = found.filter((F.col("level") == level) & F.col("message").contains(marker) & (F.col("ts") > now_s - last_s))
    return found.groupBy("host").agg(F.count(F.lit(1)).alias("n_errors"), F.min_by("context", "line_no").alias("first_context"))
