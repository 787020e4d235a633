"""Readers of logs. They take and return batch or streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mapping import map_fields
from ..functions.scalars import ip_to_dotted


def fields_of(lines: DataFrame, separator: str = "\x02", column: str = "value") -> DataFrame:
    """Lines that aren't empty, split at every separator of level one; trailing empty fields stay."""
    return lines.filter(F.length(column) > 0).withColumn("fields", F.split(column, "\\Q" + separator + "\\E", -1))


def read_delimited(spark: SparkSession, path: str, separator: str = "\x02", stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return fields_of(reader.text(path), separator)


def changelog(df: DataFrame, action_pos: int = 5, ts_unit: str = "ms") -> DataFrame:
    """Change rows with order_modified_t (ms, 0 without ':') and db_action; rows that delete are dropped.

    ts_unit 'us' reads microseconds. action_pos counts from one.
    """
    first = F.get("fields", F.lit(0))
    number = F.substring_index(first, ":", 1).try_cast("bigint")
    ts = F.when(F.instr(first, ":") > 0, number if ts_unit == "ms" else F.expr("try_cast(substring_index(get(fields, 0), ':', 1) as bigint) div 1000")).otherwise(F.lit(0).cast("bigint"))
    action = F.lower(F.get("fields", F.lit(action_pos - 1)))
    out = df.withColumns({"order_modified_t": F.coalesce(ts, F.lit(0).cast("bigint")), "db_action": action})
    return out.filter(F.coalesce(~F.startswith("db_action", F.lit("delete")), F.lit(True)))


def shop_id_of(column: Column) -> Column:
    """What follows '_' in a shop type mark, or null."""
    return F.when(F.instr(column, "_") > 0, F.nullif(F.substring_index(column, "_", -1), F.lit("")))


def normalise_pageviews(df: DataFrame) -> DataFrame:
    """Raw page views (time in s, ip as a number, at_shoptype, at_autype) with ts, dotted ip and shopid; none without a shop."""
    shop = F.coalesce(shop_id_of(F.col("at_shoptype")), shop_id_of(F.col("at_autype")))
    out = df.withColumns({"ts": F.col("time") * 1000, "ip": ip_to_dotted(F.col("ip")), "shopid": shop})
    return out.filter(F.col("shopid").isNotNull())


def route_by_tag(df: DataFrame, specs: dict[str, dict[str, str]], tag: str = "tag") -> DataFrame:
    """Rows of the tags named, each by its own mapping, in one table; other tags are left out."""
    out: DataFrame | None = None
    for name, spec in specs.items():
        part = map_fields(df.filter(F.col(tag) == name), spec, keep=(tag,))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tags to route")
    return out


def range_end(start_ms: int, end_ms: int, now_ms: int | None = None, lag_ms: int = 180_000, most_ms: int | None = None) -> int:
    """Where a scan ends: never nearer to now than lag, at most most_ms after its start."""
    return min(x for x in (end_ms, now_ms - lag_ms if now_ms is not None else None, start_ms + most_ms if most_ms is not None else None) if x is not None)


def scan_range(df: DataFrame, start_ms: int, end_ms: int, now_ms: int | None = None, lag_ms: int = 180_000, most_ms: int | None = None, shards: list[int] | None = None, ts: str = "ts_ms") -> DataFrame:
    """Rows with start <= ts < end, never nearer to now than lag, at most most_ms long; both filters reach the scan."""
    end = range_end(start_ms, end_ms, now_ms, lag_ms, most_ms)
    out = df.filter((F.col(ts) >= start_ms) & (F.col(ts) < end))
    return out.filter(F.col("shard").isin(shards)) if shards is not None else out


def scan_latest(df: DataFrame, now_ms: int, last_seconds: int, ts: str = "ts_ms") -> DataFrame:
    return scan_range(df, now_ms - 1000 * last_seconds, now_ms, ts=ts)


def by_log_time(df: DataFrame, first: int | None = None, ts: str = "ts_ms", key: str = "event_id") -> DataFrame:
    """All rows in the order of the log, or only the first so many; rows of one time are in the order of their key."""
    out = df.orderBy(ts, key)
    return out if first is None else out.limit(first)


def scan_prefix(df: DataFrame, company: int = 2, is_shop: int = 1, url_type: str = "4") -> DataFrame:
    """Item pages of shops of one company."""
    return df.filter((F.col("company") == company) & (F.col("is_shop") == is_shop) & (F.col("url_type") == url_type))


def read_header_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = "\x01", quote: str | None = None) -> DataFrame:
    """A file whose first line names its columns, cast to the types of schema; columns that it lacks are null."""
    raw = spark.read.csv(path, header=True, sep=separator, quote=quote or "\0")
    return typed(raw, schema)


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    there = set(raw.columns)
    return raw.select(*[(F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
