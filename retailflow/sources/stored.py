"""Stored tables: a log laid out by time slot and shard, order tables in buckets, and tables of versions with a manifest.

A log is read by range of time, by shards and by leading columns: the first two are partitions, so other files are not
opened, and rows are sorted by the third within files, so that row groups are skipped. Order tables share buckets of the
parent's id, so that they are joined where they lie. A versioned table replaces whole partitions; what is live is one small
file, put in place by a rename, so readers see all of a write or nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import SHARDS, WEEK_SECONDS, adjust_end
from . import logs

#: Rows of a bucket, and the least number of buckets of tables that are laid out for so many rows.
BUCKET_ROWS, LEAST_BUCKETS = 500_000, 8

#: Slots of a range up to which a scan lists their folders alone; a longer range lists the table.
LISTED_SLOTS = 1_000


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _there(spark: SparkSession, path: str) -> bool:
    files, where = _hadoop(spark, path)
    return files.exists(where)


# ---- a log by slot and shard


@dataclass(frozen=True)
class StoredLog:
    """slot_s: seconds of a time slot; parts: folders that the shards of a slot are dealt to; order: how rows lie in files."""

    spark: SparkSession
    path: str
    slot_s: int = 3_600
    parts: int = SHARDS
    order: tuple[str, ...] = ("company", "is_shop", "url_type", "puid")
    ts: str = "ts_ms"

    def write(self, keyed: DataFrame, mode: str = "append") -> None:
        """keyed: rows with `shard` and a time (ms). A slot's hot shard is split over tasks and files."""
        if {"part_of_slot", "slot_of_time"} & {*keyed.columns}:
            raise ValueError("part_of_slot and slot_of_time are columns of the layout")
        slotted = keyed.withColumns({"slot_of_time": F.expr(f"floor({self.ts} / {1000 * self.slot_s})"), "part_of_slot": F.pmod("shard", F.lit(self.parts))})
        dealt = slotted.hint("rebalance", "slot_of_time", "part_of_slot")
        inner = [c for c in self.order if c in keyed.columns]
        dealt.sortWithinPartitions("slot_of_time", "part_of_slot", *inner, self.ts).write.mode(mode).partitionBy("slot_of_time", "part_of_slot").parquet(self.path)

    def _folders(self, first: int, last: int) -> list[str]:
        """Folders of slots first to last that are there."""
        return [p for p in (f"{self.path}/slot_of_time={s}" for s in range(first, last + 1)) if _there(self.spark, p)]

    def scan_range(self, start_ms: int, end_ms: int, now_ms: int | None = None, lag_ms: int = 180_000, most_ms: int | None = None, shards: list[int] | None = None) -> DataFrame:
        """Rows with start <= ts < end, never nearer to now than lag, most_ms long at most, of all shards or some."""
        end = logs.range_end(start_ms, end_ms, now_ms, lag_ms, most_ms)
        first, last = start_ms // (1000 * self.slot_s), (end - 1) // (1000 * self.slot_s)
        whole = self.spark.read.parquet(self.path)
        if last < first:
            return whole.filter("false").drop("slot_of_time", "part_of_slot")
        rows = whole
        if last - first < LISTED_SLOTS:
            folders = self._folders(first, last)
            if not folders:
                return whole.filter("false").drop("slot_of_time", "part_of_slot")
            rows = self.spark.read.schema(whole.schema).option("basePath", self.path).parquet(*folders)
        rows = rows.filter(F.col("slot_of_time").between(first, last))
        if shards is not None:
            rows = rows.filter(F.col("part_of_slot").isin(sorted({s % self.parts for s in shards})))
        return logs.scan_range(rows, start_ms, end, shards=shards, ts=self.ts).drop("slot_of_time", "part_of_slot")

    def scan_latest(self, now_ms: int, last_seconds: int, lag_ms: int = 180_000, shards: list[int] | None = None) -> DataFrame:
        return self.scan_range(now_ms - 1000 * last_seconds, now_ms, now_ms, lag_ms, shards=shards)

    def scan_week_slots(self, start: int, end: int, now_ms: int, shards: list[int] | None = None) -> DataFrame:
        """Rows of the seconds start to end of a week, the last such before now; the end of the week ends the range."""
        now_s = now_ms // 1000
        week = now_s - now_s % WEEK_SECONDS
        week -= WEEK_SECONDS * (week + start > now_s)
        return self.scan_range(1000 * (week + start), 1000 * (week + adjust_end(start, end)), now_ms, 0, shards=shards)

    def scan_prefix(self, start_ms: int | None = None, end_ms: int | None = None, shards: list[int] | None = None, **equal: object) -> DataFrame:
        """Rows, of a range or of all times, whose leading columns have some values; the filters reach the files, which are
        sorted by them."""
        if start_ms is None or end_ms is None:
            rows = self.spark.read.parquet(self.path)
            if shards is not None:
                rows = rows.filter(F.col("part_of_slot").isin(sorted({s % self.parts for s in shards})) & F.col("shard").isin(shards))
            rows = rows.drop("slot_of_time", "part_of_slot")
        else:
            rows = self.scan_range(start_ms, end_ms, shards=shards)
        for name, value in equal.items():
            rows = rows.filter(F.col(name) == value)
        return rows

    def drop_before(self, oldest_ms: int) -> list[int]:
        """Removes the slots that are over before a time; returns them. Only folders are listed."""
        if not _there(self.spark, self.path):
            return []
        files, where = _hadoop(self.spark, self.path)
        slots = [int(s.getPath().getName().partition("=")[2]) for s in files.listStatus(where) if s.getPath().getName().startswith("slot_of_time=")]
        old = sorted(s for s in slots if (s + 1) * self.slot_s * 1000 <= oldest_ms)
        for s in old:
            files.delete(_hadoop(self.spark, f"{self.path}/slot_of_time={s}")[1], True)
        return old


# ---- orders in buckets


@dataclass
class OrderTables:
    """Parents, children and payments in buckets of the order's id (the parent's, for children)."""

    spark: SparkSession
    path: str
    buckets: int = 64
    name: str = field(default_factory=lambda: f"orders_{uuid.uuid4().hex}")

    KEYS = {"parents": "order_id", "children": "parent_id", "payments": "order_id"}

    @classmethod
    def of_rows(cls, spark: SparkSession, path: str, rows: int) -> OrderTables:
        """Tables with as many buckets as the largest of them needs: a bucket is read by one task, and is not to grow with the rows."""
        return cls(spark, path, buckets=max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))

    def write(self, **tables: DataFrame) -> None:
        """Each table sorted in its buckets, one file a bucket. Ids are kept as text, so that equal ones share a bucket."""
        for table, rows in tables.items():
            key = self.KEYS[table]
            typed = rows.withColumn(key, F.col(key).cast("string"))
            writer = typed.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key).format("parquet")
            writer.mode("overwrite").option("path", f"{self.path}/{table}").saveAsTable(f"{self.name}_{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.table(f"{self.name}_{table}")

    def children_of(self, keys: list[str]) -> DataFrame:
        """Children of some parents: the buckets of these ids are read alone."""
        return self.read("children").filter(F.col("parent_id").isin([str(k) for k in keys]))

    def index(self) -> DataFrame:
        """The lookup rows: a parent's id and the ids of its children."""
        from ..operators.sinks import order_index

        return order_index(self.read("children"))

    def parents_with_children(self) -> DataFrame:
        """As orders.parents_with_children, without a shuffle."""
        from ..operators.orders import parents_with_children

        return parents_with_children(self.read("parents").hint("merge"), self.read("children"))

    def children_with_payment(self) -> DataFrame:
        """Children with their parent's paid total, without a shuffle: payments are summed and joined in their buckets."""
        from ..operators.orders import with_payment

        return with_payment(self.read("children").hint("merge"), self.read("payments"))

    def drop(self) -> None:
        for table in self.KEYS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")


# ---- partitions in versions


class Conflict(RuntimeError):
    """Another writer was first."""


@dataclass(frozen=True)
class Manifest:
    """seq: number of the state; parts: live version of each partition; batches: last batch of each writer."""

    seq: int = 0
    parts: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


NULL_PART = "__null__"


@dataclass(frozen=True)
class VersionedTable:
    """A table of partitions (`part`, from a column's text), each in versions; one is live. The names of all partitions are in the
    manifest, which the driver reads: days or hours, for instance."""

    spark: SparkSession
    path: str
    partition: str = "dt"

    def _manifests(self) -> list[int]:
        files, where = _hadoop(self.spark, f"{self.path}/_manifest")
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def manifest(self) -> Manifest:
        seqs = self._manifests()
        if not seqs:
            return Manifest()
        return self._state(seqs[-1])

    def _commit(self, old: Manifest, changes: dict[str, int | None], writer: str = "", batch: int | None = None) -> Manifest:
        """The next state. A file of that number that is there already is another writer's, and nothing is changed."""
        parts = {p: v for p, v in (old.parts | changes).items() if v is not None}
        new = Manifest(old.seq + 1, parts, old.batches | ({writer: batch} if batch is not None else {}))
        files, folder = _hadoop(self.spark, f"{self.path}/_manifest")
        files.mkdirs(folder)
        jvm = self.spark.sparkContext._jvm
        draft, final = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(folder, f"{new.seq:012d}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps({"seq": new.seq, "parts": new.parts, "batches": new.batches}).encode()))
        out.close()
        kinds = jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(kinds, 1)
        none[0] = kinds.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(final), none)
        except Exception as e:
            files.delete(draft, False)
            if files.exists(final):
                raise Conflict(f"state {new.seq} is another writer's") from e
            raise
        return new

    def _folder(self, part: str, version: int) -> str:
        escaped = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        name = escaped.DEFAULT_PARTITION_NAME() if part == NULL_PART else escaped.escapePathName(part)
        return f"{self.path}/part={name}/v={version}"

    def live(self, parts: Iterable[str] | None = None, schema: T.StructType | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Rows of the live versions, of all partitions or some; only their folders are listed. schema: of an empty table."""
        now = (manifest or self.manifest()).parts
        chosen = sorted({*now} if parts is None else {*parts} & {*now})
        if not chosen:
            if schema is not None:
                return self.spark.createDataFrame([], schema)
            if not now:
                raise ValueError("the table has no partition yet, so its columns are not known")
            return self.live([min(now)], manifest=manifest).limit(0)
        reader = self.spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(T.StructType([f for f in schema if f.name not in ("part", "v")]))
        return reader.parquet(*[self._folder(p, now[p]) for p in chosen]).drop("part", "v")

    def put(self, new: DataFrame, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, writer: str = "", batch: int | None = None) -> Manifest:
        """Puts rows by key, or combines them with those stored, in the partitions that they touch. A batch of a writer that
        was put before is not put again. `new` is computed once."""
        if {"part", "v"} & {*new.columns}:
            raise ValueError("part and v are columns of the layout")
        old = self.manifest()
        if batch is not None and batch <= old.batches.get(writer, -1):
            return old
        kept = new.withColumn("part", F.coalesce(F.col(self.partition).cast("string"), F.lit(NULL_PART))).persist()
        try:
            touched = [r.part for r in kept.select("part").distinct().collect()]
            before = self.live(touched, new.schema, old)
            rows = kept.drop("part")
            both = combine(before, rows) if combine else before.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)
            return self._replace(old, both, touched, writer, batch)
        finally:
            kept.unpersist()

    def _replace(self, old: Manifest, rows: DataFrame, touched: list[str], writer: str = "", batch: int | None = None) -> Manifest:
        """New versions of some partitions; those that end up without rows go."""
        version = old.seq + 1
        null = F.col(self.partition).isNull()
        out = rows.withColumns({"part": F.when(~null, F.col(self.partition).cast("string")), "v": F.lit(version).cast("bigint")})
        # a writer that was cut off may have left files of this number: each partition's folder is written anew
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "v").parquet(self.path)
        return self._commit(old, {p: version if _there(self.spark, self._folder(p, version)) else None for p in touched}, writer, batch)

    def delete(self, condition: str, parts: Iterable[str] | None = None) -> Manifest:
        """Removes the rows for which a condition is true, in all partitions or some. Others are not touched."""
        old = self.manifest()
        chosen = sorted({*old.parts} if parts is None else {*parts} & {*old.parts})
        if not chosen:
            return old
        rows = self.live(chosen, manifest=old)
        hit = rows.filter(F.expr(condition)).select(F.coalesce(F.col(self.partition).cast("string"), F.lit(NULL_PART)).alias("part")).distinct()
        touched = [r.part for r in hit.collect()]
        if not touched:
            return old
        left = self.live(touched, manifest=old).filter(~F.coalesce(F.expr(condition), F.lit(False)))
        return self._replace(old, left, touched)

    def drop_parts(self, gone: Callable[[str], bool]) -> Manifest:
        """Takes whole partitions out of the table, by name; no file is read."""
        old = self.manifest()
        changes = {p: None for p in old.parts if p != NULL_PART and gone(p)}
        return self._commit(old, changes) if changes else old

    def retain(self, days: int, today: str) -> Manifest:
        """Keeps the partitions of the last days; partitions are named by day (yyyy-mm-dd)."""
        from datetime import date, timedelta

        limit = (date.fromisoformat(today) - timedelta(days=days)).isoformat()
        return self.drop_parts(lambda p: p[:10] <= limit)

    def _state(self, seq: int) -> Manifest:
        return Manifest(**json.loads(self.spark.read.text(f"{self.path}/_manifest/{seq:012d}.json", wholetext=True).first()[0]))

    def vacuum(self, keep: int = 1, parts: Iterable[str] | None = None) -> int:
        """Removes versions, of all partitions or some, that neither the live state nor the `keep` states before it use, and
        still older states. Readers that began that many writes ago may miss files. Returns how many versions went."""
        seqs = self._manifests()
        used = {(p, v) for seq in seqs[-1 - keep :] for p, v in self._state(seq).parts.items()}
        files, root = _hadoop(self.spark, self.path)
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        if parts is None:
            found = [f.getPath().getName() for f in files.listStatus(root)] if files.exists(root) else []
            found = [f.removeprefix("part=") for f in found if f.startswith("part=")]
            parts = [NULL_PART if f == names.DEFAULT_PARTITION_NAME() else names.unescapePathName(f) for f in found]
        n = 0
        for part in parts:
            folder = _hadoop(self.spark, self._folder(part, 0))[1].getParent()
            for version in files.listStatus(folder) if files.exists(folder) else []:
                number = int(version.getPath().getName().removeprefix("v="))
                if (part, number) not in used and number <= (seqs or [0])[-1]:  # a greater one may be a write at work
                    files.delete(version.getPath(), True)
                    n += 1
        for seq in seqs[: -1 - keep]:
            files.delete(_hadoop(self.spark, f"{self.path}/_manifest/{seq:012d}.json")[1], False)
        return n
