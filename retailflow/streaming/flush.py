"""Stores that are written at intervals which follow the backlog, readers that go on from stored positions, and dimensions
whose rows hold from a time on."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.scalars import SHARDS
from ..sources.stored import StoredLog, VersionedTable, _hadoop, _there

#: Seconds between flushes, with a backlog and without, and how many snapshots must wait to widen and narrow them.
NARROW_S, WIDE_S, WIDEN_ABOVE, NARROW_BELOW = 60, 180, 40, 20


class Backlog(StreamingQueryListener):
    """How far a query is behind its source: the offsets that sources say are not read yet (as Kafka does), or else the
    micro-batches that took longer than the time between them, one after the other."""

    def __init__(self, interval_s: float = NARROW_S) -> None:
        self.interval_s, self.slow, self.behind, self.rows = interval_s, 0, 0, 0

    def onQueryStarted(self, event) -> None:
        self.slow = self.behind = 0

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += p.numInputRows
        self.slow = self.slow + 1 if p.batchDuration > 1000 * self.interval_s else 0
        self.behind = max([int(float((s.metrics or {}).get("maxOffsetsBehindLatest", 0))) for s in p.sources] or [0])

    def onQueryIdle(self, event) -> None:
        self.slow = self.behind = 0

    def onQueryTerminated(self, event) -> None:
        pass

    def waiting(self) -> int:
        return max(self.slow, self.behind)


@dataclass
class BacklogFlush:
    """A sink that keeps each micro-batch's snapshot (keys with their totals so far) aside, and puts the last snapshot of
    each key into a stored table when a flush is due.

    A flush is due `narrow_s` after the last one, or `wide_s` while there is a backlog: from when more than `widen_above`
    wait until fewer than `narrow_below` do. waiting: what waits outside, such as Backlog.waiting; snapshots put aside
    count with it. Snapshots are kept by batch id, and the table knows its last batch, so nothing counts twice.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    partition: str = "dt"
    waiting: Callable[[], int] = lambda: 0
    clock: Callable[[], float] = time.time
    narrow_s: float = NARROW_S
    wide_s: float = WIDE_S
    widen_above: int = WIDEN_ABOVE
    narrow_below: int = NARROW_BELOW
    wide: bool = False
    last: float | None = None
    flushes: list[tuple[float, float, int]] = field(default_factory=list)  # when, interval, snapshots

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/table", self.partition)

    def _aside(self) -> list[int]:
        if not _there(self.spark, f"{self.path}/aside"):
            return []
        files, where = _hadoop(self.spark, f"{self.path}/aside")
        names = [s.getPath().getName() for s in files.listStatus(where)]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def interval(self) -> float:
        n = self.waiting() + len(self._aside())
        self.wide = n > self.widen_above or (self.wide and n >= self.narrow_below)
        return self.wide_s if self.wide else self.narrow_s

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/aside/batch={batch_id}")
        now, due = self.clock(), self.interval()
        if self.last is None:
            self.last = now - due  # the first snapshot is put at once
        if now - self.last >= due:
            self.flush(now, due)

    def flush(self, now: float | None = None, interval: float = 0) -> None:
        """Puts what is aside, whenever it was due."""
        batches = self._aside()
        if not batches:
            return
        self.last = self.clock() if now is None else now
        rows = self.spark.read.option("basePath", f"{self.path}/aside").parquet(*[f"{self.path}/aside/batch={b}" for b in batches])
        rest = [c for c in rows.columns if c not in (*self.keys, "batch")]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*self.keys, "last.*")
        self.table.put(newest, self.keys, writer="flush", batch=batches[-1])
        files, _ = _hadoop(self.spark, self.path)
        for b in batches:
            files.delete(_hadoop(self.spark, f"{self.path}/aside/batch={b}")[1], True)
        self.flushes.append((self.last, interval, len(batches)))


# ---- going on from stored positions

#: How far before its position a shard is read again, as rows may come that much out of order.
OVERLAP_MS = 60_000


@dataclass(frozen=True)
class PositionedReader:
    """Reads a stored log pull by pull. Of each shard it keeps the last rows that were delivered, from `overlap_ms` before
    the last of them on: its position, and what must not be delivered again when the overlap is read once more.

    A pull delivers rows to a sink under the number of the state that it leads to, then the state moves on in one step. A
    run that is killed in between delivers the same pull again, under the same number.
    """

    log: StoredLog
    path: str
    key: str = "event_id"
    overlap_ms: int = OVERLAP_MS
    start_ms: int = 0
    shards: int = SHARDS

    @property
    def state(self) -> VersionedTable:
        return VersionedTable(self.log.spark, f"{self.path}/positions", "shard")

    def positions(self) -> DataFrame:
        """shard and the time of the last row delivered; as many rows as there are shards."""
        return self._recent().groupBy("shard").agg(F.max("ts").alias("position"))

    def _recent(self) -> DataFrame:
        schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("ts", T.LongType()), T.StructField("id", T.LongType())])
        return self.state.live(schema=schema)

    def pull(self, now_ms: int, deliver: Callable[[DataFrame, int], None], lag_ms: int = 180_000) -> int:
        """Delivers what is new up to lag_ms before now; returns the number that it was delivered under."""
        now = self.state.manifest()
        recent, at = self._recent(), self.positions()
        known = {r.shard: r.position for r in at.collect()}
        # a shard without a position may have rows from the start on
        start = max(self.start_ms, min(known.values()) - self.overlap_ms) if len(known) == self.shards else self.start_ms
        ts, n = self.log.ts, now.seq + 1
        rows = self.log.scan_range(start, now_ms, now_ms, lag_ms).join(F.broadcast(at), "shard", "left")
        rows = rows.filter(F.col("position").isNull() | (F.col(ts) >= F.col("position") - self.overlap_ms)).drop("position")
        seen = recent.select("shard", F.col("id").alias(self.key))
        fresh = rows.join(seen, ["shard", self.key], "left_anti").persist()
        try:
            deliver(fresh, n)
            ends = fresh.select("shard", F.col(ts).alias("ts"), F.col(self.key).alias("id"))

            def newest(old: DataFrame, new: DataFrame) -> DataFrame:
                both = old.select("shard", "ts", "id").unionByName(new.select("shard", "ts", "id"))
                last = both.groupBy("shard").agg(F.max("ts").alias("last"))
                return both.join(F.broadcast(last), "shard").filter(F.col("ts") >= F.col("last") - self.overlap_ms).select("shard", "ts", "id")

            if not fresh.isEmpty():
                self.state.put(ends, ["shard", "id"], newest)
                self.state.vacuum()
        finally:
            fresh.unpersist()
        return n


# ---- dimensions whose rows hold from a time on


@dataclass(frozen=True)
class DimensionHistory:
    """Versions of a dimension: each row holds from `valid_from` until its key's next version, or until it is gone.

    load() takes a new version in, with only the rows that are new, changed or gone; an empty one is not taken, as a
    reload that fails looks like that.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, "valid_from")

    def current(self, schema: T.StructType | None = None) -> DataFrame:
        """The rows that hold last."""
        rest = [c for c in (schema.names if schema is not None else self.table.live().columns) if c not in (*self.keys, "valid_from", "is_gone")]
        last = self.table.live(schema=schema).groupBy(*self.keys).agg(F.max_by(F.struct("is_gone", *rest), "valid_from").alias("last"))
        return last.filter("not last.is_gone").select(*self.keys, *[f"last.{c}" for c in rest])

    def load(self, rows: DataFrame, valid_from: str) -> bool:
        """valid_from: a time as text ('yyyy-MM-dd HH:mm:ss'), after those of earlier versions."""
        if rows.isEmpty():
            return False
        rest = [c for c in rows.columns if c not in self.keys]
        marked = rows.select(*self.keys, *rest, F.lit(valid_from).alias("valid_from"), F.lit(False).alias("is_gone"))
        before = self.current(marked.schema)
        on = [rows[c].eqNullSafe(before[c]) for c in (*self.keys, *rest)]
        changed = rows.join(before, on, "left_anti").select(*self.keys, *rest, F.lit(valid_from).alias("valid_from"), F.lit(False).alias("is_gone"))
        gone = before.join(rows.select(*self.keys), list(self.keys), "left_anti").select(*self.keys, *rest, F.lit(valid_from).alias("valid_from"), F.lit(True).alias("is_gone"))
        self.table.put(changed.unionByName(gone), [*self.keys, "valid_from"])
        return True

    def periods(self) -> DataFrame:
        """Rows with valid_from and valid_to (text; null: still holds)."""
        from pyspark.sql import Window

        following = F.lead("valid_from").over(Window.partitionBy(*self.keys).orderBy("valid_from"))
        return self.table.live().withColumn("valid_to", following).filter("not is_gone").drop("is_gone")

    def join(self, df: DataFrame, ts: str = "ts") -> DataFrame:
        """df with the columns of the dimension as they held at each row's time; rows without any are left out."""
        at = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
        held = self.periods()
        inside = (F.col("valid_from") <= F.col("__at")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to")))
        return df.withColumn("__at", at).join(held, list(self.keys)).filter(inside).drop("__at", "valid_from", "valid_to")
