"""Streaming operators with state of their own: return flags of visitors, and child orders that wait for their parents.

State is per key, in Spark's RocksDB store, so that it may outgrow memory; event-time timers end it. What a task holds in
memory is one key's state and, for return flags, the numbers of its rows of one micro-batch.
"""

from __future__ import annotations

import contextlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.visitors import RETURN_DAYS

DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Children of one parent that may wait at a time, and how long they do (ms of event time).
MOST_WAITING, WAIT_MS = 10_000, 60_000


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, which state variables and timers need."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class ReturnFlags(StatefulProcessor):
    """The days of the last week on which a visitor was on a shop; a timer ends them when they are too old to count."""

    def __init__(self, days: int = RETURN_DAYS) -> None:
        self.n_days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("days", "days array<int>")

    def _keep(self, days: set[int], today: int, stored: tuple | None) -> None:
        """Days that may still count from `today` on, and a timer for the day when the last of them does not. Each call of the
        store is a message to another process, so what is stored already is not stored again."""
        left = sorted(d for d in days if d >= today - self.n_days)
        before = [*stored[0]] if stored else []
        if not left:
            self.seen.clear()
            return
        if left != before:
            self.seen.update((left,))
        if not before or left[-1] != before[-1]:
            self.handle.registerTimer((left[-1] + self.n_days + 1) * DAY_MS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.seen.get()
        batch = [(r.event_id, r.day) for r in rows]
        known = {day for _, day in batch}.union(stored[0] if stored else ())
        flags = {d: int(any(d - self.n_days <= e < d for e in known)) for d in known}
        # rows behind the last day may still come until the watermark has passed theirs
        watermark = timerValues.getCurrentWatermarkInMs() // DAY_MS
        self._keep(known, min(max(known), watermark) if watermark > 0 else min(known), stored)
        shop_id, visitor = key
        for event_id, day in batch:
            yield Row(event_id=event_id, shop_id=shop_id, visitor=visitor, dp_return=flags[day])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.seen.get()
        if stored:
            self._keep({*stored[0]}, timerValues.getCurrentWatermarkInMs() // DAY_MS, stored)
        return iter(())

    def close(self) -> None:
        pass


def return_flags(flow: DataFrame, lag: str = "1 day", days: int = RETURN_DAYS) -> DataFrame:
    """event_id, shop_id, visitor and dp_return of each page view of a stream, as visitors.return_visitor gives them.

    A view counts those of other days that came before it or in its micro-batch; views that are more than `lag` behind
    the last are dropped. Rows without shop or visitor, whose flag is 0, are left out: there is nothing to tell them by.
    """
    rows = flow.filter("shop_id is not null and coalesce(visitor, '') <> ''").withWatermark("ts", lag)
    keyed = rows.select("event_id", "shop_id", "visitor", "ts", F.unix_date(F.to_date("ts")).alias("day"))
    return keyed.groupBy("shop_id", "visitor").transformWithState(ReturnFlags(days), "event_id bigint, shop_id bigint, visitor string, dp_return int", "append", "EventTime")


class Pending(StatefulProcessor):
    """Children and parents of one order that are near in time, whichever comes first.

    A child that has waited its time without a parent comes out as timed out. Beyond `most` that wait, the oldest comes out
    as crowded out. Parents are kept as long as a child may still come that is near them.
    """

    def __init__(self, wait_ms: int = WAIT_MS, most: int = MOST_WAITING) -> None:
        self.wait_ms, self.most = wait_ms, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        entry = "array<struct<ts:bigint,id:bigint,met:boolean>>"
        self.state = handle.getValueState("near", f"children {entry}, parents array<struct<ts:bigint,id:bigint>>")

    def _load(self) -> tuple[list[tuple[int, int, bool]], list[tuple[int, int]]]:
        if not self.state.exists():
            return [], []
        children, parents = self.state.get()
        return [(c[0], c[1], c[2]) for c in children], [(p[0], p[1]) for p in parents]

    def _store(self, children: list, parents: list) -> None:
        if not children and not parents:
            self.state.clear()
            return
        self.state.update((children, parents))
        times = [c[0] for c in children[:1]] + [p[0] for p in parents[:1]]
        self.handle.registerTimer(min(times) + self.wait_ms + 1)

    @staticmethod
    def _out(key, rows: list[tuple[int, int | None, str]]) -> Iterator[pd.DataFrame]:
        if rows:
            ids, parents, outcomes = zip(*rows, strict=True)
            yield pd.DataFrame({"parent_id": key[0], "event_id": list(ids), "parent_event": pd.array(parents, dtype="Int64"), "outcome": list(outcomes)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        children, parents = self._load()
        out: list[tuple[int, int | None, str]] = []
        for batch in rows:
            for is_parent, ts, event in zip(batch["is_parent"].tolist(), batch["ts_ms"].tolist(), batch["event_id"].tolist(), strict=True):
                lo, hi = ts - self.wait_ms, ts + self.wait_ms
                if is_parent:
                    insort(parents, (ts, event))
                    for k in range(bisect_left(children, (lo,)), bisect_right(children, (hi + 1,))):
                        if children[k][0] <= hi:
                            out.append((children[k][1], event, "matched"))
                            children[k] = (*children[k][:2], True)
                else:
                    near = [p for p in parents[bisect_left(parents, (lo,)) : bisect_right(parents, (hi + 1,))] if p[0] <= hi]
                    out += [(event, p[1], "matched") for p in near]
                    insort(children, (ts, event, bool(near)))
                    if len(children) > self.most:
                        _, first, met = children.pop(0)
                        if not met:
                            out.append((first, None, "crowded out"))
            yield from self._out(key, out)
            out = []
        self._store(children, parents)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        children, parents = self._load()
        over = timerValues.getCurrentWatermarkInMs() - self.wait_ms
        out = [(event, None, "timed out") for ts, event, met in children if ts < over and not met]
        self._store([c for c in children if c[0] >= over], [p for p in parents if p[0] >= over])
        yield from self._out(key, out)

    def close(self) -> None:
        pass


def pending(children: DataFrame, parents: DataFrame, lag: str = "180 seconds", wait_ms: int = WAIT_MS, most: int = MOST_WAITING) -> DataFrame:
    """parent_id, event_id, parent_event and outcome: 'matched' for each pair of a child and a parent at most wait_ms apart,
    and 'timed out' or 'crowded out' for a child without one. Both streams have event_id, parent_id and ts."""
    one = lambda df, flag: df.select("event_id", "parent_id", "ts", F.unix_millis("ts").alias("ts_ms"), F.lit(flag).alias("is_parent"))
    both = one(children, False).unionByName(one(parents, True)).withWatermark("ts", lag)
    schema = "parent_id bigint, event_id bigint, parent_event bigint, outcome string"
    return both.groupBy("parent_id").transformWithStateInPandas(Pending(wait_ms, most), schema, "append", "EventTime")


def in_tables(root: str, by: str = "outcome"):
    """A sink that keeps matched rows apart from those that a side table is for, each micro-batch by its id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.withColumn("batch", F.lit(batch_id))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, "batch").parquet(root)

    return write
