"""Streaming versions of the operators, and sinks that may see a batch twice."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.kpi import additive, measures, with_estimates

#: How far behind page views and orders are read, and how long child orders wait for their parents.
FLOW_LAG, ORDER_LAG, PENDING = "60 seconds", "180 seconds", "60 seconds"
FLUSH = "60 seconds"


def aligned(flow: DataFrame, orders: DataFrame, flow_lag: str = FLOW_LAG, order_lag: str = ORDER_LAG) -> DataFrame:
    """Both streams as one; the later of the two watermarks does not close windows before the earlier has come as far."""
    return flow.withWatermark("ts", flow_lag).unionByName(orders.withWatermark("ts", order_lag))


def tumbling(rows: DataFrame, size: str, sketch: bool = True) -> DataFrame:
    """Indicators by tumbling window of event time, with visitors by sketch (an exact count needs unbounded state)."""
    columns = measures(sketch=True) if sketch else additive()
    out = rows.groupBy(F.window("ts", size).alias("w"), "seller_id", "item_id").agg(*columns)
    out = out.select(F.col("w.start").alias("bucket"), *[c for c in out.columns if c != "w"])
    return with_estimates(out) if sketch else out


def children_with_parents(children: DataFrame, parents: DataFrame, within: str = PENDING) -> DataFrame:
    """Child orders joined with parents at most so far apart in time; state for either side ends with the bound.

    within: seconds, minutes or hours. Times are cut into slots of that length, and the slot is part of the key, so that rows
    are compared with those of three slots instead of all that wait: a child is in its slot, a parent in the three around its.
    """
    slot = lambda ts: F.expr(f"floor(unix_micros({ts}) / unix_micros(timestamp_seconds(0) + interval {within}))")
    c = children.withWatermark("ts", ORDER_LAG).withColumn("__slot", slot("ts")).alias("c")
    around = F.explode(F.sequence(slot("p_ts") - 1, slot("p_ts") + 1)).alias("__slot")
    p = parents.withWatermark("p_ts", ORDER_LAG).select("*", around).alias("p")
    near = F.expr(f"p.parent_id = c.parent_id and p.__slot = c.__slot and p.p_ts between c.ts - interval {within} and c.ts + interval {within}")
    return c.join(p, near).drop(F.col("p.parent_id"), F.col("p.__slot"), F.col("c.__slot"))


def visits(flow: DataFrame, lag: str = "1 day") -> DataFrame:
    """Each (shop, visitor, day) once: what the table of visit days grows by."""
    keyed = flow.withColumn("day", F.to_date("ts")).withWatermark("ts", lag)
    return keyed.dropDuplicatesWithinWatermark(["shop_id", "visitor", "day"]).select("shop_id", "visitor", "day")


class Dimension:
    """A dimension that is read anew for each micro-batch; one that comes back empty is not taken."""

    def __init__(self, read: Callable[[], DataFrame]) -> None:
        self.read, self.last = read, None

    def now(self) -> DataFrame | None:
        new = self.read()
        if self.last is None or not new.isEmpty():
            self.last = new
        return self.last


def start(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "update", once: bool = False) -> StreamingQuery:
    """Runs a stream into a foreachBatch sink; offsets and state are in the checkpoint, so a restart goes on from there."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=FLUSH)).start()


def drained(df: DataFrame, path: str, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """What a stream returns once all that is there has been read. In update mode, the last row of each key."""
    spark = df.sparkSession
    out = f"{path}/out"
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{out}/batch=-1")
    start(df, f"{path}/checkpoint", batches_into(out), mode, once=True).awaitTermination()
    return last_of(spark.read.parquet(out), df.columns, keys) if mode == "update" else spark.read.parquet(out).drop("batch")


def batches_into(out: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps each micro-batch apart, by its id: one that is written twice is there once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def last_of(batches: DataFrame, columns: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The row of each key in the last micro-batch that has it."""
    rest = [c for c in columns if c not in keys]
    last = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*keys, "last.*").select(*columns)


class Throughput(StreamingQueryListener):
    """Rows a second of each micro-batch; stalled() tells streams that read nothing in their last batches."""

    def __init__(self, alert_after: int = 5) -> None:
        self.rates: dict[str, list[float]] = {}
        self.rows: dict[str, int] = {}  # read so far, also by queries that have ended
        self.seen_rates: dict[str, list[float]] = {}
        self.alert_after = alert_after

    def onQueryStarted(self, event) -> None:
        self.rates.setdefault(str(event.id), [])

    def onQueryProgress(self, event) -> None:
        self.rates.setdefault(str(event.progress.id), []).append(event.progress.processedRowsPerSecond or 0.0)
        self.seen_rates.setdefault(str(event.progress.id), []).append(event.progress.processedRowsPerSecond or 0.0)
        self.rows[str(event.progress.id)] = self.rows.get(str(event.progress.id), 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        self.rates.setdefault(str(event.id), []).append(0.0)

    def onQueryTerminated(self, event) -> None:
        self.rates.pop(str(event.id), None)

    def stalled(self) -> list[str]:
        return [k for k, v in self.rates.items() if len(v) >= self.alert_after and not any(v[-self.alert_after :])]


@contextlib.contextmanager
def watched(spark: SparkSession, listener: StreamingQueryListener) -> Iterator[None]:
    """Queries that run within are listened to; what they have said by the end has been heard."""
    spark.streams.addListener(listener)
    try:
        yield
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)


def stream_of(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A Parquet table, a folder or a single file, as a stream. A pattern, as a stream takes no single file's path.

    Each micro-batch reads all new files. With fewer a batch, files that are not in the order of time move the watermark
    past the rows of those read after them, and these rows are dropped as late.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
