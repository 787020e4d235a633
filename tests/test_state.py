import datetime as dt

import pytest

from retailflow.sources.stored import StoredLog
from retailflow.streaming import queries as streams
from retailflow.streaming.flush import Backlog, BacklogFlush, DimensionHistory, PositionedReader
from retailflow.streaming.state import pending, return_flags, rocksdb_state

DAY = dt.datetime(2024, 1, 1)


def views(spark, rows, path):
    """(event, visitor, day, hour) as page views of one shop, in a file of their own."""
    made = [(e, 1, v, DAY + dt.timedelta(days=d, hours=h)) for e, v, d, h in rows]
    spark.createDataFrame(made, "event_id bigint, shop_id bigint, visitor string, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def run(spark, path, stream):
    with rocksdb_state(spark):
        streams.start(stream(streams.stream_of(spark, f"{path}/in")), f"{path}/checkpoint", streams.batches_into(f"{path}/out"), "append", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def test_return_flags_over_batches_and_their_state(spark, tmp_path):
    path = str(tmp_path)
    views(spark, [(1, "a", 0, 9), (2, "a", 0, 23), (3, "b", 1, 1), (4, "a", 6, 1), (5, "c", 6, 0)], f"{path}/in")
    run(spark, path, return_flags)
    views(spark, [(6, "a", 7, 0), (7, "b", 8, 0), (8, "c", 6, 5), (9, "c", 12, 0), (10, None, 9, 0), (11, "", 9, 0)], f"{path}/in")
    got = {r.event_id: r.dp_return for r in run(spark, path, return_flags).collect()}
    # b comes back on the seventh day after, c on the sixth; a comes back twice; rows without a visitor are left out
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1, 7: 0, 8: 0, 9: 1}
    state = lambda: {(r.key.visitor, *r.value.days) for r in spark.read.format("statestore").option("stateVarName", "days").load(f"{path}/checkpoint").select("key", "value").collect()}
    first = (DAY.date() - dt.date(1970, 1, 1)).days
    assert {v for v, *_ in state()} == {"a", "b", "c"}
    views(spark, [(12, "d", 40, 0)], f"{path}/in")
    run(spark, path, return_flags)
    views(spark, [(13, "d", 41, 0)], f"{path}/in")
    got = {r.event_id: r.dp_return for r in run(spark, path, return_flags).collect()}
    assert state() == {("d", first + 40, first + 41)} and got[13] == 1


def orders(spark, rows, path):
    made = [(e, p, parent, DAY + dt.timedelta(seconds=s)) for e, p, parent, s in rows]
    spark.createDataFrame(made, "event_id bigint, parent_id bigint, is_parent boolean, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def outcomes(spark, path, **more):
    found = run(spark, path, lambda df: pending(df.filter("not is_parent"), df.filter("is_parent"), lag="0 seconds", **more))
    return sorted((r.event_id, r.parent_event, r.outcome) for r in found.collect())


def test_children_meet_their_parents_or_time_out(spark, tmp_path):
    path = str(tmp_path)
    orders(spark, [(1, 7, False, 0), (2, 7, False, 30), (3, 8, False, 0), (100, 9, True, 5)], f"{path}/in")
    assert outcomes(spark, path) == []
    # the parent of 7 is near its second child alone; a child of 9 comes after its parent
    orders(spark, [(101, 7, True, 80), (4, 9, False, 60), (5, 7, False, 140)], f"{path}/in")
    assert outcomes(spark, path) == [(1, None, "timed out"), (2, 101, "matched"), (3, None, "timed out"), (4, 100, "matched"), (5, 101, "matched")]
    orders(spark, [(6, 1, False, 1000)], f"{path}/in")
    assert len(outcomes(spark, path)) == 5
    orders(spark, [(7, 1, True, 2000)], f"{path}/in")
    assert outcomes(spark, path)[5:] == [(6, None, "timed out")]
    left = spark.read.format("statestore").option("stateVarName", "near").load(f"{path}/checkpoint").select("key.parent_id").collect()
    assert [r.parent_id for r in left] == [1]


def test_no_more_children_wait_than_the_bound(spark, tmp_path):
    path = str(tmp_path)
    orders(spark, [(k, 7, False, k) for k in range(5)] + [(50, 8, False, 1)], f"{path}/in")
    assert outcomes(spark, path, most=3) == [(0, None, "crowded out"), (1, None, "crowded out")]
    orders(spark, [(100, 7, True, 10)], f"{path}/in")
    assert [x for x in outcomes(spark, path, most=3) if x[2] == "matched"] == [(2, 100, "matched"), (3, 100, "matched"), (4, 100, "matched")]


def test_intervals_follow_the_backlog(spark, tmp_path):
    at, waiting = [0.0], [0]
    sink = BacklogFlush(spark, str(tmp_path), ["k"], waiting=lambda: waiting[0], clock=lambda: at[0], widen_above=4, narrow_below=2)
    frame = lambda k, v: spark.createDataFrame([(k, v, "d1")], "k int, x int, dt string")
    plan = [(0, 0, True), (30, 0, False), (60, 0, True), (120, 9, False), (180, 3, False), (240, 3, True), (300, 0, True), (360, 0, True)]
    for n, (now, behind, flushed) in enumerate(plan):
        at[0], waiting[0] = float(now), behind
        before = len(sink.flushes)
        sink.write(frame(n % 2, n), n)
        assert (len(sink.flushes) > before) == flushed, now
    assert [f[1] for f in sink.flushes] == [60, 60, 180, 60, 60] and [f[2] for f in sink.flushes] == [1, 2, 3, 1, 1]
    assert sorted((r.k, r.x) for r in sink.table.live().collect()) == [(0, 6), (1, 7)]
    # a batch that is given again is put aside again, and changes nothing
    sink.write(frame(1, 7), 7)
    sink.flush()
    sink.flush()
    assert sorted((r.k, r.x) for r in sink.table.live().collect()) == [(0, 6), (1, 7)] and sink._aside() == []


def test_backlog_counts_what_is_behind(spark, tmp_path):
    class Progress:
        def __init__(self, ms, behind=None):
            self.batchDuration, self.numInputRows = ms, 5
            self.sources = [type("S", (), {"metrics": {"maxOffsetsBehindLatest": behind} if behind else None})]

    backlog = Backlog(interval_s=1)
    event = lambda *x: type("E", (), {"progress": Progress(*x)})
    for x, want in (((500,), 0), ((1500,), 1), ((1500,), 2), ((100, "77"), 77), ((100,), 0)):
        backlog.onQueryProgress(event(*x))
        assert backlog.waiting() == want
    assert backlog.rows == 25


def test_pulls_go_on_from_each_shards_position(spark, tmp_path):
    log = StoredLog(spark, str(tmp_path / "log"), slot_s=3_600, parts=2)
    rows = lambda *r: spark.createDataFrame(r, "event_id bigint, ts_ms bigint, shard int")
    reader = PositionedReader(log, str(tmp_path / "p"), overlap_ms=1_000, shards=2)
    out = {}

    def deliver(new, n):
        out[n] = sorted(r.event_id for r in new.collect())

    log.write(rows((1, 10_000, 0), (2, 20_000, 1)))
    reader.pull(30_000, deliver, lag_ms=0)
    # shard 0 stands at 10 s, shard 1 at 20 s: what comes late within a second is read, what comes later than that is not
    log.write(rows((3, 9_500, 0), (4, 19_000, 1), (5, 18_999, 1), (6, 12_000, 0), (7, 40_000, 0)))

    def die(new, n):
        deliver(new, n)
        raise InterruptedError

    for sink in (die, deliver):
        try:
            reader.pull(35_000, sink, lag_ms=0)
        except InterruptedError:
            assert out[2] == [3, 4, 6]
    assert out == {1: [1, 2], 2: [3, 4, 6]}
    assert {r.shard: r.position for r in reader.positions().collect()} == {0: 12_000, 1: 20_000}
    reader.pull(50_000, deliver, lag_ms=0)
    reader.pull(50_000, deliver, lag_ms=0)
    assert out[3] == [7] and out[4] == []


def test_history_of_a_dimension(spark, tmp_path):
    history = DimensionHistory(spark, str(tmp_path / "d"), ("k",))
    frame = lambda *r: spark.createDataFrame(r, "k int, x string")
    at = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]
    assert history.load(frame((1, "a"), (2, "b"), (3, None)), at[0])
    assert not history.load(spark.createDataFrame([], "k int, x string"), at[1])
    assert history.load(frame((1, "c"), (3, None)), at[2]) and history.load(frame((1, "c"), (2, "b"), (3, None)), at[3])
    assert sorted((r.k, r.x) for r in history.current().collect()) == [(1, "c"), (2, "b"), (3, None)]
    assert history.table.live([at[2]]).count() == 2  # the change of 1 and the end of 2; 3 is as it was
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, d, h)) for k in (1, 2, 3, 4) for d, h in ((1, 0), (2, 23), (3, 0), (4, 5))], "k int, ts timestamp")
    got = sorted((r.k, r.ts.day, r.x) for r in history.join(rows).collect())
    assert got == [(1, 1, "a"), (1, 2, "a"), (1, 3, "c"), (1, 4, "c"), (2, 1, "b"), (2, 2, "b"), (2, 4, "b"), (3, 1, None), (3, 2, None), (3, 3, None), (3, 4, None)]


@pytest.mark.parametrize("name", ["spark.sql.streaming.stateStore.providerClass"])
def test_settings_are_put_back(spark, name):
    before = spark.conf.get(name)
    with pytest.raises(KeyError), rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(name)
        raise KeyError
    assert spark.conf.get(name) == before
