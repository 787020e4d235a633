import pytest
from oracle import rows_of_frame
from pyspark.sql import functions as F

from retailflow.operators import orders, sinks
from retailflow.plans import catalog
from retailflow.sources import logs, stored
from retailflow.sources.stored import Conflict, OrderTables, StoredLog, VersionedTable

DAY_MS = 86_400_000


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def files_read(df):
    """Files that the scans of a plan without a shuffle open, by Spark's own count."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    metrics = [leaves.apply(k).metrics().get("numFiles") for k in range(leaves.size())]
    return sum(m.get().value() for m in metrics if m.isDefined())


# ---- the log


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"), (F.col("id") * 600_000).alias("ts_ms"), (F.col("id") % 97).cast("string").alias("puid"),
        (F.col("id") % 3).alias("company"), (F.col("id") % 2).alias("is_shop"), F.when(F.col("id") % 5 < 3, "4").otherwise("1").alias("url_type"),
    )
    own = StoredLog(spark, str(tmp_path_factory.mktemp("log") / "t"), slot_s=86_400, parts=4)
    own.write(sinks.with_log_key(rows))
    return own, sinks.with_log_key(rows)


def test_a_range_opens_its_slots_alone(log):
    own, rows = log
    whole = files_read(own.scan_prefix())
    got = own.scan_range(3 * DAY_MS + 5, 5 * DAY_MS)
    assert "PartitionFilters: [isnotnull(slot_of_time" in plan_of(got) and "PushedFilters: [IsNotNull(ts_ms)" in plan_of(got)
    assert rows_of_frame(got) == rows_of_frame(logs.scan_range(rows, 3 * DAY_MS + 5, 5 * DAY_MS))
    assert 0 < files_read(got) < whole / 8
    some = own.scan_range(3 * DAY_MS, 5 * DAY_MS, shards=[6, 9])
    assert rows_of_frame(some) == rows_of_frame(logs.scan_range(rows, 3 * DAY_MS, 5 * DAY_MS, shards=[6, 9]))
    assert files_read(some) < files_read(got) and "part_of_slot" in plan_of(some)


def test_ranges_are_held_back_and_capped(log):
    own, _ = log
    now = 10 * DAY_MS
    assert own.scan_range(0, now, now).agg(F.max("ts_ms")).first()[0] == now - 600_000
    assert own.scan_range(0, now, now, lag_ms=DAY_MS).agg(F.max("ts_ms")).first()[0] < 9 * DAY_MS
    assert own.scan_range(0, now, most_ms=600_001).count() == 2
    assert own.scan_range(now, now).count() == 0 and own.scan_range(900 * DAY_MS, 901 * DAY_MS).count() == 0
    assert own.scan_latest(now, 3_600).count() == 6


def test_slots_of_the_week(log, monkeypatch):
    own, rows = log
    now = 16 * DAY_MS
    slot = F.expr("ts_ms div 1000 % 604800")
    seconds = lambda lo, hi, since: rows.filter((slot >= lo) & (slot < hi) & (F.col("ts_ms") >= since) & (F.col("ts_ms") < now))
    assert rows_of_frame(own.scan_week_slots(1000, 90_000, now)) == rows_of_frame(seconds(1000, 90_000, 14 * DAY_MS))
    assert rows_of_frame(own.scan_week_slots(500_000, 700_000, now)) == rows_of_frame(seconds(500_000, 604_800, 7 * DAY_MS).filter(F.col("ts_ms") < 14 * DAY_MS))
    monkeypatch.setattr(stored, "LISTED_SLOTS", 0)
    assert rows_of_frame(own.scan_range(0, 2 * DAY_MS)) == rows_of_frame(rows.filter(F.col("ts_ms") < 2 * DAY_MS))


def test_prefix_filters_reach_the_files(log):
    own, rows = log
    got = own.scan_prefix(company=2, is_shop=1, url_type="4")
    pushed = plan_of(got).partition("PushedFilters: [")[2].partition("]")[0]
    assert "EqualTo(company,2)" in pushed and "EqualTo(is_shop,1)" in pushed and "EqualTo(url_type,4)" in pushed, pushed
    assert rows_of_frame(got) == rows_of_frame(logs.scan_prefix(rows))
    assert rows_of_frame(own.scan_prefix(0, DAY_MS, company=2)) == rows_of_frame(rows.filter("company = 2").filter(F.col("ts_ms") < DAY_MS))
    assert "ReadSchema: struct<event_id:bigint,company:bigint,is_shop:bigint,url_type:string>" in plan_of(got.select("event_id"))


def test_old_slots_are_dropped(spark, tmp_path):
    own = StoredLog(spark, str(tmp_path / "t"), slot_s=3_600, parts=2)
    assert own.drop_before(DAY_MS) == []
    own.write(spark.range(10).select((F.col("id") * 1_800_000).alias("ts_ms"), (F.col("id") % 32).alias("shard")))
    own.write(spark.range(1).select(F.lit(0).cast("bigint").alias("ts_ms"), F.lit(1).cast("bigint").alias("shard")))
    assert own.drop_before(2 * 3_600_000 + 5) == [0, 1] and own.scan_prefix().agg(F.min("ts_ms")).first()[0] == 2 * 3_600_000
    with pytest.raises(ValueError, match="columns of the layout"):
        own.write(spark.range(1).select(F.lit(0).alias("ts_ms"), F.lit(1).alias("shard"), F.lit(1).alias("slot_of_time")))


# ---- orders in buckets


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    flags = "order_id bigint, parent_id bigint, is_main int, is_detail int, item int"
    children = spark.createDataFrame([(10, 1, 0, 1, 5), (11, 1, 0, 1, 6), (12, 2, 1, 1, 7), (13, 3, 1, 0, 8), (14, 1, 0, 0, 9), (15, 99, 0, 1, 9), (16, None, 0, 1, 9), (17, 4, 0, 1, 1)], flags)
    parents = spark.createDataFrame([(1, 1, 0, "a"), (2, 1, 0, "b"), (3, 1, 1, "c"), (4, 0, 1, "d")], "order_id bigint, is_main int, is_detail int, status string")
    payments = spark.createDataFrame([(1, 500), (1, 700), (3, 9), (None, 4)], "order_id bigint, actual_total_fee bigint")
    own = OrderTables(spark, str(tmp_path_factory.mktemp("orders")), buckets=8)
    own.write(parents=parents, children=children.withColumn("order_id", F.col("order_id").cast("string")), payments=payments)
    yield own, parents, children, payments
    own.drop()


def test_orders_are_joined_without_a_shuffle(order_tables):
    own, parents, children, payments = order_tables
    typed = lambda df, *cols: df.withColumns({c: F.col(c).cast("string") for c in cols})
    for got, want in (
        (own.parents_with_children(), orders.parents_with_children(typed(parents, "order_id"), typed(children, "parent_id", "order_id"))),
        (own.children_with_payment(), orders.with_payment(typed(children, "parent_id", "order_id"), typed(payments, "order_id"))),
    ):
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and "SortMergeJoin" in plan_of(got)
        assert rows_of_frame(got) == rows_of_frame(want)
    # a child of its parent, one that stands for itself; rows of parents alone, of neither, and of unknown parents are left out
    assert sorted(r.order_id for r in own.parents_with_children().collect()) == ["10", "11", "12"]


def test_a_lookup_reads_one_bucket(order_tables):
    own, _, _, _ = order_tables
    got = own.children_of(["1"])
    assert got.rdd.getNumPartitions() == 1 < own.read("children").rdd.getNumPartitions() and got.count() == 3
    assert {(r.index_key, r.primary_key) for r in own.index().collect()} == {("1", "10"), ("1", "11"), ("1", "14"), ("2", "12"), ("3", "13"), ("99", "15"), ("4", "17")}


# ---- versions


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, x int, dt string")


def live(table):
    return sorted((r.k, r.x, r.dt or "") for r in table.live().collect())


def test_puts_replace_keys_and_count_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no partition yet"):
        table.live()
    with pytest.raises(ValueError, match="columns of the layout"):
        table.put(frame(spark, [(1, 1, "d1")]).withColumn("v", F.lit(1)), ["k"])
    for _ in range(2):
        table.put(frame(spark, [(1, 1, "d1"), (2, 1, "d2"), (3, 1, None)]), ["k"], writer="w", batch=0)
    add = lambda old, new: old.unionByName(new).groupBy("k", "dt").agg(F.sum("x").cast("int").alias("x"))
    for _ in range(2):
        table.put(frame(spark, [(1, 5, "d1"), (9, 7, "d/3 x")]), ["k"], add, writer="w", batch=1)
    assert live(table) == [(1, 6, "d1"), (2, 1, "d2"), (3, 1, ""), (9, 7, "d/3 x")]
    assert table.live(["d/3 x"]).count() == 1 and table.live(["other"]).count() == 0
    assert table.manifest().parts == {"d1": 2, "d2": 1, "d/3 x": 2, stored.NULL_PART: 1}


def test_a_write_that_was_cut_off_is_not_seen(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.put(frame(spark, [(1, 1, "d1"), (2, 2, "d1")]), ["k"])
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.put(frame(spark, [(1, 9, "d1"), (5, 5, "d5")]), ["k"])
    assert live(table) == [(1, 1, "d1"), (2, 2, "d1")]
    table.put(frame(spark, [(2, 8, "d1")]), ["k"])
    assert live(table) == [(1, 1, "d1"), (2, 8, "d1")]
    # the partition that the failed write began is not the table's, and goes with the old version
    assert table.vacuum(keep=0) == 2 and live(table) == [(1, 1, "d1"), (2, 8, "d1")]
    assert table.vacuum(keep=0) == 0 and spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_of_two_writers_one_is_told(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    old = table.manifest()
    table.put(frame(spark, [(1, 1, "d1")]), ["k"])
    with pytest.raises(Conflict):
        table._commit(old, {"d2": 1})
    assert live(table) == [(1, 1, "d1")]


def test_deletes_touch_the_partitions_they_must(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.delete("true").seq == 0
    table.put(frame(spark, [(k, k % 3, f"2024-01-0{k % 5 + 1}") for k in range(20)] + [(99, 0, None)]), ["k"])
    before = table.manifest().parts
    table.delete("x = 1 and dt = '2024-01-02'")
    after = table.manifest().parts
    assert {p for p in before if before[p] != after[p]} == {"2024-01-02"} and table.live(["2024-01-02"]).filter("x = 1").count() == 0
    assert table.delete("x = 77").parts == after
    table.delete("true", parts=["2024-01-03"])
    assert "2024-01-03" not in table.manifest().parts
    table.retain(2, "2024-01-05")
    assert {*table.manifest().parts} == {"2024-01-04", "2024-01-05", stored.NULL_PART}
    n = table.live().count()
    assert table.vacuum(keep=0) == 4 and table.live().count() == n


def test_shop_totals_are_seen_whole(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "dt string, seller_id bigint, amount bigint, last_ts timestamp")
    write = sinks.shop_upsert_write(str(tmp_path), 100)
    for batch, new in enumerate([rows(("d1", 1, 150, None), ("d1", 2, 50, None)), rows(("d1", 2, 60, None)), rows(("d2", 1, 10, None))]):
        write(new, batch)
        write(new, batch)
    totals = {(r.dt, r.seller_id): (r.amount, r.px) for r in VersionedTable(spark, f"{tmp_path}/totals").live().collect()}
    assert totals == {("d1", 1): (150, 1), ("d1", 2): (110, 1), ("d2", 1): (10, 0)}
    history = sorted((r.dt, r.seller_id, r.batch) for r in spark.read.parquet(f"{tmp_path}/history").collect())
    assert history == [("d1", 1, 0), ("d1", 2, 1)]


def test_stored_queries_read_what_they_name(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["src_time_range_scan"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(slot_of_time" in plan
    joined = catalog._order_tables(spark, sf_dir, "test").parents_with_children()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_buckets_grow_with_the_rows(spark, sf_dir, tmp_path, monkeypatch):
    """No bucket of the queries' tables, which is a task, has much more than its rows."""
    monkeypatch.setattr(stored, "BUCKET_ROWS", 300)
    tables = catalog._order_tables(spark, sf_dir, "buckets")
    sizes = tables.read("children").groupBy(F.input_file_name()).count().collect()
    n = sum(r["count"] for r in sizes)
    assert tables.buckets == -(-n // 300) and max(r["count"] for r in sizes) < 600
    assert OrderTables.of_rows(spark, str(tmp_path), 0).buckets == 8
