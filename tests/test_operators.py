import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailflow.operators import classify, enrich, kpi, orders, sinks, stats, visitors
from retailflow.streaming import queries as streams

VIEWS = [(1383544801000, 111, 211, "311"), (1383544802000, 111, 211, "311"), (1383544802000, 111, 211, "312"), (1383544803000, 111, 211, "312")]
SALES = [(111, 211, 311, 100, 2, 1383544859000, 0, 1, 1), (111, 211, 312, 200, 3, 1383544802000, 1, 0, 1), (111, 211, 312, 300, 4, 1383544859000, 0, 1, 1)]


def both(spark, views, sales):
    v = spark.createDataFrame(views, "ts_ms bigint, item_id bigint, seller_id bigint, uid_mid string").withColumn("ts", F.timestamp_millis("ts_ms"))
    o = spark.createDataFrame(sales, "item_id bigint, seller_id bigint, buyer_id bigint, fee bigint, buy_amount bigint, ts_ms bigint, is_new int, is_pay int, is_detail int").withColumn("ts", F.timestamp_millis("ts_ms"))
    return kpi.unified(v, o)


@pytest.mark.parametrize("sales, want", [([], (4, 0, 0, 0, 0, 0, 2, 0, 0, 0)), (SALES, (4, 400, 6, 1, 2, 2, 2, 10000, 20000, 20000))])
def test_golden_indicators(spark, sales, want):
    got = kpi.kpi_ratios(kpi.item_kpi(both(spark, VIEWS, sales), "day")).first()
    assert tuple(got[c] for c in ("pv", "amt", "an", "tn", "atn", "auv", "iuv", "ar", "az", "au")) == want


def test_golden_running(spark):
    last = kpi.kpi_running(both(spark, VIEWS, SALES), "day").orderBy(F.desc("minute")).first()
    assert (last.pv, last.amt, last.iuv, last.auv) == (4, 400, 2, 2)


def test_unparsable_ids_are_left_out(spark):
    v = spark.createDataFrame([(dt.datetime(2024, 1, 1), "x", "1", "u"), (dt.datetime(2024, 1, 1), "5", "1", "u")], "ts timestamp, item_id string, seller_id string, uid_mid string")
    o = spark.createDataFrame([], "ts timestamp, item_id string, seller_id string, buyer_id bigint, fee bigint, buy_amount bigint, is_new int, is_pay int, is_detail int")
    assert kpi.unified(v, o).count() == 1


def test_main_orders_alone_count_for_shops(spark):
    o = spark.createDataFrame([(dt.datetime(2024, 1, 1), 31111111111, 500, 0, 1)], "ts timestamp, seller_id bigint, fee bigint, is_main int, is_pay int")
    got = kpi.shop_day_amount(o).first()
    assert (got.seller_id, got.amount, got.last_ts) == (31111111111, 0, None)


def test_milestones_resume(spark):
    o = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), 1, 60, 1, 1) for h in range(5)], "ts timestamp, seller_id bigint, fee bigint, is_main int, is_pay int")
    assert [(r.total, r.px) for r in kpi.shop_milestones(o, base=100).orderBy("flush").collect()] == [(120, 1), (240, 2), (300, 3)]
    start = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 250)], "day timestamp, seller_id bigint, amount bigint")
    assert [r.total for r in kpi.shop_milestones(o, base=100, start=start).orderBy("flush").collect()] == [310, 430, 550]


@settings(max_examples=5, deadline=None)
@given(parts=st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), max_size=20), min_size=1, max_size=3))
def test_merged_deltas_equal_one_go(spark, parts):
    def rows(some):
        return both(spark, [(1383544800000 + 60_000 * k, i, 1, f"u{v}") for k, (i, v) in enumerate(some)], [])

    everything = kpi.item_kpi(rows([x for p in parts for x in p]), "day", sketch=True)
    total = kpi.item_kpi(rows(parts[0]), "day", sketch=True)
    for p in parts[1:]:
        total = kpi.kpi_merge(total, kpi.item_kpi(rows(p), "day", sketch=True))
    want, got = ({r.item_id: (r.pv, r.iuv) for r in df.collect()} for df in (everything, total))
    assert got == want


def test_visitors_of_a_sketch_do_not_depend_on_how_it_was_made(spark):
    """Items of 100 to 20,000 visitors, in one go, merged, and joined with a state that has some of the items."""
    rows = spark.range(16).selectExpr("id as item_id").join(spark.range(20_000).selectExpr("id as v")).filter("v < 100 * (1 + item_id * 13)")
    rows = rows.selectExpr("timestamp '2024-01-01 00:00:00' as ts", "1 as seller_id", "item_id", "concat(item_id, 'u', v) as visitor", "1 as view", "0 as is_new", "1 as is_pay", "1 as qty", "1 as fee", "v")
    one, other = rows.filter("v % 2 = 0 and item_id % 3 > 0"), rows.filter("v % 2 = 1 or item_id % 3 = 0")
    visitors_of = lambda df: {r.item_id: (r.iuv, r.auv) for r in df.collect()}
    want = visitors_of(kpi.item_kpi(rows, "day", sketch=True))
    parts = [kpi.item_kpi(df, "day", sketch=True) for df in (one, other)]
    assert visitors_of(kpi.kpi_merge(*parts)) == visitors_of(kpi.kpi_join_state(*parts)) == want
    assert visitors_of(kpi.item_kpi(rows.orderBy(F.desc("v")).coalesce(1), "day", sketch=True)) == want


def test_sketches_are_within_their_bound(spark):
    """Two sets that united sketches of 2 ** 13 registers estimate 3.3 and 3.04 % off, and keys without visitors."""
    rows = spark.sql("select k, cast(k * 1000000 + id as string) as visitor from values (372L), (2315L) as t(k), range(20000)")
    more = rows.unionAll(spark.sql("select * from values (372L, cast(null as string)), (999L, null)"))
    got = {r.k: (r.uv, r.uv_estimate) for r in kpi.uv_sketch(more, ["k"]).collect()}
    assert got.pop(999) == (0, 0) and [uv for uv, _ in got.values()] == [20_000, 20_000]
    assert max(abs(e - uv) / uv for uv, e in got.values()) <= 0.03
    flat = rows.selectExpr("timestamp '2024-01-01 00:00:00' as ts", "1 as seller_id", "k as item_id", "visitor", "1 as view", "0 as is_new", "0 as is_pay", "0 as qty", "0 as fee")
    merged = kpi.kpi_merge(*[kpi.item_kpi(flat.filter(f"right(visitor, 1) {side} '5'"), "day", sketch=True) for side in ("<", ">=")])
    assert max(abs(r.iuv - 20_000) / 20_000 for r in merged.collect()) <= 0.03


@settings(max_examples=8, deadline=None)
@given(lines=st.lists(st.integers(1, 10_000), min_size=1, max_size=6), total=st.integers(0, 10**12))
def test_shares_stay_below_the_total(spark, lines, total):
    rows = [(1, str(k), k, p, 1, 0, 0, 2, total) for k, p in enumerate(lines)]
    df = spark.createDataFrame(rows, "parent_id bigint, order_id string, line_no int, price bigint, qty bigint, discount bigint, adjust bigint, pay_status int, paid_total bigint")
    lost = total - sum(r.share for r in orders.order_fee_allocation(df).collect())
    assert 0 <= lost < max(len(lines), 1)
    assert sum(r.share for r in orders.order_fee_allocation(df, largest_remainder=True).collect()) == total


def test_parent_that_is_its_own_child(spark):
    p = spark.createDataFrame([(1, 1, 0, "p")], "order_id bigint, is_main int, is_detail int, state string")
    c = spark.createDataFrame([(11, 1, 0, 1), (5, 0, 1, 1), (6, 0, 0, 0)], "order_id bigint, parent_id bigint, is_main int, is_detail int")
    got = sorted((r.order_id, r.parent_id, r.p_state) for r in orders.parents_with_children(p, c).collect())
    assert got == [(5, 5, None), (11, 1, "p")]


FLAGS = [
    ("insert", 2, "tc_biz_order", "", 1, 0),
    ("insert", 2, "order_0000", "TRADE_SUCCESS", 1, 1),
    ("insert", 2, "order_0000", "WAIT_SELLER_SEND_GOODS", 1, 1),
    ("insert", 2, "order_0000", "TRADE_CLOSED", 0, 0),
    ("update:16,13", 2, "tc_biz_order", "", 0, 1),
    ("update:16,13", 1, "tc_biz_order", "", 0, 0),
    ("update:113", 2, "tc_biz_order", "", 0, 0),
    ("update:6", 2, "tc_pay_order", "", 0, 1),
    ("update:10", 0, "order_0000", "", 0, 1),
    ("update: 10 ,3", 0, "order_0000", "", 0, 1),
    ("other", 2, "order_0000", "TRADE_SUCCESS", 0, 0),
    (None, None, None, None, 0, 0),
]


def test_order_flags(spark):
    df = spark.createDataFrame([(k, *f) for k, f in enumerate(FLAGS)], "k int, db_action string, pay_status int, log_src string, trade_status string, n int, p int")
    assert enrich.order_flags(df).filter("is_new_generated <> n or is_pay <> p").count() == 0


@pytest.mark.parametrize(
    "uid, sid, want",
    [("u1", "s_1_2", ("s", "u1", "u1:")), ("-", "s_1", ("s", "m", ":s")), ("", "s", ("s", "m", ":s")), (" 0 ", "_s", ("_s", "m", ":_s")), ("0", "a_b", ("a", "m", ":a"))],
)
def test_visitor_identity(spark, uid, sid, want):
    df = spark.createDataFrame([(uid, sid, "m", "browse")], "uid string, sid string, mid string, dest_type string")
    got = enrich.visitor_identity(df).first()
    assert (got.sid, got.uid_mid, got.puid) == want


def test_first_rule_wins(spark):
    df = spark.createDataFrame([("item-12.htm",), ("ITEM-9.HTM",), ("none",), (None,)], "url string")
    got = enrich.regex_extract_fields(df, [enrich.FieldRules("url", "id", ((1, r"item-(\d+)"), (1, r"(\d)")))]).collect()
    assert [r.id for r in got] == ["12", "9", "", None]
    with pytest.raises(ValueError, match="no group"):
        enrich.regex_extract_fields(df, [enrich.FieldRules("url", "id", ((2, r"(\d)"),))])


def test_ip_ranges_over_bins(spark):
    ranges = spark.createDataFrame([(0, 10, 1), (60_000, 200_000, 2)], "start_ip bigint, end_ip bigint, location_id bigint")
    df = spark.createDataFrame([(0,), (10,), (11,), (60_000,), (131_072,), (200_000,), (200_001,), (None,)], "ip_num bigint")
    got = {r.ip_num: r.location_id for r in enrich.join_ip_location(df, ranges).collect()}
    assert got == {0: 1, 10: 1, 11: 0, 60_000: 2, 131_072: 2, 200_000: 2, 200_001: 0, None: 0}


def test_return_visitor_window(spark):
    days = [1, 7, 14, 15, 15]
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, d, 5), 1, "v") for k, d in enumerate(days)], "k int, ts timestamp, shop_id bigint, visitor string")
    assert [r.dp_return for r in visitors.return_visitor(df).orderBy("k").collect()] == [0, 1, 0, 1, 1]


def test_search_rule_without_key_falls_through(spark):
    rules = [classify.PageRule("search", r"^h/s\?q=([^&]*)", classify.SEARCH, key=1), classify.PageRule("any", "^h/", classify.OTHER_PAGE)]
    df = spark.createDataFrame([("h/s?q=%C4%E3%BA%C3", "T"), ("h/s?q=null", "T"), ("h/s?q=%25", "T"), ("x", "A-b")], "url string, title string")
    got = {r.url: (r.page_type, r.key, r.title_info) for r in classify.page_classify(df, rules).collect()}
    assert got["h/s?q=%C4%E3%BA%C3"] == ("1", "你好||", "T")
    assert got["h/s?q=null"][0] == "7" and got["h/s?q=%25"][0] == "7"
    assert got["x"] == ("0", "", "A")


def test_keyword_precedence(spark):
    df = spark.createDataFrame([("1", "page", "3", "ad", "2", "s", "t"), ("1", "page", "3", "site", "1", "s", "t"), ("4", "page", "3", "site", "1", "s", "t"), ("1", "page", "3", "ad", "2", "", "t")], "page_type string, key string, key_type string, src_key string, src_key_type string, shop_id string, title string")
    assert [r.keyword for r in classify.keyword_precedence(df).collect()] == ["ad", "page", "site", None]
    assert [r.keyword for r in classify.keyword_precedence(df, search_type="3").collect()] == ["ad", "site", "site", None]


def test_subscribers(spark):
    df = spark.createDataFrame([(456, "s", 1), (1, "", 2)], "adid bigint, shopid string, kind int")
    got = sinks.fan_out(df, [sinks.Subscriber("a", "adid = 456", ("adid", "kind")), sinks.Subscriber("b", "shopid <> '' and kind = 1"), sinks.Subscriber("c", enabled=False)])
    assert set(got) == {"a", "b"} and got["a"].columns == ["adid", "kind"] and got["b"].count() == 1


def test_upsert_twice_is_once(spark, tmp_path):
    sink = sinks.upsert_write(str(tmp_path / "t"), ["k"], "dt")
    frame = lambda rows: spark.createDataFrame(rows, "k int, v0 int, dt string")
    sink(frame([(1, 1, "d1"), (2, 1, "d2")]), 0)
    for _ in range(2):
        sink(frame([(1, 5, "d1"), (3, 7, "d1")]), 1)
    got = sorted((r.k, r.v0) for r in sinks.current(spark.read.parquet(str(tmp_path / "t"))).collect())
    assert got == [(1, 5), (2, 1), (3, 7)]


def test_routes_and_dumps(spark, tmp_path):
    df = spark.createDataFrame([("browse", "2024-01-01", 5), ("other", "2024-01-01", 6)], "dest_type string, dt string, ts_ms bigint")
    write = sinks.route_write(str(tmp_path / "r"), {"browse": "views"})
    write(df, 3)
    write(df, 3)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
    sinks.range_dump(df, str(tmp_path / "d"), 5, 6)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1
    sinks.fan_out_write(str(tmp_path / "f"), [sinks.Subscriber("x", "ts_ms > 5")])(df, 0)
    assert spark.read.parquet(str(tmp_path / "f/x")).count() == 1


def test_error_context(spark):
    lines = spark.createDataFrame([("h", k, 1000.0 + k, "ERROR" if k == 3 else "INFO", f"m{k}") for k in range(5)], "host string, line_no bigint, ts double, level string, message string")
    got = stats.error_log_stats(lines, 1010, "m", context=2).first()
    assert (got.n_errors, got.first_context) == (1, "m1\nm2\nm3")


@pytest.mark.parametrize("context", [0, 1, 3, 8])
@pytest.mark.parametrize("block", [1, 2, 4, 1000])
def test_error_context_over_blocks(spark, context, block):
    """Numbers with gaps, so that some blocks hold fewer lines than the context has."""
    numbers = {"a": [1, 2, 3, 9, 10, 30, 31, 32, 33, 34, 50], "b": [5], None: [2, 7, 8]}
    lines = spark.createDataFrame([(h, n, 1000.0, "INFO", f"{h}{n}") for h, some in numbers.items() for n in some], "host string, line_no bigint, ts double, level string, message string")
    got = {(r.host, r.line_no): r.context for r in stats.with_context(lines, context, block).collect()}
    assert got == {(h, n): "\n".join(f"{h}{x}" for x in some[max(k - context, 0) : k + 1]) for h, some in numbers.items() for k, n in enumerate(some)}


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    source, seen = tmp_path / "in", []
    write = lambda b, k: seen.extend(r.x for r in b.collect())
    for value in (1, 2):
        spark.createDataFrame([(value,)], "x int").write.mode("append").parquet(str(source))
        streams.start(streams.stream_of(spark, str(source)), str(tmp_path / "c"), write, mode="append", once=True).awaitTermination()
    assert seen == [1, 2]


def test_children_wait_for_parents_in_later_files(spark, tmp_path):
    """Files of a stored table from the latest day to the first, each with a child and its parent."""
    for day in (9, 7, 5, 3, 1):
        at = dt.datetime(2024, 1, day, 5)
        spark.createDataFrame([(day, at)], "parent_id int, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "child"))
        spark.createDataFrame([(day, at)], "parent_id int, p_ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "parent"))
    joined = streams.children_with_parents(*(streams.stream_of(spark, str(tmp_path / name)) for name in ("child", "parent")))
    assert sorted(r.parent_id for r in streams.drained(joined.select("c.parent_id"), str(tmp_path / "out"), mode="append").collect()) == [1, 3, 5, 7, 9]


def test_dimension_is_kept_when_empty(spark):
    state = [spark.range(2), spark.range(0)]
    dim = streams.Dimension(lambda: state.pop(0))
    assert dim.now().count() == 2 and dim.now().count() == 2


def test_children_are_compared_with_parents_near_them(spark, tmp_path):
    """4,000 children and parents of one order over 22 hours: the join's rows grow with the rows, not with their square."""
    made = spark.range(8_000).selectExpr("id as event_id", "7L as parent_id", "timestamp_micros(id * 10000001 + 1704067200000000) as ts", "id % 2 = 1 as p")
    made.coalesce(1).write.parquet(f"{tmp_path}/in")
    rows = streams.stream_of(spark, f"{tmp_path}/in")
    children = rows.filter("not p").select("event_id", "parent_id", "ts")
    parents = streams.stream_of(spark, f"{tmp_path}/in").filter("p").selectExpr("parent_id", "ts as p_ts", "event_id as parent_event")
    joined = streams.children_with_parents(children, parents, "20 seconds")
    assert joined.columns == ["event_id", "parent_id", "ts", "p_ts", "parent_event"]
    got = {(r.event_id, r.parent_event) for r in streams.drained(joined, str(tmp_path)).collect()}
    assert got == {(e, e + d) for e in range(0, 8_000, 2) for d in (-1, 1) if e + d >= 0}
    keys = spark.read.format("statestore").option("joinSide", "left").load(f"{tmp_path}/checkpoint").select("key").distinct().count()
    assert keys > 5
