import zlib

import pytest
from pyspark.sql import functions as F

from retailflow.functions import mapping, scalars
from retailflow.sources import dimensions, logs


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'bigint' if isinstance(v, int) else 'string'}" for n, v in values.items())) if names else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("start, end, want", [(1000, 12345, 12345), (1000, 604923, 604800), (1000, 604800, 604800)])
def test_adjust_end(start, end, want):
    assert scalars.adjust_end(start, end) == want


def test_shards_follow_crc32(spark):
    assert one(spark, scalars.shard_of(F.col("k")), k="abc") == zlib.crc32(b"abc") % 32
    assert one(spark, scalars.shard_of_long(F.col("k")), k=4711) == zlib.crc32((4711).to_bytes(8, "big")) % 256


def test_addresses(spark):
    assert one(spark, scalars.ip_to_dotted(F.col("k")), k=0x04030201) == "1.2.3.4"
    assert one(spark, scalars.ip_to_long(F.col("k")), k="1.2.3.4") == 0x01020304
    assert one(spark, scalars.ip_to_long(F.col("k")), k="1.2.3.400") is None
    assert one(spark, scalars.ip_to_long(F.col("k")), k="x") is None


def test_unescape_and_gbk(spark):
    assert one(spark, scalars.unescape(F.col("k")), k="%u4F60%u597D%20a%zz") == "你好 a?"
    assert one(spark, scalars.url_decode_gbk(F.col("k")), k="%C4%E3%BA%C3+x") == "你好 x"
    assert one(spark, scalars.url_decode_gbk(F.col("k")), k="%ff") == "%ff"


def test_query_params(spark):
    found = one(spark, scalars.query_params(F.col("u")), u="http://h/p?a=1&b=&c=2&a=3&d=e=f& g = h ")
    assert found == {"c": "2", "a": "3", "g": "h"}
    assert one(spark, scalars.query_params(F.col("u")), u="no query") == {}


def test_untag(spark):
    assert tuple(one(spark, scalars.untag(scalars.tag_seller(F.col("k"))), k=77)) == (77, 2)


def rows(spark, *lines):
    return logs.fields_of(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_mapping_levels(spark):
    df = spark.createDataFrame([(["20120801121212", "123\x01456\x01a\x03b\x03c"],)], "fields array<string>")
    spec = {"i": "@int 1", "f": "@field 1", "two": "@field2 2 2", "three": "@field3 2 3 3"}
    got = mapping.map_fields(df, spec).first()
    assert (got.i, got.f, got.two, got.three, got.reject) == (1, "20120801121212", "456", "c", None)
    df = spark.createDataFrame([(["x", "123\x03456\x03789\x02a\x03b\x03c\x02q\x03w\x03r"],)], "fields array<string>")
    got = mapping.map_fields(df, {"g": "@field3 2 0 3"}, mapping.Row(level2="\x02", level3="\x03")).first()
    assert got.g == "789\x01c\x01r"


@pytest.mark.parametrize("level2, level3", [("|", "^"), (".", "\\"), ("\x01", "\x03"), ("ab", "{")])
def test_mapping_separators_and_empty_numbers(spark, level2, level3):
    """Separators mean themselves; empty numbers are null, other texts reject the row."""
    spec = {"a": "@bigint @field2 1 1", "b": "@int @field2 1 2", "c": "@bigint @field3 1 3 2"}
    lines = [[level2.join(["7", empty, level3.join(["x", last])])] for empty, last in (("", "9"), ("\\N", "null"), ("null", ""), ("q", "1"), ("2147483648", "z"), ("5", "z"))]
    df = spark.createDataFrame([(x,) for x in [*lines, ["7"], [None]]], "fields array<string>")
    got = [tuple(r) for r in mapping.map_fields(df, spec, mapping.Row(level2=level2, level3=level3)).collect()]
    assert got == [(7, None, 9, None), (7, None, None, None), (7, None, None, None), (7, None, 1, "b"), (7, None, None, "b"), (7, 5, None, "c"), (7, None, None, "b"), (None, None, None, "a")]


def test_mapping_rejects_and_errors(spark):
    df = rows(spark, "a\x02b", "a")
    good, bad = mapping.split_rejects(mapping.map_fields(df, {"n": "@field 2", "m": "@bigint @field 1"}))
    assert good.count() == 0 and sorted(r.reject for r in bad.collect()) == ["m", "n"]
    good, bad = mapping.split_rejects(mapping.map_fields(df, {"n": "@field 0"}))
    assert good.count() == 0 and bad.count() == 2
    with pytest.raises(ValueError, match="unknown command"):
        mapping.compile_expression("@nope 1")
    with pytest.raises(ValueError, match="too many"):
        mapping.compile_expression("@int 1 2")


def test_price_cent(spark):
    assert one(spark, mapping.price_cent(F.col("k")), k="12.34") == 1234
    assert one(spark, mapping.price_cent(F.col("k"), legacy=True), k="12.34") == 1200
    assert one(spark, mapping.price_cent(F.col("k")), k="\\N") == 0


def test_order_line(spark):
    row = [""] * 44
    for place, value in {1: "182492200123858", 5: "253855838", 6: "405455103", 7: "10037171091", 10: "840", 11: "2", 12: "200", 13: "7", 34: "1", 35: "0", 37: "182492200093858", 38: "0", 39: "320"}.items():
        row[place - 1] = value
    line = "\x02".join(["1339062031104:1", "db", "t", "2012-06-07", "UPDATE:16,17", "\x01".join(row)])
    got = mapping.map_fields(logs.changelog(rows(spark, line, line.replace("UPDATE:16,17", "delete"))), mapping.ORDER, keep=("order_modified_t", "db_action")).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.order_id, r.parent_id, r.seller_id, r.buyer_id, r.auction_id) == ("182492200123858", "182492200093858", "405455103", "253855838", "10037171091")
    assert (r.auction_price, r.discount_fee, r.buy_amount, r.is_detail, r.is_main, r.pay_status) == (840, 320, 2, 1, 0, 7)
    assert (r.order_modified_t, r.db_action, r.reject) == (1339062031104, "update:16,17", None)


def test_changelog_without_time(spark):
    got = logs.changelog(rows(spark, "123\x02a\x02b\x02c\x02insert")).first()
    assert got.order_modified_t == 0
    got = logs.changelog(rows(spark, "5000000:1\x02a\x02INSERT"), action_pos=3, ts_unit="us").first()
    assert (got.order_modified_t, got.db_action) == (5000, "insert")


def test_headed_file(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "x.data").write_text("a\x01b\n1\x01x\n\x01y\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.IntegerType())])
    got = sorted(map(tuple, logs.read_header_delimited(spark, str(tmp_path / "x.data"), schema).collect()), key=str)
    assert got == [(1, "x", None), (None, "y", None)]


def test_last_line_wins(spark):
    lines = spark.createDataFrame([("1-10", 1), ("1-11", 2), ("2-20", 3), ("bad", 4), ("x-1", 5)], "value string, line_no bigint")
    assert sorted(map(tuple, dimensions.shop_seller_map(lines).collect())) == [(1, 11), (2, 20)]


def test_scan_window(spark):
    df = spark.createDataFrame([(t, t % 2) for t in range(0, 1000, 100)], "ts_ms bigint, shard bigint")
    assert logs.scan_range(df, 100, 900, now_ms=700, lag_ms=200).count() == 4
    assert logs.scan_range(df, 100, 900, most_ms=150).count() == 2
    assert logs.scan_range(df, 0, 900, shards=[1]).count() == 0
