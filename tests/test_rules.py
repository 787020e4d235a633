import json

import pytest
from oracle import rows_of_frame
from pyspark.sql import functions as F

from retailflow.operators import classify, rules
from retailflow.plans import catalog
from retailflow.plans import rule_tables as t

PAGE = "url string, title string, hit string, k1 string"


def test_every_rule_decides_what_it_is_meant_for(spark):
    rows = [(x.replace("{n}", "77"), "T-site", r.name, "x") for r, x in zip(t.PAGE_RULES, t.PAGE_SAMPLES, strict=True)]
    got = {r.hit: r.page_rule for r in classify.page_classify(spark.createDataFrame(rows, PAGE).drop("k1"), t.PAGE_RULES).collect()}
    assert len(rows) > 100 and got == {r.name: r.name for r in t.PAGE_RULES}
    sources = [(u.replace("{n}", "77"), f.replace("{n}", "77"), "5", r.name) for r, (u, f) in zip(t.SOURCE_RULES, t.SOURCE_SAMPLES, strict=True)]
    found = classify.referrer_classify(spark.createDataFrame(sources, "url string, refer_url string, shop_id string, hit string"), t.SOURCE_RULES)
    assert {r.hit: r.source_rule for r in found.collect()} == {r.name: r.name for r in t.SOURCE_RULES}
    assert {r.page_type for r in t.PAGE_RULES} == set("1234567") and len({r.group for r in t.SOURCE_RULES}) == 8


def test_a_table_of_rules_gives_what_the_literal_gives(spark, sf_dir):
    n = F.col("event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(catalog._sampled(spark, sf_dir, catalog._RULED_PAGES, "url"), n.cast("string").alias("title"))
    rows = rows.unionAll(spark.createDataFrame([(None, None), (None, None), ("", "x")], "url string, title string"))
    assert rows_of_frame(classify.page_classify(rows, t.PAGE_RULES, literal_rules=0)) == rows_of_frame(classify.page_classify(rows, t.PAGE_RULES))


def test_the_first_usable_rule_decides(spark):
    own = [
        classify.PageRule("a", r"^h://x/s\?q=([^&]*)", classify.SEARCH, key=1),
        classify.PageRule("b", r"^h://x/s\?.*c=(\w+)", classify.CATEGORY, key=1, unless="private"),
        classify.PageRule("c", "^h://x/", classify.COMMUNITY),
    ]
    urls = {"h://x/s?q=w": "a", "h://x/s?q=&c=1": "b", "H://X/S?Q=&C=1": "b", "h://x/s?q=%25&c=1": "b", "h://x/s?q=null&c=private": "c", "h://x/s?q= w w": "a", "h://y/": "", "": ""}
    df = spark.createDataFrame([(u, "Name-site") for u in urls], "url string, title string")
    assert {r.url: r.page_rule for r in classify.page_classify(df, own).collect()} == urls
    assert {r.url: r.page_rule for r in classify.page_classify(df, own[::-1]).collect()}["h://x/s?q=w"] == "c"


def test_hosts_hold_for_subdomains_alone(spark):
    own = [classify.PageRule("a", "x", classify.HOME, host="b.example")]
    urls = ["http://b.example/x", "http://a.b.example:80/x", "http://u@a.b.example/x", "http://ab.example/x", "http://c.example/b.example/x", "b.example/x"]
    df = spark.createDataFrame([(u, "") for u in urls], "url string, title string")
    got = {r.url: r.page_rule for r in classify.page_classify(df, own).collect()}
    assert [got[u] for u in urls] == ["a", "a", "a", "", "", ""]


def test_rules_that_can_not_be_right():
    with pytest.raises(ValueError, match="of one name"):
        rules.checked([classify.PageRule("a", "x", "1"), classify.PageRule("a", "y", "1")])
    with pytest.raises(ValueError, match="no group 2"):
        rules.checked([classify.PageRule("a", "(x)", "1", key=2)])


def test_titles_and_sources_in_gbk(spark):
    own = [classify.PageRule("c", r"/c/([^/]*)", classify.CATEGORY, title=1)]
    urls = {"/c/%D6%D0%B9%FA": "中国", "/c/1tC5+g==": "中国", "/c/a-%7C%7Cb": "a-b", "/c/": "Name"}
    df = spark.createDataFrame([(u, "Name-site") for u in urls], "url string, title string")
    got = {r.url: r.title_info for r in classify.page_classify(df, own).collect()}
    assert got["/c/%D6%D0%B9%FA"] == "中国" and got["/c/a-%7C%7Cb"] == "a-b" and got["/c/"] == "Name"
    ads = [classify.SourceRule("ad", r"[?&]bid=", "11", classify.AD_GROUP, use="url", key=r"bid=(\d):([^:&]*)", key_group=2, kind_group=1, key_type=classify.AD_KEY)]
    rows = spark.createDataFrame([("h?bid=6:", "r", "1"), ("h?bid=7:", "r", "1"), ("h?bid=1:", "r", "1"), ("h?bid=1:%D6%D0", "r", "1")], "url string, refer_url string, shop_id string")
    assert sorted((r.src_key, r.src_key_type) for r in classify.referrer_classify(rows, ads).collect()) == [("", "0"), ("中", "2"), ("定向推广", "2"), ("类目搜索", "2")]


def test_rule_files(spark, tmp_path):
    from dataclasses import asdict

    for name, own, read in (("p", t.PAGE_RULES, classify.read_page_rules), ("s", t.SOURCE_RULES, classify.read_source_rules)):
        lines = [json.dumps({"no": no} | asdict(r)) for no, r in enumerate(own)]
        (tmp_path / name).write_text("\n".join(lines[::-1]))
        assert read(spark, str(tmp_path / name)) == own


def test_streams_classify_row_by_row(spark, tmp_path):
    rows = [(t.PAGE_SAMPLES[k].replace("{n}", str(k)), f"T{k}-x", k) for k in range(0, 100, 7)] + [(None, None, 1000)]
    spark.createDataFrame(rows, "url string, title string, n int").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, title string, n int").parquet(str(tmp_path / "in"))
    run = classify.page_classify(stream, t.PAGE_RULES).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    want = classify.page_classify(spark.read.parquet(str(tmp_path / "in")), t.PAGE_RULES)
    assert rows_of_frame(spark.read.parquet(str(tmp_path / "out"))) == rows_of_frame(want)


def test_classification_runs_no_python(spark, sf_dir):
    for name in ("page_classify_rules", "referrer_classify_rules", "url_decode_gbk", "expr_unescape"):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


@pytest.mark.parametrize("text, want", [("%u4F60%zz%4", "你??"), ("%uD83D%uDE00x", "😀x"), ("%", "?"), ("%%41", "?1"), ("a%u00g0%E9", "a?é"), ("日本%41", "日本A"), ("", ""), (None, None)])
def test_unescaped(spark, text, want):
    from retailflow.functions.scalars import unescape

    assert spark.createDataFrame([(text,)], "t string").select(unescape(F.col("t"))).first()[0] == want
