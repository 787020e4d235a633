import os
from pathlib import Path

import pytest
from oracle import rows_of, rows_of_frame
from pyspark.sql import functions as F

from retailflow.functions import mapping
from retailflow.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert rows_of_frame(catalog.QUERIES[name](spark, sf_dir)) == rows_of(catalog.SQL[name], sf_dir)


def test_every_other_query_runs(spark, sf_dir):
    for name in set(catalog.QUERIES) - set(catalog.SQL):
        assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_orders_are_parents(spark, sf_dir):
    """Every child of an order that is there, and every line that is its own child; no other line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.expr("l_orderkey = o_orderkey"))
    n = {r.l_linenumber: r["count"] for r in lines.groupBy("l_linenumber").count().collect()}
    assert all(n[k] for k in (1, 5, 6, 7))
    got = catalog.QUERIES["join_parent_children_all"](spark, sf_dir)
    own, joined = got.filter("parent_id like '%-%'"), got.filter("parent_id not like '%-%'")
    assert own.agg(F.sum("n")).first()[0] == n[5] and joined.agg(F.sum("n")).first()[0] == sum(n.values()) - n[5] - n[6] - n[7]
    assert joined.filter("parent_id % 3 <> 0").count() > 0


def test_keys_of_all_order_items(spark, sf_dir):
    """Not one residue of the item ids only, and each stored row once although keys repeat."""
    got = catalog.QUERIES["distinct_keys_all"](spark, sf_dir)
    rows = [(r.seller_id, r.item_id) for r in got.collect()]
    assert {item % 10 for _, item in rows} == set(range(10)) and len(rows) == len(set(rows))


def test_all_page_views_in_log_order(spark, sf_dir):
    rows = [(r.ts_ms, r.event_id) for r in catalog.QUERIES["order_by_log_time_all"](spark, sf_dir).collect()]
    assert len(rows) > 100 and rows == sorted(rows)
    first = catalog.QUERIES["order_by_log_time"](spark, sf_dir).collect()
    assert [(r.ts_ms, r.event_id) for r in first] == rows[:100]


def test_stored_files_out_of_time_order(spark, sf_dir, tmp_path):
    """The latest events are in the file that is read first: no row of the others is late."""
    for table in Path(sf_dir).iterdir():
        if table.name != "events.parquet":
            os.symlink(table, tmp_path / table.name)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("s", F.col("ts").cast("timestamp").cast("double"))
    ends = [0.0, *events.agg(F.percentile_approx("s", [0.25, 0.5, 0.75, 1.0])).first()[0]]
    for k in (3, 2, 1, 0):
        events.filter((F.col("s") > ends[k]) & (F.col("s") <= ends[k + 1])).drop("s").coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert rows_of_frame(catalog.QUERIES["st_return_state"](spark, str(tmp_path))) == rows_of(catalog.SQL["st_return_state"], sf_dir)


@pytest.mark.parametrize("command", ["field1", "field3"])
def test_commands_run_in_a_query(spark, sf_dir, monkeypatch, command):
    """The query of the command is one that stops without it."""
    monkeypatch.delitem(mapping.COMMANDS, command)
    with pytest.raises(ValueError, match=f"unknown command @{command}"):
        catalog.QUERIES[f"expr_{command}_places"](spark, sf_dir)


def test_versions_of_children_are_made_of_one_join(spark, sf_dir):
    """Each line is read and joined with its order once, and only the columns asked for are carried on."""
    plan = catalog.QUERIES["join_latest_child"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and plan.count("Relation [l_orderkey") == 1 and "l_extendedprice#" not in plan.replace(plan[plan.index("Relation [l_orderkey"):].split("]")[0], "")


@pytest.mark.parametrize("name", ["map_feeds", "map_fields"])
def test_mapped_fields_are_compiled(spark, sf_dir, name):
    """The JVM leaves methods of more than 8,000 bytes uncompiled: no method that maps a feed's rows may be as long."""
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenStringSeq(plan)
    longest = [code.apply(k)._3().maxMethodCodeSize() for k in range(code.size())]
    assert longest and 0 < max(longest) < 8000
