"""The physical plans: what is shuffled, pushed down, parsed, and how often."""

import pathlib
import re

import pytest
import shop
from pyspark.sql import functions as F

from sievework.operators import exceptions as ex
from sievework.operators import grouping, integrity, profiling, upsert
from sievework.plans import reports, returns
from workload.feeds import returns_feed, shop_customers, shop_items, shop_orders, shop_products
from sievework.session import estimated_bytes
from sievework.sinks import tables
from workload.orders import bucketed_order_fact
from workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


@pytest.fixture
def full_text(spark):
    keys = {"spark.sql.debug.maxToStringFields": "100000", "spark.sql.maxPlanStringLength": "10000000"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_returns_have_no_shuffle_and_parse_once(spark, t, full_text, folder):
    returns_feed(t).write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    plan = physical(returns.transform(raw))
    assert "Exchange" not in plan and "Join" not in plan and "Aggregate" not in plan
    # the list, the object, and the closed list under its condition
    assert plan.count("from_json(") == 3
    for branch in ex.route(returns.transform(raw)):
        assert physical(branch).count("from_json(") == 3


def test_clean_up_is_one_wide_step_per_stage(spark, t, full_text, folder):
    returns_feed(t).write.parquet(f"{folder}/raw")
    plan = physical(returns.transform(spark.read.parquet(f"{folder}/raw")))
    assert plan.count("Project [") <= 7


def test_top_products_plan(t, no_broadcast, full_text):
    df = reports.top_products(shop_items(t), shop_orders(t), shop_products(t), amount=F.col("amount"), status="F")
    plan = physical(df)
    assert "TakeOrderedAndProject" in plan and "Sort [total_revenue" not in plan
    # items and orders meet by order; sums and products meet by product; nothing else moves
    assert plan.count("Exchange hashpartitioning(order_id") == 2
    assert plan.count("Exchange hashpartitioning(product_id") == 2
    assert plan.count("Exchange") == 4
    assert "EqualTo(o_orderstatus,F)" in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>", plan)


def test_order_fact_moves_orders_and_items_only(t, no_broadcast, full_text):
    plan = physical(reports.order_fact(shop_orders(t), shop_items(t), F.col("amount")))
    # items by order and product for the distinct count, then by order; orders by order
    assert plan.count("Exchange hashpartitioning") == 3


def test_order_fact_from_buckets_moves_nothing(t, no_broadcast, full_text):
    plan = physical(bucketed_order_fact(t))
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_buckets_grow_with_the_tables(t, monkeypatch):
    assert tables.buckets_for(t.orders, t.lineitem) == 8
    monkeypatch.setattr(tables, "BUCKET_BYTES", estimated_bytes(t.orders, t.lineitem) // 19)
    assert tables.buckets_for(t.orders, t.lineitem) in (19, 20)


def test_customer_sums_are_made_before_the_join(t, no_broadcast, full_text):
    plan = physical(reports.customer_revenue(shop_customers(t), shop_orders(t), "F"))
    assert "partial_sum(order_total" in plan.replace("partial_sum(", "partial_sum(")
    assert plan.count("Exchange hashpartitioning(customer_id") == 2


def test_no_join_is_told_to_broadcast(t):
    for df in (
        reports.top_products(shop_items(t), shop_orders(t), shop_products(t), amount=F.col("amount")),
        reports.customer_rank(shop_customers(t), shop_orders(t), parts=4),
    ):
        assert "ResolvedHint" not in optimized(df) and "strategy=broadcast" not in optimized(df)


def test_orphans_are_an_anti_join(t):
    plan = optimized(integrity.childless(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}))
    assert "LeftAnti" in plan and "LeftOuter" not in plan and "Aggregate" in plan


def test_survivors_combine_before_the_shuffle(t):
    plan = physical(grouping.pick_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]))
    assert "Window" not in plan and "partial_min_by" in plan


def test_members_of_a_hot_key_are_spread(t, no_broadcast, full_text):
    plan = physical(grouping.repeated_members(t.orders, ["o_custkey"], "o_orderkey"))
    last = plan[plan.index("collect_list"):]
    assert re.search(r"hashpartitioning\(o_custkey#\w+, part#\w+, ", last)


def test_samples_are_limited_in_every_task(t):
    plan = physical(profiling.shape_audit(t.pages, {"url": "^x", "html": "^y"}))
    assert "WindowGroupLimit" in plan and ", Partial" in plan


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_shape_audit_reads_its_input_once(t, full_text):
    plan = final_plan(profiling.shape_audit(t.documents, {"source": "^s", "lang": "^e"}))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_contract_and_quarantine_are_evaluated_once(spark, t, full_text, tmp_path):
    """What is read of either side is its own files: no key grouping, no join."""
    from sievework.plans import order_quality
    from workload.columns import DOCUMENTS

    sides = [
        *integrity.split_written(t.documents, DOCUMENTS, str(tmp_path / "d"), "r"),
        *order_quality.quarantine(shop_orders(t), t.customer.selectExpr("c_custkey AS customer_id"), shop_items(t), str(tmp_path / "q")),
    ]
    for side in sides:
        plan = physical(side)
        assert "Exchange" not in plan and "Join" not in plan and "PartitionFilters: [isnotnull(route" in plan
    assert sides[0].count() + sides[1].count() == t.documents.count() and sides[2].count() + sides[3].count() == t.orders.count()


def test_profile_is_one_pass(t, full_text):
    plan = physical(profiling.sentinel_profile(t.documents))
    assert plan.count("FileScan") == 1


def test_incremental_filter_reaches_the_scan(t, full_text):
    import datetime as dt

    assert "GreaterThan(ts," in physical(upsert.newer_than(t.events, "ts", dt.datetime(2024, 1, 15)))


def test_few_changes_leave_the_target_where_it_is(spark, t):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        target = t.orders.select("o_orderkey", "o_orderdate")
        changes = target.filter("o_orderkey = 1")
        plan = physical(upsert.upsert(target, changes, ["o_orderkey"], "o_orderdate"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin [coalesce(o_orderkey" in plan and "LeftAnti" in plan and "LeftSemi" in plan


def test_library_keeps_to_the_rules():
    root = pathlib.Path(__file__).parent.parent
    code = {p: p.read_text() for d in ("sievework", "workload") for p in (root / d).rglob("*.py") if p.parent.name != "llm"}
    for path, text in code.items():
        for word in ("localCheckpoint", "broadcast(", "crossJoin", "toPandas", "udf(", ".rdd.map", "sample(", "approx_top"):
            assert word not in text, (path, word)
    operators = "".join(t for p, t in code.items() if p.parent.name in ("operators", "functions"))
    assert ".collect()" not in operators and ".count()" not in operators


def test_golden_rows_read_like_their_contracts(spark):
    from sievework.layouts import shop as layout

    for contract in layout.SHOP:
        assert contract.drift(shop.frame(spark, contract.name).schema) == []


def test_shuffles_grow_with_the_input(spark, t, monkeypatch):
    from sievework import session

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(t.lineitem)
        assert spark.conf.get("spark.sql.shuffle.partitions") == old
        monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
        session.size_shuffles(t.lineitem)
        grown = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert grown == -(-session.estimated_bytes(t.lineitem) // 1000) > int(old)
        session.size_shuffles(t.region)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == grown
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
