"""The given tables with a third of all rows on one order, customer, country and text."""

import shutil

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sievework.operators import grouping, integrity
from sievework.plans import reports
from workload.feeds import shop_items, shop_orders, shop_products
from workload.registry import Tables

SOURCE = "/root/testdata/sf0.001"
AFFECTED = [
    "n1_top_products", "e1_product_revenue", "n2_monthly_revenue", "n4_customer_rank", "g1_customer_rank_in_slices", "q8_rank_by_computed_total",
    "n5_order_fact", "m7_total_mismatch", "m8_orphan_items", "m9_duplicate_keys", "m11_orders_without_items",
    "e9_orders_of_unknown_customers", "f5_members_in_parts", "f8_one_row_per_key", "f11_duplicate_rows",
    "f11_duplicate_texts", "q2_upsert", "q7_quality_run", "q9_survivorship", "q10_quarantine", "b7_contract_violations",
    "b7_rejected_rows", "m5_key_uniqueness", "a7_fingerprint", "f4_exact_mean", "l7_every_row_routed_once",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    hot = {
        "lineitem": {"l_orderkey": 7, "l_linenumber": 3},
        "orders": {"o_custkey": 5},
        "customer": {"c_nationkey": 3, "c_mktsegment": "HOT"},
        "documents": {"text": "the same text"},
        "events": {"user_id": 1},
    }
    for name in "region nation supplier part labels pages lineitem orders customer documents events".split():
        path = f"{SOURCE}/{name}.parquet"
        if name not in hot:
            shutil.copy(path, folder)
            continue
        df = spark.read.parquet(path)
        third = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
        kinds = dict(df.dtypes)
        new = {c: F.when(third, F.lit(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in hot[name].items()}
        df.withColumns(new).repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def db(skewed):
    import glob
    import os

    con = connect(SOURCE)
    for path in glob.glob(f"{skewed}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE OR REPLACE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


@pytest.mark.parametrize("name", AFFECTED)
def test_results_hold_under_skew(spark, skewed, db, name):
    assert differences(entry.queries()[name](spark, skewed), db, entry.oracle_sql()[name]) == []


@pytest.fixture
def split_early(spark):
    """Treat any partition well above the others as skewed, and broadcast nothing."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.files.maxPartitionBytes": "20KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_orders_and_keys_are_split_at_run_time(spark, skewed, split_early):
    t = Tables(spark, skewed)
    top = reports.top_products(shop_items(t), shop_orders(t), shop_products(t), amount=F.col("amount"), status="F")
    assert "skew=true" in final_plan(top)
    lost = integrity.orphans(t.lineitem, t.orders.filter("o_orderstatus = 'F'"), {"l_orderkey": "o_orderkey"})
    assert "skew=true" in final_plan(lost)
    assert "skew=true" in final_plan(grouping.repeated_rows(t.lineitem, ["l_orderkey"]))
    members = grouping.repeated_members(t.lineitem, ["l_orderkey"], "l_partkey", members_per_row=50)
    assert "skew=true" in final_plan(members)
