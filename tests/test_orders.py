"""Reports and findings on the garden shop, against results worked out by hand."""

from decimal import Decimal

import pytest
import shop
from pyspark.sql import functions as F

from sievework.plans import order_quality as q
from sievework.plans import reports as r


@pytest.fixture(scope="module")
def t(spark):
    return {n: shop.frame(spark, n).cache() for n in shop.TEXT}


def rows(df):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()]


def test_top_products(t):
    got = rows(r.top_products(t["order_items"], t["orders"], t["products"]))
    assert got == [
        (501, "Watering Can", "Garden", 4, "74.00"),
        (502, "Hand Rake", "Garden", 3, "36.00"),
        (504, "Clay Pot", "Nursery", 4, "31.00"),
        (503, "Seed Tray", "Nursery", 4, "17.00"),
    ]
    assert rows(r.top_products(t["order_items"], t["orders"], t["products"], k=1)) == got[:1]


def test_monthly_revenue(t):
    assert rows(r.monthly_revenue(t["orders"])) == [
        ("2023-05", 2, "66.00", "33.00"), ("2023-06", 2, "48.50", "24.25"), ("2023-07", 3, "103.00", "34.33"),
    ]


@pytest.mark.parametrize("parts", [None, 1, 2, 7])
def test_customer_rank(t, parts):
    got = rows(r.customer_rank(t["customers"], t["orders"], parts=parts))
    assert got == [
        ("AT", 11, "Ilse Brandt", "49.00", 1),
        ("CZ", 12, "Tomas Novak", "35.50", 1),
        ("IT", 13, "Maria Rossi", "61.00", 1),
        ("IT", 16, "Paolo Bianchi", "60.00", 2),
    ]


def test_order_fact(t):
    fact = r.order_fact(t["orders"], t["order_items"])
    cols = ["order_id", "item_count", "distinct_product_count", "computed_order_total", "recorded_order_total", "order_total_diff"]
    got = [tuple(float(v) for v in row) for row in fact.select(cols).orderBy("order_id").collect()]
    assert got == [
        (7001, 2, 2, 49, 49, 0), (7002, 1, 1, 17, 17, 0), (7003, 1, 1, 31, 30, -1), (7004, 1, 1, 24, 24, 0),
        (7005, 1, 1, 18.5, 18.5, 0), (7006, 1, 1, 12, 12, 0), (7007, 1, 1, 8.5, 8.5, 0), (7008, 0, 0, 0, 60, 60),
        (7009, 2, 2, 30.5, 31, 0.5),
    ]
    by_items = r.monthly_revenue(r.fact_orders(fact, "computed"))
    assert [x[2] for x in rows(by_items)] == ["66.00", "49.50", "42.50"]
    with pytest.raises(ValueError):
        r.fact_orders(fact, "guessed")


def test_total_mismatches(t):
    found = q.total_mismatches(t["orders"], t["order_items"]).orderBy("order_id")
    assert [(a, float(b), float(c), float(d)) for a, b, c, d in found.collect()] == [
        (7003, 30, 31, -1), (7008, 60, 0, 60), (7009, 31, 30.5, 0.5),
    ]
    assert q.total_mismatches(t["orders"], t["order_items"], tolerance=20).count() == 1
    unknown = t["orders"].withColumn("order_total", F.when(F.col("order_id") != 7002, F.col("order_total")))
    assert 7002 not in [x[0] for x in q.total_mismatches(unknown, t["order_items"]).collect()]
    assert 7002 in [x[0] for x in q.total_mismatches(unknown, t["order_items"], strict=True).collect()]


def test_orphans_and_duplicates(t):
    orphan = q.orphan_items(t["order_items"], t["orders"])
    assert orphan.columns == t["order_items"].columns
    assert [x["order_item_id"] for x in orphan.collect()] == [9]
    assert [x["order_id"] for x in q.orders_without_items(t["orders"], t["order_items"]).collect()] == [7008]
    assert [x["order_id"] for x in q.orders_of_unknown_customers(t["orders"], t["customers"]).collect()] == [7006]
    assert rows(q.shared_emails(t["customers"])) == [("ilse@mail.test", 2, 0, [11, 15])]
    kept = {x["customer_id"] for x in q.surviving_customers(t["customers"]).collect()}
    assert kept == {11, 12, 13, 14, 16}


def test_quarantine_and_quality_run(t):
    usable, held = q.quarantine(t["orders"], t["customers"], t["order_items"])
    assert {(x["order_id"], x["quarantine_reason"]) for x in held.collect()} == {(7006, "unknown_customer"), (7008, "no_items")}
    assert usable.count() == 7 and usable.columns == t["orders"].columns
    found = dict(q.quality_run(t["customers"], t["orders"], t["order_items"]).collect())
    assert found == {
        "order_total_mismatch": 3, "orphan_items": 1, "shared_email": 1, "unknown_customer": 1, "order_without_items": 1,
    }
