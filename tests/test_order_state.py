"""The order fact kept by changes equals the fact computed from the tables as they are."""

import datetime as dt
import decimal
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievework.plans import order_state, reports
from sievework.sinks import keyed

ITEMS = "order_id long, product_id long, quantity int, unit_price decimal(18,2)"
ORDERS = "order_id long, customer_id long, order_date date, status string, order_total decimal(18,2)"


def money(x):
    return decimal.Decimal(x).quantize(decimal.Decimal("0.01"))


def order(draw, k):
    return (k, draw.randint(1, 5), dt.date(2026, 1, draw.randint(1, 28)), draw.choice("FO"), money(draw.randint(0, 500)))


def item(draw, k):
    return (k, draw.choice([1, 2, 3, None]), draw.randint(1, 4), draw.choice([None, money(draw.randint(1, 90))]))


def rows(df):
    names = sorted(df.columns)
    return sorted(str([str(r[c]) for c in names]) for r in df.collect())


def fact(spark, orders, items):
    return reports.order_fact(spark.createDataFrame(list(orders.values()), ORDERS), spark.createDataFrame(items, ITEMS)).withColumns(
        {c: F.col(c).cast("decimal(38,2)") for c in ("computed_order_total", "order_total_diff")}
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_fact_after_inserts_updates_and_deletes(spark, folder, seed):
    draw, base = random.Random(seed), f"{folder}/s"
    orders = {k: order(draw, k) for k in range(30)}
    items = [item(draw, draw.randrange(40)) for _ in range(150)]  # some of orders that come later
    order_state.start(spark.createDataFrame(list(orders.values()), ORDERS), spark.createDataFrame(items, ITEMS), base, "0", buckets=8)
    assert rows(order_state.read(spark, base)) == rows(fact(spark, orders, items))
    for batch in range(1, 4):
        gone = [items.pop(draw.randrange(len(items))) for _ in range(25)]
        come = [item(draw, draw.randrange(45)) for _ in range(20)]
        items += come
        changed = []
        for k in draw.sample(range(45), 8):
            if k in orders and draw.random() < 0.4:
                changed.append((*orders.pop(k), True))
            else:
                orders[k] = order(draw, k)
                changed.append((*orders[k], False))
        signed = spark.createDataFrame([(*r, -1) for r in gone] + [(*r, 1) for r in come], f"{ITEMS}, sign int")
        order_state.apply(signed, spark.createDataFrame(changed, f"{ORDERS}, deleted boolean"), base, str(batch))
        assert rows(order_state.read(spark, base)) == rows(fact(spark, orders, items))


def test_batch_that_was_cut_off_is_completed_once(spark, folder, monkeypatch):
    base, draw = f"{folder}/s", random.Random(5)
    orders, items = {k: order(draw, k) for k in range(5)}, [(1, 1, 1, money(5)), (1, 2, 1, money(7)), (2, 1, 1, money(1))]
    order_state.start(spark.createDataFrame(list(orders.values()), ORDERS), spark.createDataFrame(items, ITEMS), base, "0", buckets=8)
    signed = spark.createDataFrame([(1, 2, 1, money(7), -1), (3, 9, 2, money(4), 1)], f"{ITEMS}, sign int")
    none = spark.createDataFrame([], f"{ORDERS}, deleted boolean")
    real, calls = keyed.rewrite, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise KeyError("died between the two snapshots")
        return real(*args)

    monkeypatch.setattr(keyed, "rewrite", dies)
    with pytest.raises(KeyError):
        order_state.apply(signed, none, base, "1")
    monkeypatch.undo()
    for _ in range(2):
        order_state.apply(signed, none, base, "1")
    assert rows(order_state.read(spark, base)) == rows(fact(spark, orders, [items[0], items[2], (3, 9, 2, money(4))]))
    run = keyed.manifest(spark, f"{base}/fact")["run"]
    assert len([n for n in os.listdir(f"{base}/fact/run={run}") if n.startswith("_bucket")]) <= 2


def test_item_that_was_not_there_cannot_go(spark, folder):
    base = f"{folder}/s"
    order_state.start(spark.createDataFrame([(1, 1, None, "F", None)], ORDERS), spark.createDataFrame([], ITEMS), base, "0", buckets=2)
    assert order_state.read(spark, base).first()["item_count"] == 0
    signed = spark.createDataFrame([(1, 2, 1, money(7), -1)], f"{ITEMS}, sign int")
    with pytest.raises(PySparkException, match="not there"):
        order_state.apply(signed, spark.createDataFrame([], f"{ORDERS}, deleted boolean"), base, "1")
    assert order_state.read(spark, base).count() == 1
