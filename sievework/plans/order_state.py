"""The order fact, kept up to date by changes instead of computed anew.

Two keyed snapshots, both in hash buckets of the order:

* ``lines``: how many items an order has of each product, and their sum. Counts and sums take changes with a sign: an item that
  came counts 1, one that went -1, one that was corrected goes and comes. As the counts are kept by
  product, distinct products survive deletions: a product is gone when its count is 0, which a count of distinct
  products alone, or a sketch of them, could not tell.
* ``fact``: what ``reports.order_fact`` gives. Only the orders that a batch touches are computed again, from the ``lines`` in
  their buckets; an order's items are never read again from the source.

Signed changes are not idempotent, so each batch has a name, which is published with each snapshot: a batch that comes
again right after itself is passed over where it has been applied, and completed where a crash left it half applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..sinks import keyed
from .reports import item_amount

ORDER = "order_id"


def line_counts(items: DataFrame, amount: Column | None = None, sign: Column | None = None) -> DataFrame:
    """Number and amount of an order's items by product; with ``sign``, of the items that came less those that went."""
    sign = F.lit(1) if sign is None else sign
    amount = item_amount() if amount is None else amount
    lines = items.select(ORDER, "product_id", sign.cast("long").alias("n"), (sign * amount).alias("amount"))
    return _summed(lines)


def _summed(lines: DataFrame) -> DataFrame:
    return lines.groupBy(ORDER, "product_id").agg(
        F.sum("n").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )


def _settled(lines: DataFrame) -> DataFrame:
    """Lines that are left; one that went without having been there is a fault in the changes and stops the batch."""
    fault = F.raise_error(F.concat(F.lit("items removed that were not there: order "), F.coalesce(F.col(ORDER).cast("string"), F.lit("NULL"))))
    return lines.withColumn("n", F.when(F.col("n") < 0, fault).otherwise(F.col("n"))).filter("n <> 0")


def _fact(orders: DataFrame, lines: DataFrame) -> DataFrame:
    per_order = lines.groupBy(F.col(ORDER).alias("_o")).agg(
        F.sum("n").alias("n"), F.count("product_id").alias("d"), F.sum("amount").cast("decimal(38,2)").alias("t")
    )
    computed = F.coalesce("t", F.lit(0).cast("decimal(38,2)"))
    return orders.join(per_order, orders[ORDER].eqNullSafe(per_order["_o"]), "left").select(
        ORDER, "customer_id", "order_date", F.col("status").alias("order_status"),
        F.coalesce("n", F.lit(0)).cast("long").alias("item_count"),
        F.coalesce("d", F.lit(0)).cast("long").alias("distinct_product_count"),
        computed.alias("computed_order_total"),
        F.col("order_total").alias("recorded_order_total"),
        (F.col("order_total") - computed).cast("decimal(38,2)").alias("order_total_diff"),
    )


def _heads(fact: DataFrame) -> DataFrame:
    return fact.select(
        ORDER, "customer_id", "order_date", F.col("order_status").alias("status"), F.col("recorded_order_total").alias("order_total")
    )


def start(
    orders: DataFrame, items: DataFrame, base: str, batch: str, amount: Column | None = None, buckets: int = keyed.BUCKETS
) -> None:
    """The first state, of whole tables. Completes a start that was cut off."""
    spark = orders.sparkSession
    if keyed.manifest(spark, f"{base}/lines") is None:
        keyed.create(line_counts(items, amount), f"{base}/lines", [ORDER], buckets, {"batch": batch})
    if keyed.manifest(spark, f"{base}/fact") is None:
        new = _fact(orders, keyed.read(spark, f"{base}/lines"))
        keyed.create(new, f"{base}/fact", [ORDER], buckets, {"batch": batch})


def apply(
    items: DataFrame, orders: DataFrame, base: str, batch: str, sign: str = "sign", deleted: str = "deleted", amount: Column | None = None
) -> None:
    """Take in one batch of changes.

    ``items``: items with a ``sign``, 1 for one that came, -1 for one that went, as it was. ``orders``: orders as they are
    now, one row each, with ``deleted`` true for those that went (their items have to go by ``items``).
    Items of an order that is not known are kept, and count when it comes.
    """
    spark = items.sparkSession
    items, orders = stage(items, "item-changes"), stage(orders, "order-changes")
    if keyed.info(spark, f"{base}/lines", "batch") != batch:
        keyed.rewrite(
            line_counts(items, amount, F.col(sign)), f"{base}/lines", lambda old, new: _settled(_summed(old.unionByName(new))), {"batch": batch}
        )
    if keyed.info(spark, f"{base}/fact", "batch") == batch:
        return
    touched = items.select(ORDER).union(orders.select(ORDER)).distinct()

    def settle(old: DataFrame, keys: DataFrame) -> DataFrame:
        met = lambda df: df[ORDER].eqNullSafe(keys[ORDER])
        changed = orders.select(F.col(ORDER).alias("_changed"))
        known = _heads(old.join(keys, met(old), "left_semi"))
        stay = known.join(changed, known[ORDER].eqNullSafe(changed["_changed"]), "left_anti")
        now = orders.filter(~F.coalesce(F.col(deleted), F.lit(False))).select(*known.columns)
        lines = keyed.read_touched(spark, f"{base}/lines", keys)
        new = _fact(stay.unionByName(now), lines.join(keys, met(lines), "left_semi"))
        return old.join(keys, met(old), "left_anti").unionByName(new)

    keyed.rewrite(touched, f"{base}/fact", settle, {"batch": batch})


def read(spark: SparkSession, base: str) -> DataFrame | None:
    """The order fact as it is now."""
    return keyed.read(spark, f"{base}/fact")
