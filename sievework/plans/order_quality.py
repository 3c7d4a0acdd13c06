"""Data-quality findings on the order tables, alone and as one scheduled check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import pick_per_key, repeated_keys, repeated_members
from ..operators.integrity import ACCEPTED, REJECTED, childless, orphans, violations_summary
from ..sinks.snapshots import ROUTE, write_routed
from .reports import item_amount, item_totals


def total_mismatches(
    orders: DataFrame,
    items: DataFrame,
    amount: Column | None = None,
    tolerance: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """Orders whose recorded total differs from the sum of their items; no items count as 0.

    A missing recorded total is not reported unless ``strict``. With ``tolerance`` only larger
    differences are.
    """
    both = orders.join(item_totals(items, amount), "order_id", "left")
    recorded, computed = F.col("order_total"), F.coalesce("computed_order_total", F.lit(0))
    differs = F.abs(recorded - computed) > F.lit(tolerance) if tolerance else recorded != computed
    if strict:
        differs = F.coalesce(differs, F.lit(True))
    return both.filter(differs).select(
        "order_id",
        recorded.alias("recorded_order_total"),
        computed.alias("computed_order_total"),
        (recorded - computed).alias("diff"),
    )


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return orphans(items, orders, {"order_id": "order_id"})


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return childless(orders, items, {"order_id": "order_id"})


def orders_of_unknown_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orphans(orders, customers, {"customer_id": "customer_id"})


def shared_emails(customers: DataFrame) -> DataFrame:
    """Emails used by more than one customer, with the customers' ids in order."""
    return repeated_members(customers, ["email"], "customer_id", "customer_count", "customer_ids")


def surviving_customers(customers: DataFrame) -> DataFrame:
    """One customer per email: the earliest to sign up, then the lowest id. Who has no email is nobody's duplicate."""
    own = customers.withColumn("_own", F.when(F.col("email").isNull(), F.col("customer_id")))
    return pick_per_key(own, ["email", "_own"], [F.col("signup_date"), F.col("customer_id")]).drop("_own")


def with_reasons(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with what holds them back: an unknown customer, no items, or nothing (an empty text)."""
    known = customers.select(F.col("customer_id").alias("_c")).distinct()
    filled = items.select(F.col("order_id").alias("_o")).distinct()
    seen = orders.join(known, F.col("customer_id") == F.col("_c"), "left").join(
        filled, F.col("order_id") == F.col("_o"), "left"
    )
    reasons = F.concat_ws(
        ",",
        F.when(F.col("_c").isNull(), F.lit("unknown_customer")),
        F.when(F.col("_o").isNull(), F.lit("no_items")),
    )
    return seen.select(*orders.columns, reasons.alias("quarantine_reason"))


def quarantine(
    orders: DataFrame, customers: DataFrame, items: DataFrame, base: str | None = None, run: str = "checked"
) -> tuple[DataFrame, DataFrame]:
    """(usable orders, orders with an unknown customer or no items, with the reasons).

    With ``base`` the joins run once: one job writes both sides by the verdict, and each is read from its own files.
    Without it both are branches of a plan, for a caller that takes one of them.
    """
    marked = with_reasons(orders, customers, items)
    if base is None:
        usable, held = marked.filter("quarantine_reason = ''"), marked.filter("quarantine_reason <> ''")
    else:
        side = F.when(F.col("quarantine_reason") == "", ACCEPTED).otherwise(REJECTED)
        written = write_routed(marked.withColumn(ROUTE, side), base, run)
        usable, held = (written.filter(F.col(ROUTE) == s).drop(ROUTE) for s in (ACCEPTED, REJECTED))
    return usable.drop("quarantine_reason"), held


def quality_findings(
    customers: DataFrame, orders: DataFrame, items: DataFrame, amount: Column | None = None
) -> dict[str, DataFrame]:
    """The offenders of each check, to be listed."""
    return {
        "order_total_mismatch": total_mismatches(orders, items, amount).orderBy("order_id"),
        "orphan_items": orphan_items(items, orders),
        "shared_email": shared_emails(customers),
        "unknown_customer": orders_of_unknown_customers(orders, customers),
        "order_without_items": orders_without_items(orders, items),
    }


def quality_run(
    customers: DataFrame, orders: DataFrame, items: DataFrame, amount: Column | None = None
) -> DataFrame:
    """(check_name, violations) for every check, in one query, for a scheduled run.

    The three checks between orders and items share one outer join of the orders with the
    items' sums, so each of the two is read and shuffled once.
    """
    amount = item_amount() if amount is None else amount
    sums = items.groupBy(F.col("order_id").alias("_k")).agg(F.count("*").alias("_n"), F.sum(amount).alias("_t"))
    known = orders.select("order_id", "order_total", F.lit(True).alias("_order"))
    both = known.join(sums, F.col("order_id") == F.col("_k"), "full")
    is_order, has_items = F.col("_order").isNotNull(), F.col("_n").isNotNull()
    counts = both.agg(
        F.count_if(is_order & (F.col("order_total") != F.coalesce("_t", F.lit(0)))).alias("order_total_mismatch"),
        F.coalesce(F.sum(F.when(~is_order, F.col("_n"))), F.lit(0)).alias("orphan_items"),
        F.count_if(is_order & ~has_items).alias("order_without_items"),
    )
    shared = counts.unpivot([], counts.columns, "check_name", "violations")
    return shared.unionByName(
        violations_summary({
            "shared_email": repeated_keys(customers, ["email"]),
            "unknown_customer": orders_of_unknown_customers(orders, customers),
        })
    )
