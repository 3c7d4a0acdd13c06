"""Order, revenue and ranking reports over customers, products, orders and order items.

Expected columns: items(order_id, product_id, quantity, unit_price), orders(order_id,
customer_id, order_date, status, order_total), products(product_id, product_name,
category), customers(customer_id, customer_name, country). No join side is forced to be
broadcast: products and customers grow with the data, and Spark decides by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import exact_mean
from ..operators.ranking import rank_in_group

COMPLETED = "completed"
ITEM_TOTAL, RECORDED = "computed", "recorded"


def item_amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def completed(orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    return orders.filter(F.col("status") == status)


def product_revenue(
    items: DataFrame, orders: DataFrame, products: DataFrame, amount: Column | None = None, status: str = COMPLETED
) -> DataFrame:
    """Quantity and revenue of completed orders per product.

    Items meet the completed orders once, are summed per product, and only the sums meet
    the product table. A product's hot sales combine on the map side; an order with very
    many items is split by AQE's skew join, as nothing above relies on the join's partitioning.
    """
    amount = item_amount() if amount is None else amount
    lines = items.select("order_id", "product_id", "quantity", amount.alias("amount"))
    sold = lines.join(completed(orders, status).select("order_id"), "order_id")
    per_product = sold.groupBy("product_id").agg(F.sum("quantity").alias("q"), F.sum("amount").alias("r"))
    named = per_product.join(products.select("product_id", "product_name", "category"), "product_id")
    return named.groupBy("product_id", "product_name", "category").agg(
        F.sum("q").alias("total_quantity_sold"), F.sum("r").alias("total_revenue")
    )


def top_products(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    k: int = 5,
    amount: Column | None = None,
    status: str = COMPLETED,
) -> DataFrame:
    """The k products with the highest revenue; equal revenue is ordered by product id."""
    revenue = product_revenue(items, orders, products, amount, status)
    return revenue.orderBy(F.desc_nulls_first("total_revenue"), "product_id").limit(k)


def monthly_revenue(orders: DataFrame, status: str = COMPLETED, total: str = "order_total") -> DataFrame:
    """Orders, revenue and average order value per month of completed orders."""
    month = F.date_format(F.date_trunc("month", "order_date"), "yyyy-MM").alias("year_month")
    sums = completed(orders, status).groupBy(month).agg(
        F.count("*").alias("total_orders"), F.sum(total).alias("total_revenue"), F.count(total).alias("_n")
    )
    return (
        sums.withColumn("average_order_value", exact_mean(F.col("total_revenue"), F.col("_n")))
        .drop("_n")
        .orderBy("year_month")
    )


def customer_revenue(customers: DataFrame, orders: DataFrame, status: str = COMPLETED, total: str = "order_total") -> DataFrame:
    """Revenue of completed orders per known customer; orders are summed before the join."""
    spent = completed(orders, status).groupBy("customer_id").agg(F.sum(total).alias("r"))
    named = customers.select("customer_id", "customer_name", "country").join(spent, "customer_id")
    return named.groupBy("customer_id", "customer_name", "country").agg(F.sum("r").alias("total_revenue"))


def customer_rank(
    customers: DataFrame,
    orders: DataFrame,
    status: str = COMPLETED,
    total: str = "order_total",
    parts: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Customers ranked by revenue within their country."""
    revenue = customer_revenue(customers, orders, status, total)
    ranked = rank_in_group(revenue, ["country"], "total_revenue", "revenue_rank", parts)
    out = ranked.select("country", "customer_id", "customer_name", "total_revenue", "revenue_rank")
    return out.orderBy("country", "revenue_rank") if ordered else out


def item_totals(items: DataFrame, amount: Column | None = None) -> DataFrame:
    amount = item_amount() if amount is None else amount
    return items.groupBy("order_id").agg(F.sum(amount).alias("computed_order_total"))


def order_fact(
    orders: DataFrame, items: DataFrame, amount: Column | None = None, product_error: float | None = None
) -> DataFrame:
    """One row per order: item count, distinct products, computed and recorded total, difference.

    With ``product_error``, the relative standard deviation allowed, distinct products are estimated: one
    aggregate with a sketch per order instead of two by order and product.
    """
    amount = item_amount() if amount is None else amount
    products = F.count_distinct("product_id") if product_error is None else F.approx_count_distinct("product_id", product_error)
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("n"), products.alias("d"), F.sum(amount).alias("t")
    )
    computed = F.coalesce("t", F.lit(0))
    return orders.join(per_order, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("status").alias("order_status"),
        F.coalesce("n", F.lit(0)).alias("item_count"),
        F.coalesce("d", F.lit(0)).alias("distinct_product_count"),
        computed.alias("computed_order_total"),
        F.col("order_total").alias("recorded_order_total"),
        (F.col("order_total") - computed).alias("order_total_diff"),
    )


def product_sketches(items: DataFrame, lg_k: int = 12) -> DataFrame:
    """A sketch of each order's products, to be stored beside the order fact: counts of distinct products cannot be
    added up over orders, sketches can be merged. 2**lg_k registers at most; an order with few products takes a few bytes."""
    return items.groupBy("order_id").agg(F.hll_sketch_agg("product_id", F.lit(lg_k)).alias("product_sketch"))


def products_by(orders: DataFrame, sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Distinct products of the orders of each group, estimated from their sketches without reading the items.

    The relative standard error is 1.04 / sqrt(2**lg_k), 1.6 % with the default; groups of few products are exact.
    Orders without items count no product.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("product_sketch"))
    return orders.join(sketches, "order_id", "left").groupBy(*by).agg(F.coalesce(merged, F.lit(0)).cast("long").alias("distinct_products"))


def fact_orders(fact: DataFrame, revenue: str = RECORDED) -> DataFrame:
    """A stored order fact as orders for the revenue reports, by recorded or computed total."""
    if revenue not in (RECORDED, ITEM_TOTAL):
        raise ValueError(f"revenue is {RECORDED!r} or {ITEM_TOTAL!r}")
    return fact.select(
        "order_id", "customer_id", "order_date", F.col("order_status").alias("status"),
        F.col(f"{revenue}_order_total").alias("order_total"),
    )
