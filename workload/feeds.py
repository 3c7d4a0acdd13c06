"""The given tables in the shapes the operators expect: order tables, and messy text feeds.

The feeds are derived row by row from whole tables, so they grow with them. Faults are
spread by key arithmetic that the checking SQL repeats on the original values, without
going through text or JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.layouts import returns as layout
from sievework.operators.barriers import spread_over_cores

from .registry import Tables

MONEY = "decimal(18,2)"


def shop_items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
    )


def shop_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
    )


def shop_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("category")
    )


def shop_customers(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("n_name").alias("country")
    )


FAULT = "(l_orderkey + 3 * l_partkey + 7 * l_linenumber) % 16"


def _text(template: str, *cols: str) -> Column:
    """A template with ``%s`` places filled with columns, NULL as ``null``; joined, as a formatter reads its template for each row."""
    first, *rest = template.split("%s")
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.concat(F.lit(first), *[part for value, text in zip(filled, rest) for part in (value, F.lit(text))])


def _two_digits(sql: str) -> Column:
    digits = F.coalesce(F.expr(sql).cast("string"), F.lit("null"))
    return F.when(F.expr(f"({sql}) BETWEEN 0 AND 9"), F.concat(F.lit("0"), digits)).otherwise(digits)


def returns_feed(t: Tables) -> DataFrame:
    """All 86 raw text columns, one row per line item."""
    base = spread_over_cores(t.lineitem).select(
        "*",
        F.expr(FAULT).alias("fault"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("day"),
        F.expr("(l_partkey * 37 + l_linenumber * 11) % 86400").alias("sec"),
    ).withColumns({
        "hms": F.concat_ws(":", _two_digits("sec div 3600"), _two_digits("sec div 60 % 60"), _two_digits("sec % 60")),
        "main": _text(
            '{"articleNo":"A%s","articleName":"part %s, line %s","price":%s,"quantity":%s,'
            '"priceDetails":{"pricePaid":%s,"pricePaidNoTax":1.5},"customFields":{"gross_weight":"%s"}}',
            "l_partkey", "l_partkey", "l_linenumber", "price", "qty", "price", "l_suppkey",
        ),
        "other": _text('{"articleNo":"B%s","price":1.5}', "l_suppkey"),
        "cut": _text('{"articleNo":"A%s","price":%s', "l_partkey", "price"),
    })
    fault = F.col("fault")
    lists = {
        0: _text("[%s,%s", "other", "cut"),
        1: _text('[{"articleNo":"A%s","na', "l_partkey"),
        2: _text('[{"articleNo":" a%s ","price":%s},%s]', "l_partkey", "price", "other"),
        3: _text("[%s]", "other"),
        4: _text("[%s,%s]", "main", "main"),
        5: _text(r'[{"articleNo":"A%s","articleName":"part %s\, big","price":%s}]', "l_partkey", "l_partkey", "price"),
        7: F.lit(None).cast("string"),
        8: F.lit(" null "),
        9: F.lit("[]"),
        10: _text("[%s", "cut"),
        11: _text('[{"articleNo":"A%s","price":%s,"quantity":"many"}]', "l_partkey", "price"),
        12: F.col("main"),
        13: _text("[null,%s]", "main"),
        14: _text('[{"articleNo":"a%s"},{"articleNo":" A%s"}]', "l_partkey", "l_partkey"),
    }
    articles = _text("[%s,%s]", "other", "main")
    for n, text in lists.items():
        articles = F.when(fault == n, text).otherwise(articles)
    obj = _text(
        '{"isAdditionalLabel":%s,"originalCourier":"C%s","labelCost":%s,"shopifyOrderTags":["a","b"],'
        '"outboundCustomFields":{"PaymentType":"P%s","InvoiceAddr":"street %s","totalPrice":%s,'
        '"productRecommendations":{"primary_skn%s":"%s"}},"pickupWindow":{"from":"%s"},"key%s":1}',
        "late", "l_suppkey", "l_linenumber", "l_linestatus", "l_orderkey", "price", "l_linenumber", "l_partkey", "day",
        "l_linenumber",
    )
    broken = fault.isin(6, 10)
    null = F.lit("null")
    made = {
        "id": _text("rt%s", "l_orderkey"),
        "order_no": F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
        "customer_no": F.lpad(F.col("l_suppkey").cast("string"), 10, "0"),
        "tracking_number": F.when(F.expr("l_orderkey % 6 = 0"), "1.5502E+13").otherwise(_text("ZR%s", "l_orderkey")),
        "updated": F.concat_ws(" ", "day", F.substring("hms", 1, 5)),
        "activity_monitor_last_update": F.when(F.expr("l_partkey % 9 = 0"), "38:26.6").otherwise(
            F.concat_ws(" ", "day", F.substring("hms", 1, 5))
        ),
        "refreshed_date": F.lit("15:08.8"),
        "order_date": F.when(F.expr("l_orderkey % 5 = 0"), null).otherwise(F.col("day")),
        "order_time": F.when(F.expr("l_orderkey % 7 = 0"), null).otherwise(F.col("hms")),
        "delivery_date": F.when(F.expr("l_orderkey % 4 = 0"), "31/02/2024").otherwise(F.col("day")),
        "delivery_time": F.col("hms"),
        "parcellab_system_created_date": F.col("day"),
        "created_time": F.col("hms"),
        "promise_date": F.when(F.expr("l_suppkey % 3 = 0"), " null").otherwise(F.col("day")),
        "claimed_date": F.when(F.expr("l_suppkey % 10 = 1"), F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise(F.col("day")),
        "is_returns_portal": F.expr("CASE l_returnflag WHEN 'R' THEN 't' WHEN 'A' THEN 'f' ELSE 'null' END"),
        "is_cancelled": F.expr("CASE l_linestatus WHEN 'O' THEN 't' ELSE 'x' END"),
        "delta_between_announced_and_actual_dispatch": F.expr(
            "CASE WHEN l_partkey % 11 = 0 THEN concat('n/a ', l_linenumber) WHEN l_partkey % 13 = 0 THEN 'null' "
            "ELSE string(qty - 25) END"
        ),
        "n_days_order_until_first_attempt": F.expr("string(l_linenumber)"),
        "article_number": _text("A%s", "l_partkey"),
        "article_price": F.concat("price", F.lit("00000000000006")),
        "return_quantity": F.expr("string(qty)"),
        "articles": articles,
        "custom_fields": F.when(broken, F.expr("left(object, length(object) - 1)")).otherwise(F.col("object")),
    }
    flags = {c: F.lit("f") for c in layout.FLAGS if c not in made}
    ready = base.withColumn("late", F.expr("CASE WHEN l_linenumber > 3 THEN 'true' ELSE 'false' END")).withColumn("object", obj)
    return ready.select(*[made.get(c, flags.get(c, null)).alias(c) for c in layout.RAW_COLUMNS])


# The same faults for the checking SQL, from the original values alone.
RETURNS_SQL = f"""
WITH f AS (
  SELECT *, {FAULT} AS fault, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS INTEGER) AS qty, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS order_no,
         'A' || l_partkey AS article_number,
         l_shipdate + to_seconds((l_partkey * 37 + l_linenumber * 11) % 86400) AS at_second
  FROM lineitem
), g AS (
  SELECT *,
    CASE WHEN fault IN (0, 1, 10) THEN 'articles_parse_failed'
         WHEN fault IN (2, 3, 7, 8, 9, 14) THEN 'articles_no_match'
         WHEN fault = 4 THEN 'articles_duplicate_match'
         WHEN fault = 6 THEN 'custom_fields_parse_failed' END AS found_type,
    CASE WHEN fault IN (5, 6, 11, 12, 13, 15) THEN 1 WHEN fault = 4 THEN 2 ELSE 0 END AS match_count,
    fault IN (0, 1, 10) AS list_failed,
    fault IN (6, 10) AS object_failed,
    fault IN (0, 2) AS repaired,
    fault NOT IN (5, 11, 12, 13, 15) AS faulty
  FROM f
)
"""


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """CSV files as a feed delivers them: header, doubled quotes, text as it is.

    A wide feed repeats names and sentinels in every row: packed it takes a fraction of the disk. Packed files cannot be
    split, and neither can multi-line ones.
    """
    out = df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    out.option("ignoreTrailingWhiteSpace", False).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path, compression=compression)
    return path
