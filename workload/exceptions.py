"""Embedded lists and objects: parse, match, classify, repair, route, summarise."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sievework.functions import nested
from sievework.layouts import returns as layout
from sievework.operators import cleaning, exceptions as ex, flatten, profiling
from sievework.operators.barriers import where_computed
from sievework.plans import returns
from sievework.session import shared_folder
from sievework.sources.files import read_text_csv

from .feeds import RETURNS_SQL, returns_feed, write_csv
from .registry import query


def _row(t):
    """The line item's own columns beside its raw feed row, sentinels cleared."""
    return cleaning.null_sentinels(
        returns_feed(t).select("order_no", "article_number", "article_price", "articles", "custom_fields")
    )


def _readable(t):
    """The rows whose object can be parsed."""
    return where_computed(ex.parse_object_column(_row(t), returns.OBJECT), ~F.col("custom_fields_parse_failed"))


def _matched(t, spec=returns.ITEMS):
    return ex.match_list(_row(t), spec)


def _marked(t):
    return _matched(t).transform(ex.parse_object_column, returns.OBJECT).transform(
        ex.mark_exceptions, returns.ITEMS, returns.OBJECT
    )


def _repaired(t, **options):
    return ex.repair(_marked(t), returns.ITEMS, returns.OBJECT, **options)


@query("k1_unescape_commas", "SELECT doc_id, replace(text, ' ', ', ') AS text FROM documents")
def unescape_commas(t):
    """Every blank of every text is preceded by an escaped comma; line breaks stay."""
    escaped = F.replace("text", F.lit(" "), F.lit("\\, "))
    return t.documents.select("doc_id", nested.unescape_commas(escaped).alias("text"))


@query(
    "k2_list_parse",
    RETURNS_SQL
    + """SELECT order_no, article_number, CASE WHEN fault IN (0, 1, 7, 8, 10) THEN NULL WHEN fault = 9 THEN 0
             WHEN fault IN (3, 5, 11, 12) THEN 1 ELSE 2 END AS n_items, list_failed FROM g""",
)
def list_parse(t):
    df = _matched(t)
    return df.select("order_no", "article_number", F.array_size(ex.ITEMS).alias("n_items"),
                     F.col("articles_parse_failed").alias("list_failed"))


@query(
    "k3_object_parse",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
              event_type = 'error' AS failed FROM events""",
)
def object_parse(t):
    """The events' own objects; those of error events lack their last character."""
    cut = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    df = t.events.select("event_id", nested.parse_object(cut, "k int").alias("o"))
    return df.select("event_id", F.col("o.k").alias("k"), nested.object_unreadable(F.col("o")).alias("failed"))


@query("k5_object_failed", RETURNS_SQL + "SELECT order_no, article_number, object_failed FROM g")
def object_failed(t):
    df = ex.parse_object_column(_row(t), returns.OBJECT)
    return df.select("order_no", "article_number", F.col("custom_fields_parse_failed").alias("object_failed"))


@query(
    "k6_match",
    RETURNS_SQL
    + """SELECT order_no, article_number, CAST(match_count AS BIGINT) AS articles_match_count, list_failed AS articles_parse_failed,
             CASE WHEN match_count > 0 THEN article_number END AS element, CASE WHEN match_count > 0 THEN price END AS price FROM g""",
)
def match(t):
    df = flatten.narrow_decimals(_matched(t).withColumns({
        "element": F.col(ex.ELEMENT)["articleNo"], "price": F.col(ex.ELEMENT)["price"]
    }), ["price"])
    return df.select("order_no", "article_number", "articles_match_count", "articles_parse_failed", "element", "price")


@query(
    "e8_exactly_one_match",
    RETURNS_SQL + "SELECT order_no, article_number FROM g WHERE match_count = 1",
)
def exactly_one_match(t):
    df = where_computed(_matched(t), nested.only(F.col(ex.EXACT)).isNotNull())
    return df.select("order_no", "article_number")


@query(
    "k7_loose_match",
    RETURNS_SQL
    + """SELECT order_no, article_number, CAST(CASE WHEN fault IN (2, 5, 6, 11, 12, 13, 15) THEN 1 WHEN fault IN (4, 14) THEN 2
             ELSE 0 END AS BIGINT) AS loose_matches FROM g""",
)
def loose_match(t):
    found = nested.matching(F.col(ex.ITEMS), "articleNo", F.col("article_number"), nested.alike)
    return _matched(t).select("order_no", "article_number", nested.hits(found).alias("loose_matches"))


ITEMS_SQL = (
    RETURNS_SQL
    + """, i AS (
  SELECT order_no, 'B' || l_suppkey AS item FROM g WHERE fault IN (2, 3, 6, 15)
  UNION ALL SELECT order_no, article_number FROM g WHERE fault IN (4, 5, 6, 11, 12, 13, 15)
  UNION ALL SELECT order_no, article_number FROM g WHERE fault = 4
  UNION ALL SELECT order_no, ' a' || l_partkey || ' ' FROM g WHERE fault = 2
  UNION ALL SELECT order_no, 'a' || l_partkey FROM g WHERE fault = 14
  UNION ALL SELECT order_no, ' A' || l_partkey FROM g WHERE fault = 14
  UNION ALL SELECT order_no, NULL FROM g WHERE fault = 13)
"""
)


@query("k8_explode_items", ITEMS_SQL + "SELECT * FROM i")
def explode_items(t):
    df = flatten.explode_items(_matched(t).select("order_no", ex.ITEMS), ex.ITEMS)
    return df.select("order_no", F.col("item.articleNo").alias("item"))


@query(
    "k9_explode_keep_empty",
    ITEMS_SQL + "SELECT * FROM i UNION ALL SELECT order_no, NULL FROM g WHERE fault IN (0, 1, 7, 8, 9, 10)",
)
def explode_keep_empty(t):
    df = flatten.explode_items(_matched(t).select("order_no", ex.ITEMS), ex.ITEMS, keep_empty=True)
    return df.select("order_no", F.col("item.articleNo").alias("item"))


@query("k10_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events")
def flatten_object(t):
    df = t.events.select("event_id", nested.parse_object(F.col("props"), "k int").alias("o"))
    return flatten.flatten_struct(df, "o", "props_")


@query(
    "k11_map",
    """SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) % 100 AS k, count(*) AS n_rows FROM events GROUP BY 1""",
)
def open_map(t):
    df = t.events.select(nested.open_keys(F.col("props"))["k"].try_cast("int").alias("k"))
    return profiling.histogram(df.withColumn("k", F.expr("k % 100")), "k")


@query(
    "k12_object_as_text",
    RETURNS_SQL
    + """SELECT order_no, article_number, '{"from":"' || strftime(l_shipdate, '%d/%m/%Y') || '"}' AS pickup_window,
              CAST(l_partkey AS VARCHAR) AS recommended FROM g WHERE NOT object_failed""",
)
def object_as_text(t):
    df = _readable(t)
    o = F.col(ex.OBJECT)
    return df.select(
        "order_no", "article_number", o["pickupWindow"].alias("pickup_window"),
        F.map_values(o["outboundCustomFields"]["productRecommendations"])[0].alias("recommended"),
    )


@query(
    "k15_parse_metrics",
    RETURNS_SQL
    + """SELECT unnest(['list', 'object']) AS parse,
             unnest([count(*) FILTER (list_failed), count(*) FILTER (object_failed)]) AS failures FROM g""",
)
def parse_metrics(t):
    flags = {"list": F.col("articles_parse_failed"), "object": F.col("custom_fields_parse_failed")}
    return profiling.tally(_marked(t), flags, "parse", "failures")


@query(
    "f7_match_histogram",
    RETURNS_SQL + "SELECT CAST(match_count AS BIGINT) AS articles_match_count, count(*) AS n_rows FROM g GROUP BY 1",
)
def match_histogram(t):
    return profiling.histogram(_matched(t), "articles_match_count")


@query(
    "l1_classify",
    RETURNS_SQL + "SELECT order_no, article_number, found_type AS exception_type, faulty AS has_exception FROM g",
)
def classify(t):
    return _marked(t).select("order_no", "article_number", "exception_type", "has_exception")


REPAIR_SQL = """SELECT order_no, article_number, {left} AS exception_type, {left} IS NOT NULL AS has_exception,
    faulty AS repair_attempted, faulty AND {left} IS NULL AS repaired,
    CASE WHEN fault IN (0, 2, 10) OR match_count > 0 THEN price END AS price FROM g"""
LEFT = "CASE WHEN repaired THEN NULL WHEN fault = 10 THEN 'custom_fields_parse_failed' ELSE found_type END"
LEFT_FIRST_FAULT = "CASE WHEN repaired OR fault = 10 THEN NULL ELSE found_type END"


def _repair_state(df):
    price = F.col(ex.ELEMENT)["price"].try_cast("decimal(12,2)").alias("price")
    return df.select("order_no", "article_number", "exception_type", "has_exception", "repair_attempted", "repaired", price)


@query("l6_repair", RETURNS_SQL + REPAIR_SQL.format(left=LEFT))
def repair(t):
    return _repair_state(_repaired(t))


@query("l6_repair_by_first_fault", RETURNS_SQL + REPAIR_SQL.format(left=LEFT_FIRST_FAULT))
def repair_by_first_fault(t):
    """Without looking for a second fault after the repair."""
    return _repair_state(_repaired(t, reclassify=False))


@query(
    "l4_close_truncated",
    RETURNS_SQL + "SELECT order_no, article_number, CAST(fault IN (0, 10) AS BIGINT) AS recovered FROM g WHERE list_failed",
)
def close_truncated(t):
    df = where_computed(_matched(t), F.col("articles_parse_failed"))
    return df.select("order_no", "article_number", nested.hits(ex.closed_list_hits(returns.ITEMS, F.col("articles_parse_failed"))).alias("recovered"))


@query("l7_success", RETURNS_SQL + "SELECT order_no, article_number, repaired FROM g WHERE NOT faulty OR repaired")
def success(t):
    return ex.route(_repaired(t))[0].select("order_no", "article_number", "repaired")


@query(
    "l7_unresolved",
    RETURNS_SQL + f"SELECT order_no, {LEFT} AS exception_type, fault = 7 OR fault = 8 AS no_list FROM g WHERE faulty AND NOT repaired",
)
def unresolved(t):
    bad = ex.route(_repaired(t), ["order_no", "exception_type", "articles", "custom_fields"])[1]
    return bad.select("order_no", "exception_type", F.col("articles").isNull().alias("no_list"))


@query(
    "l7_every_row_routed_once",
    RETURNS_SQL + """SELECT order_no, article_number,
             CASE WHEN NOT faulty OR repaired THEN 'published' ELSE 'unresolved' END AS route FROM g""",
)
def every_row_routed_once(t):
    return _repaired(t).select("order_no", "article_number", ex.route_name(returns.PUBLISHED, returns.UNRESOLVED).alias("route"))


@query(
    "l8_summary",
    RETURNS_SQL
    + """SELECT unnest(['Total input rows', 'Successfully processed rows', 'Rows requiring exception handling',
                        'Rows successfully repaired', 'Rows still unresolved']) AS metric,
                unnest([count(*), count(*) FILTER (NOT faulty OR repaired), count(*) FILTER (faulty),
                        count(*) FILTER (repaired), count(*) FILTER (faulty AND NOT repaired)]) AS value FROM g""",
)
def summary(t):
    return ex.run_summary(_repaired(t))


@query(
    "q5_unknown_keys",
    RETURNS_SQL + "SELECT 'key' || l_linenumber AS json_key, count(*) AS n_rows FROM g WHERE NOT object_failed GROUP BY 1",
)
def unknown_keys(t):
    return flatten.unknown_keys(_readable(t), "custom_fields", layout.custom_fields())


@query(
    "q5_nested_drift",
    RETURNS_SQL + """, r AS (SELECT * FROM g WHERE NOT object_failed)
SELECT '$' AS path, 'unreadable' AS rule, NULL::VARCHAR AS found, count(*) AS n_rows FROM g WHERE object_failed
UNION ALL SELECT '$.key' || l_linenumber, 'unknown_key', 'NUMBER', count(*) FROM r GROUP BY 1
UNION ALL SELECT '$.labelCost', 'type', 'NUMBER', count(*) FROM r
UNION ALL SELECT '$.pickupWindow', 'type', 'OBJECT', count(*) FROM r
UNION ALL SELECT '$.outboundCustomFields.' || unnest(['PaymentType', 'Extra', 'productRecommendations.*']), unnest(['type', 'unknown_key', 'type']),
  unnest(['NUMBER', 'OBJECT', 'ARRAY']), count(*) FROM r WHERE l_linestatus = 'O' GROUP BY 1, 2, 3""",
)
def nested_drift(t):
    """All rows of the feed; in those of open lines a nested value has another type, a nested key is new and a map holds a list."""
    df = returns_feed(t)
    changed = F.regexp_replace("custom_fields", '"PaymentType":"PO"', '"PaymentType":0,"Extra":{"deep":[1]}')
    changed = F.regexp_replace(changed, '("Extra".*"primary_skn[0-9]+":)("[0-9]+")', "$1[$2]")
    return flatten.nested_drift(df.select(changed.alias("custom_fields")), "custom_fields", StructType.fromDDL(layout.CUSTOM_FIELDS))


PUBLISHED_SQL = (
    RETURNS_SQL
    + """SELECT 'rt' || l_orderkey AS id, order_no, article_number,
      CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_returns_portal,
      CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 THEN at_second END AS order_ts,
      CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) END AS promise_dt, price AS article_price,
      CASE WHEN fault = 0 OR fault = 2 OR match_count > 0 THEN price END AS articles_json_price,
      CASE WHEN fault IN (4, 6, 12, 13, 15) THEN qty END AS articles_json_quantity,
      CASE WHEN fault IN (4, 6, 12, 13, 15) THEN price END AS price_paid,
      CASE WHEN fault IN (4, 6, 12, 13, 15) THEN 'part ' || l_partkey || ', line ' || l_linenumber
           WHEN fault = 5 THEN 'part ' || l_partkey || ', big' END AS articles_json_articleName,
      l_linenumber > 3 AS custom_fields_json_isAdditionalLabel, 'C' || l_suppkey AS custom_fields_json_originalCourier,
      'street ' || l_orderkey AS invoice_address,
      CAST(match_count AS BIGINT) AS articles_match_count, repaired
    FROM g WHERE NOT faulty OR repaired"""
)


def _published(df):
    return df.select(
        "id", "order_no", "article_number", "is_returns_portal", "order_ts", "promise_dt", "article_price",
        "articles_json_price", "articles_json_quantity", F.col("articles_json_priceDetails.pricePaid").alias("price_paid"),
        "articles_json_articleName", "custom_fields_json_isAdditionalLabel", "custom_fields_json_originalCourier",
        F.col("custom_fields_json_outboundCustomFields.InvoiceAddr").alias("invoice_address"),
        "articles_match_count", "repaired",
    )


@query("n6_returns", PUBLISHED_SQL)
def returns_published(t):
    """Raw feed to published rows, in one plan."""
    return _published(ex.route(returns.transform(returns_feed(t)))[0])


@query("n6_returns_run", PUBLISHED_SQL)
def returns_run(t):
    """The whole run with its writes; the published table is read back."""
    where = shared_folder(t.spark, "returns")
    done = returns.run(returns_feed(t), f"{where}/tables", f"{where}/exceptions")
    return _published(t.spark.read.parquet(done.path()))


@query("n6_returns_from_files", PUBLISHED_SQL)
def returns_from_files(t):
    """From the feed as multi-line CSV files to the published table."""
    where = shared_folder(t.spark, "returns")
    raw = read_text_csv(t.spark, write_csv(returns_feed(t), f"{where}/daily", "gzip"))
    done = returns.run(raw, f"{where}/tables", f"{where}/exceptions")
    return _published(t.spark.read.parquet(done.path()))


@query(
    "q4_returns_drift",
    RETURNS_SQL
    + """SELECT 'rows' AS file, 'published or unresolved' AS rule, NULL::VARCHAR AS column_name, count(*) AS n FROM g WHERE l_orderkey % 4 <> 3
       UNION ALL SELECT 'three', 'missing_column', 'articles', 1 WHERE EXISTS (SELECT 1 FROM g WHERE l_orderkey % 4 = 3)""",
)
def returns_drift(t):
    """The feed comes in four files: one as the layout says, one with its columns in another order, one with a column more, and
    one whose list has another name. The last is set aside and costs its own rows only."""
    where = shared_folder(t.spark, "drift")
    feed = returns_feed(t).withColumn("quarter", F.substring("id", 3, 20).cast("long") % 4)
    columns = [c for c in feed.columns if c in layout.RAW_COLUMNS]
    shapes = {
        "zero": columns, "one": columns[::-1], "two": [*columns, F.col("order_no").alias("added")],
        "three": [F.col(c).alias("article_list") if c == "articles" else F.col(c) for c in columns],
    }
    for k, (name, shape) in enumerate(shapes.items()):
        write_csv(feed.filter(F.col("quarter") == k).select(*shape), f"{where}/in/{name}", "gzip")
    batch = returns.run_files(t.spark, f"{where}/in/*", f"{where}/tables", f"{where}/exceptions", f"{where}/aside")
    stored = t.spark.read.parquet(f"{where}/tables/run={batch.done.run}")
    rows = stored.agg(F.lit("rows").alias("file"), F.lit("published or unresolved").alias("rule"), F.lit(None).cast("string").alias("column_name"), F.count("*").alias("n"))
    label = F.regexp_extract("file", r"/(\w+)/[^/]*$", 1).alias("file")
    faults = batch.set_aside.groupBy(label, "rule", F.col("column").alias("column_name")).agg((F.count("*") > 0).cast("long").alias("n"))
    return rows.unionByName(faults)


# Expected value of every published column; what is not listed is empty, or false for a flag.
RAW_SQL = {
    "id": "'rt' || l_orderkey", "order_no": "order_no", "customer_no": "lpad(CAST(l_suppkey AS VARCHAR), 10, '0')",
    "tracking_number": "CASE WHEN l_orderkey % 6 = 0 THEN '1.5502E+13' ELSE 'ZR' || l_orderkey END",
    "updated": "day || ' ' || hm", "activity_monitor_last_update": "CASE WHEN l_partkey % 9 = 0 THEN '38:26.6' ELSE day || ' ' || hm END",
    "refreshed_date": "'15:08.8'", "order_date": "CASE WHEN l_orderkey % 5 <> 0 THEN day END",
    "order_time": "CASE WHEN l_orderkey % 7 <> 0 THEN hms END",
    "delivery_date": "CASE WHEN l_orderkey % 4 = 0 THEN '31/02/2024' ELSE day END", "delivery_time": "hms",
    "parcellab_system_created_date": "day", "created_time": "hms", "promise_date": "CASE WHEN l_suppkey % 3 <> 0 THEN day END",
    "claimed_date": "CASE WHEN l_suppkey % 10 = 1 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE day END",
    "is_returns_portal": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END", "is_cancelled": "l_linestatus = 'O'",
    "delta_between_announced_and_actual_dispatch": "CASE WHEN l_partkey % 11 <> 0 AND l_partkey % 13 <> 0 THEN qty - 25 END",
    "n_days_order_until_first_attempt": "l_linenumber", "article_number": "article_number", "article_price": "price",
    "return_quantity": "CAST(qty AS VARCHAR)", "custom_fields": "object",
    "articles": """CASE fault WHEN 0 THEN '[' || other || ',' || cut
      WHEN 2 THEN '[{"articleNo":" a' || l_partkey || ' ","price":' || price || '},' || other || ']'
      WHEN 5 THEN '[{"articleNo":"A' || l_partkey || '","articleName":"part ' || l_partkey || '\\, big","price":' || price || '}]'
      WHEN 11 THEN '[{"articleNo":"A' || l_partkey || '","price":' || price || ',"quantity":"many"}]'
      WHEN 12 THEN main WHEN 13 THEN '[null,' || main || ']' ELSE '[' || other || ',' || main || ']' END""",
    "order_ts": "CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 THEN at_second END",
    "delivery_ts": "CASE WHEN l_orderkey % 4 <> 0 THEN at_second END", "parcellab_created_ts": "at_second",
    "updated_ts": "date_trunc('minute', at_second)",
    "activity_monitor_last_update_ts": "CASE WHEN l_partkey % 9 <> 0 THEN date_trunc('minute', at_second) END",
    "promise_dt": "CASE WHEN l_suppkey % 3 <> 0 THEN l_shipdate END", "claimed_dt": "CASE WHEN l_suppkey % 10 <> 1 THEN l_shipdate END",
}
WHOLE = "fault IN (12, 13, 15)"
PARSED_SQL = {
    "articles_json_articleNo": "CASE fault WHEN 2 THEN ' a' || l_partkey || ' ' ELSE article_number END",
    "articles_json_articleName": f"CASE WHEN {WHOLE} THEN 'part ' || l_partkey || ', line ' || l_linenumber "
    "WHEN fault = 5 THEN 'part ' || l_partkey || ', big' END",
    "articles_json_price": "price", "articles_json_quantity": f"CASE WHEN {WHOLE} THEN qty END",
    "articles_json_priceDetails": f"""CASE WHEN {WHOLE} THEN '{{"pricePaid":' || price || ',"pricePaidNoTax":1.50}}' END""",
    "articles_json_customFields": f"""CASE WHEN {WHOLE} THEN '{{"gross_weight":"' || l_suppkey || '"}}' END""",
    "custom_fields_json_isAdditionalLabel": "l_linenumber > 3", "custom_fields_json_originalCourier": "'C' || l_suppkey",
    "custom_fields_json_labelCost": "CAST(l_linenumber AS VARCHAR)", "custom_fields_json_shopifyOrderTags": """'["a","b"]'""",
    "custom_fields_json_outboundCustomFields": """'{"PaymentType":"P' || l_linestatus || '","InvoiceAddr":"street ' || l_orderkey
      || '","totalPrice":' || CAST(price AS DOUBLE) || ',"productRecommendations":{"primary_skn' || l_linenumber || '":"' || l_partkey || '"}}'""",
    "custom_fields_json_pickupWindow": """'{"from":"' || day || '"}'""",
    "articles_match_count": "CAST(match_count AS BIGINT)", "articles_parse_failed": "list_failed",
    "custom_fields_parse_failed": "object_failed", "has_exception": "false", "repair_attempted": "faulty", "repaired": "repaired",
}
MADE_SQL = """, w AS (SELECT *, strftime(l_shipdate, '%d/%m/%Y') AS day, strftime(at_second, '%H:%M:%S') AS hms,
    strftime(at_second, '%H:%M') AS hm, '{"articleNo":"B' || l_suppkey || '","price":1.5}' AS other,
    '{"articleNo":"A' || l_partkey || '","price":' || price AS cut,
    '{"articleNo":"A' || l_partkey || '","articleName":"part ' || l_partkey || ', line ' || l_linenumber || '","price":' || price
      || ',"quantity":' || qty || ',"priceDetails":{"pricePaid":' || price || ',"pricePaidNoTax":1.5},"customFields":{"gross_weight":"'
      || l_suppkey || '"}}' AS main,
    '{"isAdditionalLabel":' || (l_linenumber > 3) || ',"originalCourier":"C' || l_suppkey || '","labelCost":' || l_linenumber
      || ',"shopifyOrderTags":["a","b"],"outboundCustomFields":{"PaymentType":"P' || l_linestatus || '","InvoiceAddr":"street '
      || l_orderkey || '","totalPrice":' || price || ',"productRecommendations":{"primary_skn' || l_linenumber || '":"' || l_partkey
      || '"}},"pickupWindow":{"from":"' || day || '"},"key' || l_linenumber || '":1}' AS object
  FROM g WHERE NOT faulty OR repaired)
"""
def _fields(ddl: str, prefix: str) -> dict[str, str]:
    """Name and type of the outermost fields; the SQL is written before there is a session to parse it."""
    flat, depth = "", 0
    for c in ddl:
        depth += (c == "<") - (c == ">")
        flat += c if not depth or c == "<" else ""
    return {prefix + name: kind for name, kind in (f.split() for f in flat.split(","))}


KINDS = (
    dict.fromkeys(layout.RAW_COLUMNS, "VARCHAR") | dict.fromkeys(layout.FLAGS, "BOOLEAN")
    | dict.fromkeys(layout.DAY_COUNTS, "INTEGER") | {layout.PRICE: "DECIMAL(12,2)"}
    | dict.fromkeys([*layout.MOMENTS, *layout.TIMESTAMPS], "TIMESTAMP") | dict.fromkeys(layout.DATES, "DATE")
    | _fields(layout.ARTICLE, layout.LIST_PREFIX) | _fields(layout.CUSTOM_FIELDS, layout.OBJECT_PREFIX)
    | {layout.LIST_PREFIX + c: "DECIMAL(12,2)" for c in layout.ARTICLE_MONEY} | dict.fromkeys(layout.CHECK_COLUMNS, "BOOLEAN")
    | {"articles_match_count": "BIGINT", "exception_type": "VARCHAR"}
)


def _all_columns_sql(changed=None):
    known = RAW_SQL | PARSED_SQL | (changed or {})
    columns = []
    for name, kind in KINDS.items():
        value = known.get(name, "false" if name in layout.FLAGS else "NULL")
        written = "VARCHAR" if kind == "string" or "<" in kind else kind
        columns.append(f'CAST({value} AS {written}) AS "{name}"')
    return RETURNS_SQL + MADE_SQL + "SELECT " + ", ".join(columns) + " FROM w"


def _all_columns(published):
    """Every published column but the row key, which is any number; nested ones as JSON."""
    kinds = {f.name: f.dataType for f in published.schema}
    nested_ = (StructType, ArrayType, MapType)
    return published.select(*[
        F.to_json(c).alias(c) if isinstance(kind, nested_) else F.col(c) for c, kind in kinds.items() if c != layout.ROW_KEY
    ])


@query("n6_returns_all_columns", _all_columns_sql())
def returns_all_columns(t):
    where = shared_folder(t.spark, "returns")
    done = returns.run(returns_feed(t), f"{where}/tables", f"{where}/exceptions")
    return _all_columns(t.spark.read.parquet(done.path()))


def _hidden(address: str) -> dict[str, str]:
    column = "custom_fields_json_outboundCustomFields"
    return {
        "custom_fields": """replace(object, '"street ' || l_orderkey || '"', 'null')""",
        column: PARSED_SQL[column].replace("""","InvoiceAddr":"street ' || l_orderkey\n      || '",""", address),
    }


@query("n6_returns_redacted", _all_columns_sql(_hidden("""",""")))
def returns_redacted(t):
    """The published rows with personal members blanked, in the object and in its text."""
    where = shared_folder(t.spark, "returns")
    done = returns.run(returns_feed(t), f"{where}/tables", f"{where}/exceptions", redacted=True)
    return _all_columns(t.spark.read.parquet(done.path()))


@query(
    "q11_redacted_run",
    RETURNS_SQL
    + """SELECT 'rt' || l_orderkey AS id, order_no, object_failed AS text_gone, false AS leaks,
         CASE WHEN NOT object_failed THEN sha256('pepper' || 'street ' || l_orderkey) END AS hashed, false AS listed FROM g""",
)
def redacted_run(t):
    """Every row of a redacted run, published or not: no written column holds an address, nor does the exceptions table."""
    where = shared_folder(t.spark, "returns")
    done = returns.run(returns_feed(t), f"{where}/tables", f"{where}/exceptions", redacted=True, salt="pepper")
    rows = t.spark.read.parquet(f"{done.base}/run={done.run}")
    listed = t.spark.read.parquet(f"{where}/exceptions").filter(F.contains("custom_fields", F.lit("street "))).select(
        F.col(layout.ROW_KEY).alias("_key"), F.lit(True).alias("_listed")
    )
    written = F.to_json(F.struct(*layout.published_columns()))
    # looked through before the join, which so moves a few short columns instead of all written ones
    told = rows.select(
        layout.ROW_KEY, "id", "order_no", F.col("custom_fields").isNull().alias("text_gone"), F.contains(written, F.lit("street ")).alias("leaks"),
        F.col("custom_fields_json_outboundCustomFields.InvoiceAddr").alias("hashed"),
    )
    joined = told.join(listed, F.col(layout.ROW_KEY) == F.col("_key"), "left")
    return joined.select("id", "order_no", "text_gone", "leaks", "hashed", F.coalesce("_listed", F.lit(False)).alias("listed"))


@query(
    "n6_returns_exceptions",
    RETURNS_SQL
    + f"""SELECT 'rt' || l_orderkey AS id, order_no, {LEFT} AS exception_type,
             CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 THEN at_second END AS order_ts,
             date_trunc('minute', at_second) AS updated_ts FROM g WHERE faulty AND NOT repaired""",
)
def returns_exceptions(t):
    where = shared_folder(t.spark, "returns")
    returns.run(returns_feed(t), f"{where}/tables", f"{where}/exceptions")
    return t.spark.read.parquet(f"{where}/exceptions").select("id", "order_no", "exception_type", "order_ts", "updated_ts")


@query(
    "q11_redact",
    RETURNS_SQL
    + """SELECT order_no, article_number, CAST(NULL AS VARCHAR) AS blanked, sha256('pepper' || 'street ' || l_orderkey) AS hashed,
             'P' || l_linestatus AS payment FROM g WHERE NOT object_failed""",
)
def redact(t):
    df = _readable(t)
    df = df.withColumn("outboundCustomFields", F.col(ex.OBJECT)["outboundCustomFields"])
    blank = cleaning.redact(df, layout.PERSONAL_FIELDS).withColumnRenamed("outboundCustomFields", "b")
    both = blank.withColumn("outboundCustomFields", F.col(ex.OBJECT)["outboundCustomFields"])
    both = cleaning.redact(both, layout.PERSONAL_FIELDS, salt="pepper")
    return both.select(
        "order_no", "article_number", F.col("b.InvoiceAddr").alias("blanked"),
        F.col("outboundCustomFields.InvoiceAddr").alias("hashed"), F.col("b.PaymentType").alias("payment"),
    )
