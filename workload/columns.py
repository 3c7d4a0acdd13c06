"""Clean-up of single columns: text written from typed values with faults, read back, and checked."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Iterable

from pyspark.sql import functions as F

from sievework.contracts import Contract
from sievework.functions import scalars, text
from sievework.layouts import returns as layout
from sievework.operators import cleaning, integrity, keys, profiling
from sievework.plans import candidate_keys, ingest, returns
from sievework.sources.files import literal_rows

from .feeds import MONEY, RETURNS_SQL, returns_feed
from .registry import query


@query(
    "c1_standardize_names",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS market_segment FROM customer",
)
def standardize_names(t):
    messy = t.customer.select(
        F.col("c_custkey").alias(" Customer ID"),
        F.col("c_name").alias("CUSTOMER\tName "),
        F.col("c_mktsegment").alias("Market  Segment"),
    )
    return cleaning.standard_names(messy)


@query(
    "c2_sentinel_nulls",
    RETURNS_SQL
    + """SELECT order_no, CASE WHEN l_orderkey % 5 <> 0 THEN strftime(l_shipdate, '%d/%m/%Y') END AS order_date,
             CASE WHEN l_orderkey % 7 <> 0 THEN strftime(at_second, '%H:%M:%S') END AS order_time,
             CASE WHEN l_suppkey % 3 <> 0 THEN strftime(l_shipdate, '%d/%m/%Y') END AS promise_date,
             CASE WHEN fault IN (7, 8) THEN 0 ELSE 1 END AS has_list, CAST(NULL AS VARCHAR) AS courier_code FROM f""",
)
def sentinel_nulls(t):
    df = cleaning.null_sentinels(returns_feed(t))
    has = F.col("articles").isNotNull().cast("int").alias("has_list")
    return df.select("order_no", "order_date", "order_time", "promise_date", has, "courier_code")


@query(
    "c2_sentinel_set",
    """SELECT doc_id, CASE WHEN lang NOT IN ('fr', 'de') THEN lang END AS lang,
              CASE WHEN source <> 'src0' THEN source END AS source, text FROM documents""",
)
def sentinel_set(t):
    df = t.documents.select("doc_id", F.concat(F.lit(" "), "lang").alias("lang"), "source", "text")
    out = cleaning.null_sentinels(df, ["fr", "de", "src0"])
    return out.withColumn("lang", F.trim("lang"))


def nulls(kind: str, columns: Iterable[str]) -> str:
    """Columns that the feed leaves empty, in SQL."""
    return "".join(f", CAST(NULL AS {kind}) AS {c}" for c in columns)


@query(
    "c3_tf_flags",
    RETURNS_SQL
    + "SELECT order_no, article_number, CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_returns_portal, "
    + "l_linestatus = 'O' AS is_cancelled"
    + "".join(f", false AS {c}" for c in layout.FLAGS if c not in ("is_returns_portal", "is_cancelled"))
    + " FROM g",
)
def tf_flags(t):
    """All flags of the feed; a text that is neither t nor a sentinel is false."""
    return _clean(t, "article_number", *layout.FLAGS)


@query(
    "c4_tristate_bool",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true
                               WHEN o_orderpriority = '3-MEDIUM' THEN false END AS urgent FROM orders""",
)
def tristate_bool(t):
    said = F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'TRUE' WHEN '2-HIGH' THEN 'Yes' WHEN '3-MEDIUM' THEN 'NO' "
        "WHEN '5-LOW' THEN ' false' ELSE 'maybe' END"
    )
    return t.orders.select("o_orderkey", text.tri_state(said).alias("urgent"))


# raw columns with values of their own; the other flags are "f", all else is "null"
FILLED = """
id order_no customer_no tracking_number updated activity_monitor_last_update refreshed_date order_date order_time
delivery_date delivery_time parcellab_system_created_date created_time promise_date claimed_date
delta_between_announced_and_actual_dispatch n_days_order_until_first_attempt article_number article_price
return_quantity articles custom_fields
""".split()
EMPTY_MOMENTS = [c for c in layout.MOMENTS if c not in ("order_ts", "delivery_ts", "parcellab_created_ts")]
# rows of the checking SQL in which a column holds a sentinel
SENTINEL_ROWS = {c: "false" if c in (*FILLED, *layout.FLAGS) else "true" for c in layout.RAW_COLUMNS} | {
    "order_date": "l_orderkey % 5 = 0",
    "order_time": "l_orderkey % 7 = 0",
    "promise_date": "l_suppkey % 3 = 0",
    "is_returns_portal": "l_returnflag = 'N'",
    "delta_between_announced_and_actual_dispatch": "l_partkey % 11 <> 0 AND l_partkey % 13 = 0",
    "articles": "fault = 8",
}
SENTINEL_NAMES = ", ".join(f"'{c}'" for c in SENTINEL_ROWS)
SENTINEL_COUNTS = ", ".join(f"count(*) FILTER ({rows})" for rows in SENTINEL_ROWS.values())

CLEAN_SQL = (
    RETURNS_SQL
    + """SELECT order_no, {columns} FROM g"""
)


def _clean(t, *columns):
    return returns.clean(returns_feed(t)).select("order_no", *columns)


@query(
    "c5_date_time_pairs",
    CLEAN_SQL.format(
        columns="""CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 THEN at_second END AS order_ts,
        CASE WHEN l_orderkey % 4 <> 0 THEN at_second END AS delivery_ts, at_second AS parcellab_created_ts"""
        + nulls("TIMESTAMP", EMPTY_MOMENTS)
    ),
)
def date_time_pairs(t):
    return _clean(t, *layout.MOMENTS)


@query("c6_assumed_pair", CLEAN_SQL.format(columns="at_second AS parcellab_created_ts"))
def assumed_pair(t):
    return _clean(t, "parcellab_created_ts")


@query(
    "c7_single_timestamp",
    CLEAN_SQL.format(
        columns="""date_trunc('minute', at_second) AS updated_ts, CASE WHEN l_partkey % 9 <> 0
        THEN date_trunc('minute', at_second) END AS activity_monitor_last_update_ts, '15:08.8' AS refreshed_date"""
    ),
)
def single_timestamp(t):
    return _clean(t, "updated_ts", "activity_monitor_last_update_ts", "refreshed_date")


@query(
    "c8_dates",
    CLEAN_SQL.format(
        columns="""CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) END AS promise_dt,
        CASE WHEN l_suppkey % 10 <> 1 THEN CAST(l_shipdate AS DATE) END AS claimed_dt"""
        + nulls("DATE", ["cancelled_dt", "return_to_sender_dt"])
    ),
)
def dates(t):
    return _clean(t, *layout.DATES)


@query("c9_decimal", CLEAN_SQL.format(columns="price AS article_price"))
def decimal(t):
    return _clean(t, "article_price")


@query(
    "c10_int",
    CLEAN_SQL.format(
        columns="""CASE WHEN l_partkey % 11 <> 0 AND l_partkey % 13 <> 0 THEN qty - 25 END
        AS delta_between_announced_and_actual_dispatch, l_linenumber AS n_days_order_until_first_attempt"""
        + nulls("INTEGER", [c for c in layout.DAY_COUNTS if c not in FILLED])
    ),
)
def whole_numbers(t):
    return _clean(t, *layout.DAY_COUNTS)


@query(
    "c11_native_or_iso_timestamp",
    "SELECT event_id, ts AS native, CASE WHEN event_type <> 'error' THEN ts END AS from_text FROM events",
)
def iso_timestamp(t):
    written = F.when(F.col("event_type") == "error", "no time").otherwise(F.col("ts").cast("string"))
    return t.events.select(
        "event_id",
        scalars.timestamp_of(F.col("ts"), None).alias("native"),
        scalars.timestamp_of(written, None).alias("from_text"),
    )


@query(
    "c13_text_defaults",
    """SELECT doc_id, trim(text) AS text, CASE WHEN lang = 'en' THEN 'Unknown Product' ELSE lang END AS lang,
              CASE WHEN source = 'src1' THEN '' ELSE source END AS kept_empty,
              CASE WHEN source = 'src1' THEN 'none' ELSE source END AS empty_defaulted,
              CASE WHEN source = 'src2' THEN 'unknown' ELSE lower(source) END AS lowered FROM documents""",
)
def text_defaults(t):
    blank = F.when(F.col("source") == "src1", "  ").otherwise(F.concat("source", F.lit(" ")))
    return t.documents.select(
        "doc_id",
        text.tidy(F.col("text")).alias("text"),
        text.tidy(F.when(F.col("lang") != "en", F.concat(F.lit(" "), "lang")), "Unknown Product").alias("lang"),
        text.tidy(blank, "none").alias("kept_empty"),
        text.tidy(blank, "none", empty_as_null=True).alias("empty_defaulted"),
        text.tidy_lower(F.when(F.col("source") != "src2", F.upper("source")), "unknown").alias("lowered"),
    )


@query(
    "c15_numeric_default",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END
              AS DECIMAL(10,2)) AS order_total FROM orders""",
)
def numeric_default(t):
    said = F.when(F.col("o_orderstatus") == "P", "abc").otherwise(F.col("o_totalprice").cast(MONEY).cast("string"))
    return t.orders.select("o_orderkey", scalars.money_or_zero(said).alias("order_total"))


@query(
    "c16_load_time",
    "SELECT o_orderkey, TIMESTAMP '2026-07-01 06:00:00' AS ingestion_timestamp FROM orders",
)
def load_time(t):
    return t.orders.select("o_orderkey", scalars.load_time(dt.datetime(2026, 7, 1, 6)).alias("ingestion_timestamp"))


@query("c18_output_order", "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders")
def output_order(t):
    return cleaning.in_order(t.orders, ["o_custkey", "o_orderkey"], ["o_orderstatus", "o_custkey"], ["o_totalprice"])


@query(
    "c20_damaged_ids",
    CLEAN_SQL.format(columns="lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS customer_no, l_orderkey % 6 = 0 AS damaged"),
)
def damaged_ids(t):
    return _clean(t, "customer_no", text.scientific_id(F.col("tracking_number")).alias("damaged"))


@query("d5_shape_filter", "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z.]+/')")
def shape_filter(t):
    return t.pages.select("page_id", "url").filter(profiling.misshapen(F.col("url"), "^https?://[a-z.]+/"))


@query(
    "m1_sentinel_profile",
    RETURNS_SQL
    + f"""SELECT * FROM (SELECT unnest([{SENTINEL_NAMES}]) AS column_name, unnest([{SENTINEL_COUNTS}]) AS sentinels FROM f)
       WHERE sentinels > 0""",
)
def sentinel_profile(t):
    return profiling.sentinel_profile(returns_feed(t), layout.RAW_COLUMNS)


DAY_SHAPE = r"^\d{2}/\d{2}/\d{4}$"
SHAPES = (
    dict.fromkeys(layout.DAY_COUNTS, scalars.WHOLE_NUMBER)
    | dict.fromkeys(layout.TIMESTAMPS.values(), scalars.DAY_MINUTE_SHAPE)
    | dict.fromkeys([*layout.DATES.values(), *(day for day, _ in layout.MOMENTS.values())], DAY_SHAPE)
)
BADLY_SHAPED = ("delta_between_announced_and_actual_dispatch", "activity_monitor_last_update", "claimed_date")


@query(
    "m2_shape_audit",
    RETURNS_SQL
    + """, bad AS (
         SELECT 'delta_between_announced_and_actual_dispatch' AS column_name, 'n/a ' || l_linenumber AS value
         FROM f WHERE l_partkey % 11 = 0
         UNION ALL SELECT 'activity_monitor_last_update', '38:26.6' FROM f WHERE l_partkey % 9 = 0
         UNION ALL SELECT 'claimed_date', strftime(l_shipdate, '%Y-%m-%d') FROM f WHERE l_suppkey % 10 = 1
       ), firsts AS (SELECT column_name, string_agg(value, '|' ORDER BY value) AS samples FROM (
         SELECT DISTINCT column_name, value, dense_rank() OVER (PARTITION BY column_name ORDER BY value) AS place FROM bad)
         WHERE place <= 5 GROUP BY 1)
       SELECT column_name, count(*) AS misshapen, any_value(samples) AS samples FROM bad JOIN firsts USING (column_name)
       GROUP BY 1 UNION ALL SELECT * FROM (SELECT unnest(["""
    + ", ".join(f"'{c}'" for c in SHAPES if c not in BADLY_SHAPED)
    + """]), 0, NULL)""",
)
def shape_audit(t):
    return profiling.shape_audit(returns_feed(t), SHAPES).withColumn("samples", F.array_join("samples", "|"))


@query(
    "m3_null_reconcile",
    RETURNS_SQL
    + f"""SELECT unnest([{SENTINEL_NAMES}]) AS column_name, unnest([{SENTINEL_COUNTS}]) AS expected,
              unnest([{SENTINEL_COUNTS}]) AS introduced, true AS agrees FROM f""",
)
def null_reconcile(t):
    return profiling.null_reconciliation(
        returns_feed(t),
        {c: text.blank_sentinel(F.col(c)) for c in layout.RAW_COLUMNS},
        {c: text.is_sentinel(F.col(c)) for c in layout.RAW_COLUMNS},
    )


@query(
    "m4_corrupt_timestamps",
    """SELECT 'activity_monitor_last_update' AS column_name, count(*) AS n FROM lineitem WHERE l_partkey % 9 = 0
       UNION ALL SELECT 'updated', 0""",
)
def corrupt_timestamps(t):
    columns = layout.TIMESTAMPS.values()
    return profiling.tally(returns_feed(t), {c: profiling.misshapen(F.col(c), scalars.DAY_MINUTE_SHAPE) for c in columns})


LINE_COLUMNS = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag
l_linestatus l_shipdate""".split()
LINE_SETS = [(c,) for c in LINE_COLUMNS] + list(itertools.combinations(LINE_COLUMNS, 2))


@query(
    "m5_minimal_keys",
    "WITH sets AS ("
    + " UNION ALL ".join(
        f"SELECT {list(s)} AS cols FROM lineitem HAVING count(DISTINCT row({', '.join(s)})) = count(*)"
        for s in LINE_SETS
    )
    + """) SELECT array_to_string(cols, ',') AS key FROM sets s
         WHERE NOT EXISTS (SELECT 1 FROM sets k WHERE len(k.cols) < len(s.cols) AND list_has_all(s.cols, k.cols))""",
)
def minimal_keys(t):
    """Of all columns and pairs of columns of the line items."""
    found = candidate_keys.minimal_keys(t.lineitem.select(*LINE_COLUMNS))
    return literal_rows(t.spark, [(",".join(k),) for k in found], "key string")


@query(
    "m5_key_uniqueness",
    """SELECT 'l_orderkey' AS key, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_distinct, false AS is_unique FROM lineitem
       UNION ALL SELECT 'l_orderkey,l_linenumber', count(*), count(DISTINCT (l_orderkey, l_linenumber)),
         count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def key_uniqueness(t):
    return profiling.key_uniqueness(t.lineitem, [["l_orderkey"], ["l_orderkey", "l_linenumber"]])


@query(
    "a7_fingerprint",
    "SELECT n_rows, count(*) AS n_keys FROM (SELECT count(*) AS n_rows FROM lineitem GROUP BY ALL) GROUP BY 1"
    .replace("GROUP BY ALL", "GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey"),
)
def fingerprint(t):
    """Rows per key, by how many rows share it."""
    keyed = keys.fingerprint(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    per_key = profiling.histogram(keyed, "_row_key")
    return per_key.groupBy("n_rows").agg(F.count("*").alias("n_keys"))


@query("a7_row_uid", "SELECT count(*) AS n_rows, count(*) AS n_keys FROM lineitem")
def row_uid(t):
    numbered = keys.number_rows(t.lineitem)
    return numbered.agg(F.count("*").alias("n_rows"), F.count_distinct("_row_uid").alias("n_keys"))


DOCUMENTS = Contract(
    "documents",
    "doc_id bigint, text string, lang string, source string, n_chars bigint",
    key=("text",),
    required=("doc_id", "lang"),
    max_length={"text": 5000, "lang": 2},
    text_ids=("source",),
)


@query(
    "b7_contract_violations",
    """SELECT 'not_null' AS rule, unnest(['text', 'doc_id', 'lang']) AS column_name,
              unnest([count(*) FILTER (text IS NULL), count(*) FILTER (doc_id IS NULL), count(*) FILTER (lang IS NULL)]) AS violations
       FROM documents
       UNION ALL SELECT 'max_length', unnest(['text', 'lang']),
              unnest([count(*) FILTER (length(text) > 5000), count(*) FILTER (length(lang) > 2)]) FROM documents
       UNION ALL SELECT 'scientific_id', 'source', 0
       UNION ALL SELECT 'unique', 'text', CAST(coalesce(sum(n), 0) AS BIGINT)
         FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)""",
)
def contract_violations(t):
    return integrity.contract_counts(t.documents, DOCUMENTS)


CONTRACT_SQL = """
WITH d AS (SELECT doc_id, source, concat_ws(',', CASE WHEN length(text) > 5000 THEN 'max_length:text' END,
             CASE WHEN count(*) OVER (PARTITION BY text) > 1 THEN 'unique:text' END) AS violations FROM documents)
"""


@query("b7_accepted_rows", CONTRACT_SQL + "SELECT doc_id, source FROM d WHERE violations = ''")
def accepted_rows(t):
    return integrity.split_by_contract(t.documents, DOCUMENTS)[0].select("doc_id", "source")


@query("b7_rejected_rows", CONTRACT_SQL + "SELECT doc_id, source, violations FROM d WHERE violations <> ''")
def rejected_rows(t):
    bad = integrity.split_by_contract(t.documents, DOCUMENTS)[1]
    return bad.select("doc_id", "source", F.array_join("violations", ",").alias("violations"))


RUN_AT = dt.datetime(2026, 7, 1, 6)


@query(
    "n7_prepare_products",
    """SELECT CASE WHEN p_size % 10 <> 3 THEN CAST(p_partkey AS INTEGER) END AS product_id,
              CASE WHEN p_size % 7 = 0 THEN 'Unknown Product' ELSE p_name END AS product_name, p_brand AS category,
              CAST(p_retailprice AS DECIMAL(10,2)) AS price,
              CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false END AS is_active,
              TIMESTAMP '2026-07-01 06:00:00' AS ingestion_timestamp FROM part""",
)
def prepare_products(t):
    raw = t.part.select(
        F.expr("CASE WHEN p_size % 10 = 3 THEN 'x' || p_partkey ELSE string(p_partkey) END").alias("Product ID"),
        F.expr("CASE WHEN p_size % 7 <> 0 THEN concat(' ', p_name) END").alias("PRODUCT_NAME"),
        F.expr("concat(p_brand, ' ')").alias("Category "),
        F.expr("string(cast(p_retailprice AS decimal(10,2)))").alias("price"),
        F.expr("CASE p_size % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' ELSE 'maybe' END").alias("is active"),
    )
    return ingest.prepare_products(raw, RUN_AT)


@query(
    "n7_prepare_orders",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, o_orderdate AS order_date,
              CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE lower(o_orderstatus) END AS status,
              CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS DECIMAL(10,2)) AS order_total,
              TIMESTAMP '2026-07-01 06:00:00' AS ingestion_timestamp FROM orders""",
)
def prepare_orders(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("ORDER  id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.expr("CASE WHEN o_orderstatus <> 'P' THEN concat(' ', o_orderstatus) END").alias("Status"),
        F.expr("CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END").alias("order_total"),
    )
    return ingest.prepare_orders(raw, RUN_AT)
