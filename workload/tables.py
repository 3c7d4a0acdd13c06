"""Sources, sinks and incremental loads: whole tables written to the shared folder and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from sievework.contracts import Contract
from sievework.plans import ingest
from sievework.session import shared_folder
from sievework.sinks import keyed, snapshots
from sievework.sinks.tables import publish_view, read_back, verify_write, write_table
from sievework.sources.files import identify_files, literal_rows, load_typed_csv, read_table, read_text_csv
from sievework.streaming import incremental

from .columns import DOCUMENTS
from .feeds import write_csv
from .registry import query


@query("a1_multiline_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def multiline_csv(t):
    """Texts with line breaks, quotes and commas survive the file."""
    path = write_csv(t.documents.select("doc_id", "text", "lang", "n_chars"), shared_folder(t.spark, "a1"))
    return read_text_csv(t.spark, path)


@query(
    "a2_text_csv",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part""",
)
def text_csv(t):
    path = write_csv(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), shared_folder(t.spark, "a2"))
    return read_text_csv(t.spark, path, multiline=False, spread=4)


@query("a4_catalog_table", "SELECT * FROM customer WHERE c_acctbal > 0")
def catalog_table(t):
    """A table known by name only; the filter still reaches its files."""
    name = f"customers_{uuid.uuid4().hex[:12]}"
    publish_view(t.customer, name)
    return read_table(t.spark, name).filter("c_acctbal > 0")


@query(
    "a6_literal_rows",
    """SELECT o_orderstatus AS status, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'in part' END AS meaning,
              count(*) AS n_orders FROM orders GROUP BY 1""",
)
def literal_meanings(t):
    """Rows written out in code, beside what the table holds."""
    rows = literal_rows(t.spark, [("F", "finished"), ("O", "open"), ("P", "in part")], "status string, meaning string")
    orders = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n_orders"))
    return orders.join(rows, "status")


@query("b2_catalog_table_overwritten", "SELECT * FROM supplier")
def catalog_table_overwritten(t):
    name, path = f"supplier_{uuid.uuid4().hex[:12]}", shared_folder(t.spark, "b2")
    n = 0
    for df in (t.supplier.filter("s_acctbal < 0"), t.supplier):
        n = write_table(df, path, table=name)
    stored = read_back(t.spark, table=name)
    verify_write(n, stored)
    return stored


ORDERS_FILE = Contract("orders", "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderstatus string, total decimal(18,2)")


@query(
    "a5_typed_load",
    "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders",
)
def typed_load(t):
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp"), "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
    )
    return load_typed_csv(t.spark, write_csv(orders, shared_folder(t.spark, "a5")), ORDERS_FILE)


@query("b1_write_and_verify", "SELECT * FROM supplier")
def write_and_verify(t):
    """Overwritten twice; the second write replaces the first, and its count is checked."""
    path = shared_folder(t.spark, "b1")
    write_table(t.supplier.withColumn("s_acctbal", -F.col("s_acctbal")), path)
    n = write_table(t.supplier, path)
    stored = read_back(t.spark, path)
    verify_write(n, stored)
    return stored


@query("b8_snapshot_replaced", "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 2 AS DECIMAL(12,2)) AS balance FROM customer")
def snapshot_replaced(t):
    """Each run reads the one before it and becomes current in one step."""
    base = shared_folder(t.spark, "b8")
    balance = F.col("c_acctbal").cast("decimal(12,2)").alias("balance")
    snapshots.write_snapshot(t.customer.select("c_custkey", balance), base)
    for _ in range(2):
        now = snapshots.read_snapshot(t.spark, base)
        snapshots.write_snapshot(now.withColumn("balance", (F.col("balance") + 1).cast("decimal(12,2)")), base)
    return snapshots.read_snapshot(t.spark, base)


@query(
    "q3_partition_overwrite",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' THEN 'again' ELSE event_type END
         AS event_type, CAST(ts AS DATE) AS ingestion_date FROM events""",
)
def partition_overwrite(t):
    """One day is loaded again; the other days stay."""
    path = shared_folder(t.spark, "q3")
    days = t.events.select("event_id", "event_type", F.to_date("ts").alias("ingestion_date"))
    write_table(days, path, partition_by=["ingestion_date"])
    again = days.filter(F.col("ingestion_date") == dt.date(2024, 1, 10)).withColumn("event_type", F.lit("again"))
    write_table(again, path, partition_by=["ingestion_date"])
    return read_back(t.spark, path)


@query(
    "q4_drift_set_aside",
    """SELECT 'unexpected_column page' AS drift, count(*) AS rejected, CAST(0 AS BIGINT) AS accepted,
              (SELECT count(*) FROM documents) AS stored FROM documents""",
)
def drift_set_aside(t):
    """A batch with a new column goes to the quarantine, whole."""
    path = shared_folder(t.spark, "q4")
    done = ingest.load(t.documents.withColumn("page", F.lit(1)), DOCUMENTS, lambda good: good.count(), path)
    stored = read_back(t.spark, path).agg(F.count("*").alias("stored"))
    rule, column, _ = done.drift[0]
    return stored.select(
        F.lit(f"{rule} {column}").alias("drift"), F.lit(done.rejected).cast("bigint").alias("rejected"),
        F.lit(done.accepted).cast("bigint").alias("accepted"), "stored",
    )


@query(
    "n7_load_by_contract",
    """WITH d AS (SELECT length(text) > 5000 OR count(*) OVER (PARTITION BY text) > 1 AS bad FROM documents)
       SELECT unnest(['accepted', 'rejected']) AS outcome,
              unnest([count(*) FILTER (NOT bad), count(*) FILTER (bad)]) AS n_rows FROM d""",
)
def load_by_contract(t):
    base = shared_folder(t.spark, "n7")
    ingest.load(t.documents, DOCUMENTS, lambda good: write_table(good, f"{base}/good"), f"{base}/bad")
    parts = [
        read_back(t.spark, f"{base}/{which}").agg(F.lit(name).alias("outcome"), F.count("*").alias("n_rows"))
        for which, name in (("good", "accepted"), ("bad", "rejected"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "q6_mislabelled_files",
    """SELECT 'orders' AS labelled, 'customer' AS content, count(*) AS n_rows FROM customer
       UNION ALL SELECT 'customer', 'part', count(*) FROM part
       UNION ALL SELECT 'part', 'orders', count(*) FROM orders
       UNION ALL SELECT 'other', NULL, count(*) FROM supplier""",
)
def mislabelled_files(t):
    base = shared_folder(t.spark, "q6")
    known = [Contract(n, getattr(t, n).schema) for n in ("customer", "part", "orders")]
    for label, df in {"orders": t.customer, "customer": t.part, "part": t.orders, "other": t.supplier}.items():
        write_csv(df, f"{base}/{label}")
    files = identify_files(t.spark, f"{base}/*", known)
    label = F.regexp_extract("file", r"/(\w+)/[^/]*$", 1).alias("labelled")
    return files.groupBy(label, "content").agg(F.sum(F.col("n_lines") - 1).alias("n_rows"))


NEWEST_SQL = """SELECT user_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


@query("q2_stream_upsert", NEWEST_SQL)
def stream_upsert(t):
    """The events arrive as files, two to a batch, and are merged into one row per user."""
    where = shared_folder(t.spark, "q2")
    events = t.events.select("user_id", "ts", "event_type", "value")
    events.repartition(4, "event_type").write.parquet(f"{where}/in")
    stream = incremental.arrivals(t.spark, f"{where}/in", events.schema, files_per_batch=2)
    incremental.keep_merged(stream, f"{where}/users", f"{where}/progress", ["user_id"], "ts", buckets=16)
    return keyed.read(t.spark, f"{where}/users")


@query("q1_load_from_stored_mark", NEWEST_SQL)
def load_from_stored_mark(t):
    """The first load has the events of two weeks, the second all; the third finds its mark and changes nothing."""
    base = shared_folder(t.spark, "q1")
    events = t.events.select("user_id", "ts", "event_type", "value")
    for source in (events.filter(F.col("ts") <= dt.datetime(2024, 1, 15)), events, events):
        incremental.load_new(source, base, ["user_id"], "ts", buckets=16)
    return keyed.read(t.spark, base)


def _two_loads(t, base, times=1):
    """The events up to a high-water mark, then those past it, as often as asked."""
    events = t.events.select("user_id", "ts", "event_type", "value")
    mark = dt.datetime(2024, 1, 15)
    for part in (events.filter(F.col("ts") <= mark), *[events.filter(F.col("ts") > mark)] * times):
        keyed.merge(part, base, ["user_id"], "ts", buckets=16)
    return keyed.read(t.spark, base)


@query("q2_snapshot_upsert", NEWEST_SQL)
def snapshot_upsert(t):
    """The same as two batch loads around a high-water mark."""
    return _two_loads(t, shared_folder(t.spark, "q2"))


@query("q2_twice", NEWEST_SQL)
def snapshot_upsert_twice(t):
    """The second load comes twice."""
    return _two_loads(t, shared_folder(t.spark, "q2"), 2)
