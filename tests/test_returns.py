"""The returns feed from a CSV file to its tables."""

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievework.layouts import returns as layout
from sievework.operators import exceptions as ex
from sievework.plans import returns
from sievework.sinks import snapshots
from sievework.sources.files import read_text_csv
from workload.feeds import write_csv

GOOD = {
    "id": "6a24", "order_no": "007", "customer_no": "0000012467", "tracking_number": "1.5502E+13", "is_cancelled": "t",
    "invalid": "f", "order_date": "30/06/2026", "order_time": "00:01:33", "updated": "30/06/2026 03:41",
    "activity_monitor_last_update": "38:26.6", "promise_date": "01/07/2026", "article_price": "81.900000000000006",
    layout.DAY_COUNTS[0]: "-3", "article_number": "X1", "return_quantity": "2", "region": "GB-WLS",
    "articles": r'[{"articleNo":"X1","price":10.005,"priceDetails":{"pricePaid":9.99},"articleName":"a\, b","returnImages":["i"]},'
                '{"articleNo":"X2"}]',
    "custom_fields": '{"isAdditionalLabel":false,"outboundCustomFields":{"productRecommendations":{"primary_skn0":"9"},'
                     '"InvoiceAddr":"<PII>"},"returnLabelsAdditional":["l"]}',
    "return_customer_comment": 'too "small",\nsadly',
}
ROWS = [
    GOOD,
    GOOD | {"id": "cut", "articles": '[{"articleNo":"X1","price":1'},
    GOOD | {"id": "loose", "article_number": " x1"},
    GOOD | {"id": "none", "article_number": "Z"},
    GOOD | {"id": "object", "custom_fields": "{"},
    GOOD | {"id": "days", layout.DAY_COUNTS[0]: "abc", "promise_date": "2026-07-01"},
]


@pytest.fixture
def feed(spark, folder):
    with open(f"{folder}/daily.csv", "w", newline="") as f:
        out = csv.DictWriter(f, layout.RAW_COLUMNS, restval="null")
        out.writeheader()
        out.writerows(ROWS)
    return read_text_csv(spark, f"{folder}/daily.csv")


def test_layout(spark):
    assert (len(layout.RAW_COLUMNS), len(layout.base_columns()), len(layout.published_columns())) == (86, 100, 199)


def test_transform(feed):
    df = returns.transform(feed)
    assert df.columns == layout.published_columns() and returns.output_contract().drift(df.schema) == []
    rows = {r["id"]: r for r in df.collect()}
    r = rows["6a24"]
    assert r["customer_no"] == "0000012467" and r["is_cancelled"] is True and r["invalid"] is False and r["forgotten"] is None
    assert str(r["order_ts"]) == "2026-06-30 00:01:33" and r["pickup_scheduled_ts"] is None
    assert str(r["updated_ts"]) == "2026-06-30 03:41:00" and r["activity_monitor_last_update_ts"] is None
    assert str(r["promise_dt"]) == "2026-07-01" and str(r["article_price"]) == "81.90" and r[layout.DAY_COUNTS[0]] == -3
    assert str(r["articles_json_price"]) == "10.01" and str(r["articles_json_priceDetails"]["pricePaid"]) == "9.99"
    assert r["articles_json_articleName"] == "a, b" and r["articles_json_returnImages"] == ["i"]
    assert r["custom_fields_json_outboundCustomFields"]["productRecommendations"] == {"primary_skn0": "9"}
    assert r["articles"].startswith('[{"articleNo"') and r["return_customer_comment"] == 'too "small",\nsadly'
    assert r["courier_code"] is None and r["exception_type"] is None and r["repair_attempted"] is False
    assert rows["cut"]["repaired"] and str(rows["cut"]["articles_json_price"]) == "1.00"
    assert rows["loose"]["repaired"] and rows["loose"]["articles_json_articleNo"] == "X1"
    assert rows["days"][layout.DAY_COUNTS[0]] is None and rows["days"]["promise_dt"] is None
    extras = returns.typed_extras(df).filter("id = '6a24'").first()
    assert extras["return_quantity_int"] == 2 and extras["return_quantity"] == "2"


def test_run(spark, feed, folder):
    done = returns.run(feed, f"{folder}/out", f"{folder}/exceptions", table="returns_published")
    assert done.summary == dict(zip(ex.summary_counts(), [6, 4, 4, 2, 2])) and all(done.checks.values())
    assert done.sentinels["courier_code"] == 6 and "id" not in done.sentinels
    assert done.unreadable == {layout.DAY_COUNTS[0]: 1, "activity_monitor_last_update_ts": 6, "promise_dt": 1}
    assert done.damaged_ids == {"tracking_number": 6}
    published = spark.read.parquet(done.path())
    assert published.columns == layout.published_columns() and published.count() == 4
    assert {r["id"] for r in spark.table("returns_published").collect()} == {"6a24", "cut", "loose", "days"}
    held = spark.read.parquet(f"{folder}/exceptions")
    assert held.columns == layout.DIAGNOSTIC_COLUMNS
    assert {r["id"]: r["exception_type"] for r in held.collect()} == {
        "none": "articles_no_match", "object": "custom_fields_parse_failed",
    }
    assert snapshots.current_run(spark, f"{folder}/out") == done.run


def test_run_without_exceptions_and_without_rows(spark, feed, folder):
    done = returns.run(feed.filter("id = '6a24'"), f"{folder}/out", f"{folder}/e1")
    assert done.summary["Rows still unresolved"] == 0 and spark.read.parquet(f"{folder}/e1").count() == 0
    done = returns.run(feed.filter("id = 'nobody'"), f"{folder}/out", f"{folder}/e2")
    assert set(done.summary.values()) == {0} and spark.read.parquet(f"{folder}/e2").columns == layout.DIAGNOSTIC_COLUMNS


def test_a_feed_without_a_column_is_refused(feed, folder):
    with pytest.raises(ValueError, match="articles"):
        returns.run(feed.drop("articles"), f"{folder}/out", f"{folder}/e")


def test_a_failed_check_leaves_the_old_run_current(spark, feed, folder, monkeypatch):
    first = returns.run(feed, f"{folder}/out", f"{folder}/e")
    monkeypatch.setattr(returns.ex, "reconciled", lambda figures: {"sum": False})
    with pytest.raises(RuntimeError, match="sum"):
        returns.run(feed.withColumn("id", F.lit("new")), f"{folder}/out", f"{folder}/e")
    assert snapshots.current_run(spark, f"{folder}/out") == first.run
    assert spark.read.parquet(f"{folder}/e").filter("id = 'new'").isEmpty()


def test_one_bad_file_costs_itself(spark, feed, folder):
    """Other column orders and further columns are read right; a file without a required column is set aside."""
    write = lambda df, name: df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{folder}/in/{name}")
    text = feed.select(*[c for c in feed.columns if c in layout.RAW_COLUMNS])
    write(text.filter("id = '6a24'"), "plain")
    write(text.filter("id = 'cut'").select(*text.columns[::-1], F.lit("new").alias("added")), "turned")
    write(text.filter("id = 'loose'").drop("articles"), "bad")
    batch = returns.run_files(spark, f"{folder}/in/*", f"{folder}/out", f"{folder}/e", f"{folder}/aside", table="returns_by_file")
    published = {r["id"]: r for r in spark.read.parquet(batch.done.path()).collect()}
    assert set(published) == {"6a24", "cut"} and published["cut"]["added"] == "new" and published["6a24"]["added"] is None
    assert [(r["file"].split("/")[-2], r["rule"], r["column"]) for r in batch.set_aside.collect()] == [("bad", "missing_column", "articles")]
    assert {r["id"] for r in spark.table("returns_by_file").collect()} == {"6a24", "cut"}
    none = returns.run_files(spark, f"{folder}/in/bad", f"{folder}/out", f"{folder}/e", f"{folder}/aside2")
    assert none.done is None and none.set_aside.count() == 1 and snapshots.current_run(spark, f"{folder}/out") == batch.done.run


def test_derived_tables_follow_the_pointer(spark, feed, folder, monkeypatch):
    """A crash behind the pointer's move leaves the run as the truth, and refresh brings the others to it."""
    first = returns.run(feed.filter("id <> 'object'"), f"{folder}/out", f"{folder}/e", table="returns_refreshed")
    monkeypatch.setattr(returns, "refresh", lambda *_: (_ for _ in ()).throw(KeyError("died")))
    with pytest.raises(KeyError):
        returns.run(feed, f"{folder}/out", f"{folder}/e", table="returns_refreshed")
    monkeypatch.undo()
    now = snapshots.current_run(spark, f"{folder}/out")
    assert now != first.run and spark.read.parquet(f"{folder}/e").count() == 1
    returns.refresh(spark.read.parquet(f"{folder}/out/run={now}"), f"{folder}/out", f"{folder}/e", table="returns_refreshed")
    assert spark.read.parquet(f"{folder}/e").count() == 2 and spark.table("returns_refreshed").count() == 4
    assert f"run={now}" in spark.table("returns_refreshed").inputFiles()[0]  # no second copy


def test_packed_feed_and_tables(spark, feed, folder):
    """A feed is read packed as it is plain, and takes little of the disk; the run's tables are packed too."""
    many = feed.crossJoin(spark.range(200).select())
    for packing in ("none", "gzip"):
        write_csv(many.coalesce(1), f"{folder}/{packing}", packing)
    size = {packing: sum(f.stat().st_size for f in Path(folder, packing).glob("part-*")) for packing in ("none", "gzip")}
    assert size["gzip"] < size["none"] / 5
    assert read_text_csv(spark, f"{folder}/gzip").exceptAll(many).isEmpty()
    batch = returns.run_files(spark, f"{folder}/gzip", f"{folder}/out", f"{folder}/e", f"{folder}/aside")
    assert batch.done.summary["Total input rows"] == 1200 and batch.set_aside.isEmpty()
    assert all(f.name.endswith(".zstd.parquet") for f in Path(batch.done.path()).glob("part-*"))
