import os

import pytest
import shop
from pyspark.sql import functions as F

from sievework.contracts import Contract
from sievework.layouts import shop as layout
from sievework.plans import ingest
from sievework.session import shared_folder, shared_root, stage
from sievework.sinks import relational as out_db
from sievework.sinks import keyed, snapshots, tables
from sievework.sources import files
from sievework.sources import relational as in_db
from sievework.streaming import incremental


@pytest.fixture
def csvs(folder):
    # content and file names do not belong together, as in the sample as delivered
    swapped = {"orders.csv": "order_items", "order_items.csv": "customers", "products.csv": "orders", "setup-sql.docx": "products"}
    for name, content in swapped.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(shop.csv(content))
    return folder


def test_files_are_identified_by_their_header(spark, csvs):
    found = files.identify_files(spark, f"{csvs}/*", layout.SHOP).collect()
    assert {r["file"].rsplit("/", 1)[1]: r["content"] for r in found} == {
        "orders.csv": "order_items", "order_items.csv": "customers", "products.csv": "orders", "setup-sql.docx": "products",
    }
    assert {r["content"]: r["n_lines"] for r in found} == {"order_items": 12, "customers": 7, "orders": 10, "products": 5}


def test_typed_load(spark, csvs):
    df = files.load_typed_csv(spark, f"{csvs}/products.csv", layout.ORDERS)
    assert df.count() == 9 and df.schema == layout.ORDERS.schema
    with pytest.raises(Exception):
        files.load_typed_csv(spark, f"{csvs}/products.csv", layout.ORDER_ITEMS).collect()
    with open(f"{csvs}/bad.csv", "w") as f:
        f.write(shop.csv("orders") + "x,1,2024-01-10 09:15:00,completed,1.00\n")
    with pytest.raises(Exception):
        files.load_typed_csv(spark, f"{csvs}/bad.csv", layout.ORDERS).collect()


def test_text_csv_keeps_lines_quotes_and_zeros(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write('id,text\n007,"one\ntwo ""quoted"", end"\n008,null\n009,\n')
    got = files.read_text_csv(spark, f"{folder}/a.csv")
    assert [tuple(r) for r in got.collect()] == [("007", 'one\ntwo "quoted", end'), ("008", "null"), ("009", None)]
    assert files.read_text_csv(spark, f"{folder}/a.csv", spread=3).rdd.getNumPartitions() == 3


def test_literal_rows_and_catalog_table(spark):
    df = files.literal_rows(spark, [(1, "a")], "i int, s string")
    n = tables.write_table(df, table="kept_table")
    tables.verify_write(n, files.read_table(spark, "kept_table"))
    assert tables.write_table(df.unionAll(df), table="kept_table") == 2
    assert tables.read_back(spark, table="kept_table").count() == 2
    tables.publish_catalog_view(spark, "kept_view", "SELECT s FROM kept_table")
    assert spark.table("kept_view").count() == 2


def test_verification_fails_on_a_missing_row(spark, folder):
    n = tables.write_table(spark.range(5), f"{folder}/t")
    with pytest.raises(RuntimeError):
        tables.verify_write(n + 1, tables.read_back(spark, f"{folder}/t"))


def test_snapshots(spark, folder):
    assert snapshots.read_snapshot(spark, f"{folder}/s") is None
    snapshots.write_snapshot(spark.range(3), f"{folder}/s")
    first = snapshots.current_run(spark, f"{folder}/s")
    snapshots.write_snapshot(snapshots.read_snapshot(spark, f"{folder}/s").filter("id > 0"), f"{folder}/s")
    assert snapshots.read_snapshot(spark, f"{folder}/s").count() == 2
    snapshots.point_to(spark, f"{folder}/s", first)
    assert snapshots.read_snapshot(spark, f"{folder}/s").count() == 3


def test_pointer_is_replaced_whole(spark, folder, monkeypatch):
    base = f"{folder}/s"
    first = snapshots.write_snapshot(spark.range(3), base)
    assert [n for n in os.listdir(base) if n.startswith("_current.")] == []
    with pytest.raises(ValueError):
        snapshots.point_to(spark, base, "")
    found = iter([first, "another"])  # a second writer gets ahead while this one writes
    monkeypatch.setattr(snapshots, "current_run", lambda *_: next(found))
    with pytest.raises(RuntimeError):
        snapshots.write_snapshot(spark.range(5), base)
    monkeypatch.undo()
    assert snapshots.read_snapshot(spark, base).count() == 3
    open(f"{base}/_current", "w").close()
    for crc in [n for n in os.listdir(base) if n == "._current.crc"]:
        os.remove(f"{base}/{crc}")
    with pytest.raises(RuntimeError):
        snapshots.read_snapshot(spark, base)


def test_second_writer_between_comparison_and_rename_raises(spark, folder, monkeypatch):
    """Both writers started from the same run and both saw it current; the one that claims it first is published."""
    base = f"{folder}/s"
    snapshots.write_snapshot(spark.range(3), base)
    rename, inner = snapshots.point_to, []

    def overtaken(*args):
        if not inner:  # the first writer has claimed and not yet renamed: a whole second write happens here
            inner.append(1)
            with pytest.raises(RuntimeError, match="claimed"):
                snapshots.write_snapshot(spark.range(7), base)
        rename(*args)

    monkeypatch.setattr(snapshots, "point_to", overtaken)
    snapshots.write_snapshot(spark.range(5), base)
    assert inner and snapshots.read_snapshot(spark, base).count() == 5


def test_claim_of_a_dead_writer_is_released(spark, folder, monkeypatch):
    base = f"{folder}/s"
    snapshots.write_snapshot(spark.range(3), base)
    monkeypatch.setattr(snapshots, "point_to", lambda *_: (_ for _ in ()).throw(KeyError("died")))
    with pytest.raises(KeyError):
        snapshots.write_snapshot(spark.range(5), base)
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="claimed"):
        snapshots.write_snapshot(spark.range(6), base)
    assert snapshots.read_snapshot(spark, base).count() == 3
    assert snapshots.release_claim(spark, base) is not None and snapshots.release_claim(spark, base) is None
    snapshots.write_snapshot(spark.range(6), base)
    assert snapshots.read_snapshot(spark, base).count() == 6


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_keyed_snapshot_rewrites_what_changed(spark, folder):
    base = f"{folder}/k"
    rows = spark.range(300_000).select("id", F.lit(1).alias("v"), F.sha1(F.col("id").cast("string")).alias("x"))
    keyed.merge(rows, base, ["id"], "v", buckets=1024)
    whole = size(base)
    changes = spark.range(10).select((F.col("id") * 29_000).alias("id"), F.lit(2).alias("v"), F.lit("new").alias("x"))
    run = keyed.merge(changes.unionByName(spark.sql("SELECT 999999L AS id, 5 AS v, 'more' AS x")), base, ["id"], "v")
    assert size(f"{base}/run={run}") < 0.05 * whole and len(os.listdir(f"{base}/run={run}")) < 30
    now = keyed.read(spark, base)
    assert now.count() == 300_001 and now.filter("v = 2").count() == 10 and keyed.mark(spark, base) == "5"
    assert now.filter("v = 1").agg(F.count_distinct("id")).first()[0] == 299_990
    # a point read opens the files of one bucket
    one = keyed.read_touched(spark, base, spark.sql("SELECT 29000L AS id"))
    assert one.select(F.input_file_name()).distinct().count() == 1 and "_bucket" in one._jdf.queryExecution().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert one.filter("id = 29000").first()["x"] == "new"
    # nothing to merge changes nothing, and runs that are still read from do not expire
    assert keyed.merge(changes.filter("false"), base, ["id"], "v") is None and keyed.mark(spark, base) == "5"
    keyed.merge(changes, base, ["id"], "v")
    keyed.expire_runs(spark, base, keep=0, hours=0)
    assert keyed.read(spark, base).count() == 300_001


def test_keyed_snapshot_of_awkward_keys(spark, folder):
    base = f"{folder}/k"
    kind = "a string, b int, v int"
    keyed.merge(spark.createDataFrame([(None, 1, 1), ("x", None, 1), (None, None, 1)], kind), base, ["a", "b"], "v", buckets=4)
    keyed.merge(spark.createDataFrame([(None, 1, 2), ("x", None, 0), ("y", 1, None)], kind), base, ["a", "b"], "v")
    assert sorted(map(str, map(tuple, keyed.read(spark, base).collect()))) == sorted(map(str, [(None, 1, 2), ("x", None, 1), (None, None, 1), ("y", 1, None)]))
    with pytest.raises(ValueError):
        keyed.create(spark.createDataFrame([], kind), base, ["a"])
    empty = f"{folder}/e"
    assert keyed.read(spark, empty) is None and keyed.mark(spark, empty) is None
    keyed.merge(spark.createDataFrame([], kind), empty, ["a", "b"], "v", buckets=4)
    assert keyed.read(spark, empty).count() == 0 and keyed.read(spark, empty).schema == spark.createDataFrame([], kind).schema
    with pytest.raises(ValueError):
        keyed.rewrite(spark.createDataFrame([], kind), f"{folder}/none", lambda rows, _: rows)


def test_old_runs_expire_but_not_the_current_one(spark, folder):
    base = f"{folder}/s"
    first = snapshots.write_snapshot(spark.range(1), base)
    for n in range(2, 5):
        snapshots.write_snapshot(spark.range(n), base)
    assert len(snapshots.expire_runs(spark, base, keep=3, hours=0)) == 1
    assert snapshots.read_snapshot(spark, base).count() == 4 and f"run={first}" not in os.listdir(base)
    oldest = snapshots.write_snapshot(spark.range(9), base)
    snapshots.write_snapshot(spark.range(10), base)
    snapshots.point_to(spark, base, oldest)
    assert snapshots.expire_runs(spark, base, keep=1, hours=1) == []
    snapshots.expire_runs(spark, base, keep=1, hours=0)
    assert snapshots.read_snapshot(spark, base).count() == 9


DB = in_db.Database("jdbc:postgresql://host/db", "u", "p", "org.postgresql.Driver")


def test_relational_options():
    """Options only: no database is started for a test."""
    plain = in_db.read_options(DB, "orders")
    assert plain["dbtable"] == "orders" and plain["driver"] == DB.driver and "partitionColumn" not in plain
    split = in_db.read_options(DB, "orders", in_db.Split("order_id", "1", "1000", 8))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "order_id", "1", "1000", "8")
    reload = out_db.reload_options(DB, "dbo.orders_loaded", writers=4)
    assert reload["truncate"] == "true" and reload["numPartitions"] == "4"


def test_ingest_delivers_both_targets_with_one_load_time(spark, csvs, folder, monkeypatch):
    """Everything but the database itself, which stands in as files."""
    with open(f"{csvs}/products_ok.csv", "w") as f:
        f.write(shop.csv("products"))
    got = {}

    def deliver(df, db, table, writers):
        got[table] = df.collect()
        return len(got[table])

    monkeypatch.setattr(ingest, "read_relational", lambda spark, db, table, split: shop.frame(spark, "orders"))
    monkeypatch.setattr(ingest, "reload_table", deliver)
    done = ingest.run(spark, f"{csvs}/products_ok.csv", DB, DB, f"{folder}/rejects")
    assert {k: (v.accepted, v.rejected) for k, v in done.items()} == {"products_loaded": (4, 0), "orders_loaded": (9, 0)}
    assert list(got) == ["dbo.products_loaded", "dbo.orders_loaded"]
    assert 7006 in {r["order_id"] for r in got["dbo.orders_loaded"]}
    assert len({r["ingestion_timestamp"] for rows in got.values() for r in rows}) == 1


def test_drifted_batch_is_set_aside(spark, folder):
    contract = Contract("t", "a int", key=("a",))
    done = ingest.load(spark.sql("SELECT 1 AS a, 2 AS b"), contract, lambda df: pytest.fail("delivered"), f"{folder}/q")
    assert (done.accepted, done.rejected) == (0, 1) and done.drift[0][:2] == ("unexpected_column", "b")


def test_stream_takes_only_new_files_and_merging_twice_changes_nothing(spark, folder):
    def drop(rows, name):
        spark.createDataFrame(rows, "k int, v int").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def go():
        stream = incremental.arrivals(spark, f"{folder}/in", spark.createDataFrame([], "k int, v int").schema)
        incremental.keep_merged(stream, f"{folder}/out", f"{folder}/cp", ["k"], "v")
        return {tuple(r) for r in keyed.read(spark, f"{folder}/out").collect()}

    drop([(1, 1), (2, 5), (1, 3)], "a")
    assert go() == {(1, 3), (2, 5)}
    drop([(2, 4), (3, 1)], "b")
    assert go() == {(1, 3), (2, 5), (3, 1)}
    run = snapshots.current_run(spark, f"{folder}/out")
    assert go() == {(1, 3), (2, 5), (3, 1)} and snapshots.current_run(spark, f"{folder}/out") == run
    batch = spark.createDataFrame([(2, 4), (3, 1)], "k int, v int")
    incremental.merge_batch(batch, f"{folder}/out", ["k"], "v")
    assert {tuple(r) for r in keyed.read(spark, f"{folder}/out").collect()} == {(1, 3), (2, 5), (3, 1)}


def test_partitions_not_written_stay(spark, folder):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("d"))
    tables.write_table(df, f"{folder}/p", partition_by=["d"])
    tables.write_table(df.filter("d = 1 AND id > 5"), f"{folder}/p", partition_by=["d"])
    assert dict(tables.read_back(spark, f"{folder}/p").groupBy("d").count().collect()) == {0: 5, 1: 2}


def test_shared_folder(spark):
    assert shared_folder(spark, "x").startswith(shared_root(spark)) and shared_folder(spark, "x") != shared_folder(spark, "x")


def test_staged_frame_is_read_once(spark, folder):
    from pyspark.sql import Observation

    seen = Observation()
    staged = stage(spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")), "staged")
    assert seen.get["n"] == 10 and staged.filter("id > 4").count() == 5 and staged.count() == 10


def test_password_is_not_shown():
    assert "secret" not in repr(in_db.Database("u", "u", "secret", "d"))
