"""Groups of any size: ranks, members, survivors and merges against brute force, with hot keys."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sievework.operators import grouping, ranking, upsert


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group, one value heavily tied, and missing groups and measures."""
    pick = random.Random(7)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 == 0 else pick.choice(["a", "b", None, "only"] if i % 500 else ["single%d" % i])
        value = 5 if pick.random() < 0.3 else None if pick.random() < 0.02 else pick.randrange(-2000, 2000)
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id int, g string, v int").repartition(5).cache()


@pytest.mark.parametrize("parts", [1, 2, 16, 50, None])
def test_rank_by_prefix_sums_is_rank(hot, parts):
    window = Window.partitionBy("g").orderBy(F.desc_nulls_first("v"))
    want = {r["id"]: r["k"] for r in hot.withColumn("k", F.rank().over(window)).collect()}
    got = {r["id"]: r["k"] for r in ranking.rank_in_group(hot, ["g"], "v", "k", parts=parts).collect()}
    assert got == want


def test_rank_has_no_window_over_a_whole_group(hot):
    plan = ranking.rank_in_group(hot, ["g"], "v", "k", parts=7)._jdf.queryExecution().optimizedPlan().toString()
    assert "_peers" in plan and "_part" in plan.split("Window [sum(_peers")[1].split("]")[1]


def test_rank_of_a_hot_group_is_spread(spark):
    """No task meets the whole group: its values lie in several range partitions, each with a share."""
    df = spark.range(20_000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.xxhash64("id").alias("v"))
    seen = ranking.rank_in_group(df, ["g"], "v", "k", parts=8)
    assert seen.agg(F.max("k"), F.count_distinct("g", "k")).first()[:] == (18_000, 20_000)
    spread = df.groupBy("g", "v").count().repartitionByRange(8, "g", F.desc("v")).groupBy(F.spark_partition_id().alias("p"), "g").count()
    assert spread.filter("g = 0").agg(F.max("count")).first()[0] < 6_000


def test_rank_of_doubles(hot):
    """Sums of doubles depend on the order of addition, so they must be computed once."""
    sums = hot.groupBy("g", (F.col("id") % 50).alias("c")).agg(F.sum(F.col("v") / 7.0).alias("s"))
    ranked = ranking.rank_in_group(sums, ["g"], "s", "k", parts=8).collect()
    assert len(ranked) == sums.count()
    by_group = defaultdict(list)
    for r in ranked:
        by_group[r["g"]].append((r["s"], r["k"]))
    for rows in by_group.values():
        known = [s for s, _ in rows if s is not None]
        for s, k in rows:
            assert k == 1 + (0 if s is None else sum(o > s for o in known) + len(rows) - len(known))


@pytest.mark.parametrize("share", [1, 100, 100_000])
def test_members_in_parts_are_complete(hot, share):
    got = grouping.repeated_members(hot, ["g"], "id", members_per_row=share)
    rows = got.collect()
    want = defaultdict(list)
    for r in hot.collect():
        want[r["g"]].append(r["id"])
    want = {g: sorted(ids) for g, ids in want.items() if len(ids) > 1}
    found = defaultdict(list)
    for r in rows:
        assert r["n_rows"] == len(want[r["g"]]) and r["members"] == sorted(r["members"])
        found[r["g"]] += r["members"]
    assert {g: sorted(ids) for g, ids in found.items()} == want
    if share == 100_000:
        assert {r["part"] for r in rows} == {0}
    if share == 100:
        assert max(len(r["members"]) for r in rows) < 300


def test_missing_members_stay_listed(spark):
    df = spark.createDataFrame([("x", 2), ("x", None), ("x", 1), ("y", 1)], "k string, m int")
    assert [tuple(r) for r in grouping.repeated_members(df, ["k"], "m").collect()] == [("x", 3, 0, [1, 2, None])]


def test_a_member_that_repeats_is_spread_by_other_columns(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1).alias("m"), "id")
    parts = grouping.repeated_members(df, ["k"], "m", members_per_row=100, spread_by=["m", "id"]).collect()
    assert sum(len(r["members"]) for r in parts) == 1000 and max(len(r["members"]) for r in parts) < 200


def test_repeated_rows_and_survivors(hot):
    rows = hot.collect()
    counts = Counter(r["g"] for r in rows)
    again = {r["id"] for r in grouping.repeated_rows(hot, ["g"]).collect()}
    assert again == {r["id"] for r in rows if counts[r["g"]] > 1}
    kept = grouping.pick_per_key(hot, ["g"], [F.col("v"), F.col("id")])
    assert kept.columns == hot.columns
    best = {}
    for r in rows:
        rank = (r["v"] is not None, r["v"] or 0, r["id"])
        best[r["g"]] = min(best.get(r["g"], (rank, r)), (rank, r), key=lambda x: x[0])
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for _, r in best.values()}


version = st.one_of(st.none(), st.integers(1, 4))
tables = st.dictionaries(st.none() | st.integers(1, 5), version, max_size=5)
batches = st.lists(st.tuples(st.none() | st.integers(1, 6), version), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=tables, batch=batches)
def test_upsert_keeps_the_newest(spark, target, batch):
    ddl = "k int, v int, src string"
    t = spark.createDataFrame([(k, v, "old") for k, v in target.items()], ddl)
    c = spark.createDataFrame([(k, v, "new") for k, v in batch], ddl)
    want = {k: (v or 0, "old") for k, v in target.items()}
    for k, v in batch:
        if k not in want or (v or 0) >= want[k][0]:
            want[k] = (v or 0, "new")
    merged = upsert.upsert(t, c, ["k"], "v")
    got = {r["k"]: (r["v"] or 0, r["src"]) for r in merged.collect()}
    assert got == want and merged.count() == len(want)


def test_incremental(spark):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, i)) for i in range(1, 6)], "i int, at timestamp")
    assert upsert.newer_than(df, "at", None).count() == 5
    mark = upsert.high_water_mark(df.filter("i <= 3"), "at").first()[0]
    assert [r["i"] for r in upsert.newer_than(df, "at", mark).orderBy("i").collect()] == [4, 5]
    assert upsert.high_water_mark(df.filter("i > 9"), "at").first()[0] is None
