"""Personal members are gone from texts and objects, and nothing else is."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sievework.operators.cleaning import redact_text
from sievework.plans import order_quality
from sievework.sinks import keyed
from sievework.streaming.incremental import load_new
from workload import catalog

CASES = [
    ('{"Addr":"Elm 1","b":2}', '{"Addr":null,"b":2}'),
    ('{"a":{"Addr" : "say \\"hi\\", Elm"},"b":"Addr"}', '{"a":{"Addr" : null},"b":"Addr"}'),
    ('{"Addr":-1.5e3,"c":1}', '{"Addr":null,"c":1}'),
    ('{"Addr":null}', '{"Addr":null}'),
    ('{"other":"Elm 1"}', '{"other":"Elm 1"}'),
    ('{"Addr":{"street":"Elm"}}', None),  # a value of another kind
    ('{"Addr":["Elm"]}', None),
    ('{"\\u0041ddr":"Elm"}', None),  # a name spelled with escapes
    ('{"Addr":"' + "x" * 200_000 + '"}', '{"Addr":null}'),
    (None, None),
    ("", ""),
]


def test_redacted_text(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = df.select("i", redact_text(F.col("raw"), ["Addr"], F.lit(True)).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [want for _, want in CASES]


def test_unreadable_text_goes_whole(spark):
    df = spark.createDataFrame([('{"Addr":"Elm',)], "raw string")
    assert df.select(redact_text(F.col("raw"), ["Addr"], F.lit(False))).first()[0] is None


def test_customers_without_email_all_survive(spark):
    day = dt.date(2026, 1, 2)
    rows = [(1, None, day), (2, None, day), (3, "x@y", day), (4, "x@y", dt.date(2026, 1, 1))]
    df = spark.createDataFrame(rows, "customer_id int, email string, signup_date date")
    got = order_quality.surviving_customers(df)
    assert got.columns == df.columns
    assert sorted(r["customer_id"] for r in got.collect()) == [1, 2, 4]


@pytest.mark.parametrize("late", [5, 9])
def test_rows_of_the_marks_own_time_are_not_missed(spark, tmp_path, late):
    base = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 5, "a"), (2, 3, "b")], "k int, v int, x string")
    assert load_new(first, base, ["k"], "v") is None
    more = first.union(spark.createDataFrame([(3, late, "c")], first.schema))
    assert load_new(more, base, ["k"], "v") == 5
    assert load_new(more, base, ["k"], "v") == max(5, late)
    assert sorted(map(tuple, keyed.read(spark, base).collect())) == [(1, 5, "a"), (2, 3, "b"), (3, late, "c")]


def test_texts_are_cleared_once(spark):
    """Each name's pattern is in the plan once, and a deep or hidden member is treated as ever."""
    texts = ['{"a":{"N":"x"},"M":[1]}', '{"N":"x"}', '{"b":"N"}', r'{"\u004e":"x"}', "{", None]
    df = spark.createDataFrame([(t, t != "{") for t in texts], "t string, ok boolean")
    cleared = df.select(redact_text(F.col("t"), ["N", "M"], F.col("ok")).alias("t"))
    assert [r["t"] for r in cleared.collect()] == [None, '{"N":null}', '{"b":"N"}', None, None, None]
    plan = cleared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2


def test_redacted_run_joins_short_rows(spark, tmp_path):
    """What is written is looked through before the join, so the join moves no written text."""
    line = (7, 5, 3, 2, 4.0, 10.5, 0.0, 0.0, "R", "O", dt.datetime(2024, 3, 1))
    lines = [line, (6, 9, 3, 1, *line[4:]), (8, 5, 4, 3, *line[4:])]
    spark.createDataFrame(lines, (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = catalog.QUERIES["q11_redacted_run"](spark, str(tmp_path))
    node = found._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    assert node.left().output().size() <= 6
    rows = found.collect()
    assert sorted(r["id"] for r in rows) == ["rt6", "rt7", "rt8"] and not any(r["leaks"] or r["listed"] for r in rows)
