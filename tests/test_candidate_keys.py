"""Minimal keys against brute force."""

import random
from itertools import combinations

import pytest

from pyspark.sql import functions as F

from sievework.plans import candidate_keys
from sievework.plans.candidate_keys import minimal_keys


def brute(rows, columns, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(range(len(columns)), size):
            if not any(set(k) <= set(s) for k in found) and len({tuple(r[i] for i in s) for r in rows}) == len(rows):
                found.append(s)
    return [tuple(columns[i] for i in k) for k in found]


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys(spark, seed):
    draw = random.Random(seed)
    n, columns = 400, list("abcde")
    rows = [(draw.randint(0, 20), i // 20, draw.choice([None, *range(30)]), i % 20 if seed % 2 else draw.randint(0, 400), str(draw.randint(0, 9) or "") or None) for i in range(n)]
    rows += rows[:1] if seed == 3 else []
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e string")
    assert minimal_keys(df, columns, 3) == brute(rows, columns, 3)


def test_missing_values_count_and_an_empty_table_has_every_key(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    assert minimal_keys(df) == [("a", "b")]
    assert minimal_keys(df.filter("false")) == [("a",), ("b",)]


def test_sets_that_repeat_often_are_ruled_out_by_a_slice(spark, monkeypatch):
    """All digests are counted of the real key only; near keys, which the sketches pass, already repeat within a slice."""
    seen, unique = [], candidate_keys._unique
    monkeypatch.setattr(candidate_keys, "_unique", lambda df, sets, *among: seen.append((len(among), list(sets))) or unique(df, sets, *among))
    df = spark.range(20000).select("id", (F.col("id") % 19000).alias("near"), F.lit(1).alias("one"))
    assert minimal_keys(df) == [("id",)]
    assert seen[:2] == [(1, [("id",), ("near",)]), (0, [("id",)])]
