"""Which column sets identify the rows of a table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: relative standard deviation of the sketches, and how many of them an estimate may lie below the truth
ERROR, SIGMAS = 0.02, 6
#: 2**LG_K registers a sketch, within that deviation; one object in the aggregate's row, where approx_count_distinct takes
#: some hundred columns each, too many to compile
LG_K = 12
#: sketches that one pass keeps, so that a task's state stays some megabytes however many sets there are
SETS_PER_PASS = 200
#: the digests of one value all fall into the same slice
SLICES = 64


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = 2) -> list[tuple[str, ...]]:
    """All minimal keys of up to ``most`` columns: sets whose values are different in all rows, with no such subset.

    Level by level. A set that holds a key is not tried. The others are first estimated, all of a level in one
    aggregate of sketches that combine on the map side: a set whose estimate lies six standard deviations below the number of
    rows repeats. Only what is left, usually few sets, is checked exactly: each row sends a
    128-bit digest for each of them, and the digests are counted; no value is shuffled. First one digest in ``SLICES`` is
    counted: a set that repeats there is no key, so that all digests are shuffled only for sets that are keys, or nearly. NULL counts as a value. Every set of
    columns is a key of an empty table, so its keys are the single columns.
    """
    columns = list(columns or df.columns)
    n_rows, found = df.count(), []
    for size in range(1, most + 1):
        sets = [s for s in combinations(columns, size) if not any(set(k) <= set(s) for k in found)]
        likely = []
        for at in range(0, len(sets), SETS_PER_PASS):
            some = sets[at : at + SETS_PER_PASS]
            estimates = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*s, *[F.isnull(c) for c in s]), LG_K)).alias(str(i)) for i, s in enumerate(some)]).first()
            likely += [s for i, s in enumerate(some) if estimates[i] >= n_rows * (1 - SIGMAS * ERROR)]
        found += _unique(df, _unique(df, likely, F.col("a") % SLICES == 0))
    return found


def _unique(df: DataFrame, sets: Sequence[tuple[str, ...]], among: Column | None = None) -> list[tuple[str, ...]]:
    """The sets without a repeated digest, of all or ``among`` some."""
    if not sets:
        return []
    digests = [
        F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit(1), *s).alias("a"), F.xxhash64(F.lit(2), *s).alias("b"), F.array(*[F.isnull(c) for c in s]).alias("n"))
        for i, s in enumerate(sets)
    ]
    drawn = df.select(F.inline(F.array(*digests)))
    again = (drawn if among is None else drawn.filter(among)).groupBy("i", "a", "b", "n").count().filter("count > 1")
    repeated = {r["i"] for r in again.select("i").distinct().collect()}
    return [s for i, s in enumerate(sets) if i not in repeated]
