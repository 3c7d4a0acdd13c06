"""One row per key, repeated keys and their members, without gathering a whole group anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEMBERS_PER_ROW = 100_000


def pick_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[Column], newest: bool = False) -> DataFrame:
    """The row with the lowest (or highest) order value for each key.

    ``max_by`` combines on the map side, so a key held by a third of all rows reaches
    its reducer as one row per task; a row_number window would send them all.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)])
    choose = F.max_by if newest else F.min_by
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(choose(F.struct(*rest), rank).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first."""
    return df.dropDuplicates(list(keys))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal names, NULL keys meeting as they do in GROUP BY; the right side's keys go."""
    aliased = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    met = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(aliased, met, how).drop(*[f"_right_{k}" for k in keys])


def repeated_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).filter(F.col(count_name) > 1)


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, whole."""
    again = repeated_keys(df, keys).select(*keys)
    return join_on(df, again, keys, "left_semi")


def repeated_members(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    count_name: str = "n_rows",
    list_name: str = "members",
    members_per_row: int = MEMBERS_PER_ROW,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """(keys, count, part, sorted members) for every key that occurs more than once.

    A group of up to ``members_per_row`` gives one row, part 0. A larger one gives several,
    each with about an equal share of the members, chosen by hash: nothing is left out, and
    no row or task holds a whole large group. ``member`` should identify the row; where it repeats
    within a group, name further columns in ``spread_by`` that tell the rows apart.

    The explicit repartition matters: without it the grouping below would reuse the join's
    partitioning by key alone and pull a hot key into one task.
    """
    by = F.xxhash64(*(spread_by or [member]))
    narrow = df.select(*keys, F.col(member).alias("_member"), by.alias("_spot"))
    again = repeated_keys(narrow, keys, count_name)
    shares = F.ceil(F.col(count_name) / F.lit(members_per_row))
    spread = (
        join_on(narrow, again, keys)
        .withColumn("part", F.pmod("_spot", shares).cast("int"))
        .repartition(*keys, "part")
    )
    tagged = F.struct(F.isnull("_member").alias("missing"), F.col("_member").alias("value"))
    return (
        spread.groupBy(*keys, count_name, "part")
        .agg(F.array_sort(F.collect_list(tagged)).alias("_tagged"))
        .select(*keys, count_name, "part", F.transform("_tagged", lambda m: m["value"]).alias(list_name))
    )
