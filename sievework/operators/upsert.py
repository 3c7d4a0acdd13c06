"""Incremental loads: rows past a high-water mark, and newest-wins merging by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grouping import pick_per_key


def newer_than(df: DataFrame, column: str, mark: Any | None, inclusive: bool = False) -> DataFrame:
    """Rows past the mark; all rows on the first load. A literal comparison, so it reaches the scan.

    A row of the mark's own time that arrives later is not among them: take marks that are closed, such as
    the last full day, where that can happen, or read from the mark on (``inclusive``): an upsert tolerates
    rows that come again.
    """
    if mark is None:
        return df
    return df.filter(F.col(column) >= F.lit(mark) if inclusive else F.col(column) > F.lit(mark))


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """One row holding the mark for the next load; NULL if nothing was loaded."""
    return df.agg(F.max(column).alias("high_water_mark"))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The target after merging the changes: per key the highest version, the change on a tie.

    Target keys are unique; NULL keys meet as they do in GROUP BY, so merging twice changes nothing.
    Rows move by anti joins rather than a union and a regroup. What the changes are settled
    against is cut down first, by a semi join, to the target's rows with their keys: with few
    changes Spark makes both joins of the target broadcasts by measured size and the target is not
    shuffled.
    """
    changes = pick_per_key(changes, keys, [F.col(version)], newest=True)
    new = changes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(version).alias("_v"))
    met = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    touched = target.select(*keys, version).join(new, met, "left_semi")
    old = touched.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(version).alias("_v"))
    outdated = F.coalesce(F.col(version) <= F.col("_v"), F.col(version).isNull())
    late = F.coalesce(F.col("_v") > F.col(version), F.col("_v").isNotNull())
    return target.join(new, [*met, outdated], "left_anti").unionByName(changes.join(old, [*met, late], "left_anti"))


def merge_into(spark, table: str, changes: DataFrame, keys: Sequence[str], version: str) -> None:
    """The same merge as MERGE INTO, for table formats that support it."""
    view = f"_sievework_changes_{uuid.uuid4().hex[:12]}"
    pick_per_key(changes, keys, [F.col(version)], newest=True).createOrReplaceTempView(view)
    on = " AND ".join(f"t.`{k}` <=> c.`{k}`" for k in keys)
    spark.sql(
        f"MERGE INTO {table} t USING {view} c ON {on} "
        f"WHEN MATCHED AND (t.`{version}` IS NULL OR t.`{version}` <= c.`{version}`) THEN UPDATE SET * "
        "WHEN NOT MATCHED THEN INSERT *"
    )
