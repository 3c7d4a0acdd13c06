"""Snapshots by key that rewrite only what a change touches.

The rows lie in hash buckets of their key. A run holds the buckets that one change rewrote; a manifest
beside the pointer says which run has the current rows of each bucket, and the pointer names the manifest. So a
change reads and writes the buckets that its keys fall in, and readers see it whole or not at all. The number of buckets
is fixed when the snapshot is made: take it so that a bucket is about a file's worth of rows. The manifest has a number per
bucket and is read by the driver.

The manifest also keeps values that belong to the snapshot, such as the high-water mark of what was merged.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.grouping import pick_per_key
from ..operators.upsert import upsert
from ..session import stage
from .snapshots import current_run, read_text, succeed, write_text
from .snapshots import expire_runs as expire

BUCKETS = 256
BUCKET, RUN = "_bucket", "run"


def _manifest(base: str, run: str) -> str:
    return f"{base}/_manifest.{run}"


def manifest(spark: SparkSession, base: str) -> dict[str, Any] | None:
    """keys, schema, buckets (their runs, by number) and info of the current snapshot; None before the first."""
    run = current_run(spark, base)
    return None if run is None else json.loads(read_text(spark, _manifest(base, run))) | {"run": run}


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, base: str, found: dict[str, Any], only: set[int] | None = None) -> DataFrame:
    """The current rows; those of some buckets if ``only`` is given. Other buckets' files are not opened."""
    schema = StructType.fromJson(found["schema"])
    by_run: dict[str, list[int]] = defaultdict(list)
    for bucket, run in enumerate(found["buckets"]):
        if run and (only is None or bucket in only):
            by_run[run].append(bucket)
    if not by_run:
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField(RUN, StringType()), StructField(BUCKET, IntegerType())])
    stored = spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{RUN}={run}" for run in by_run])
    current = F.lit(False)
    for run, buckets in by_run.items():
        current = current | ((F.col(RUN) == run) & F.col(BUCKET).isin(buckets))
    return stored.filter(current).select(*schema.names)


def read(spark: SparkSession, base: str) -> DataFrame | None:
    """The snapshot as it is now, or None before the first."""
    found = manifest(spark, base)
    return None if found is None else _rows(spark, base, found)


def _touched(found: dict[str, Any], changes: DataFrame) -> list[int]:
    """The numbers of the buckets that the keys fall in: one row per bucket at most reaches the driver."""
    numbers = changes.select(_bucket(found["keys"], len(found["buckets"])).alias("b")).distinct().collect()
    return sorted(r["b"] for r in numbers)


def read_touched(spark: SparkSession, base: str, keys: DataFrame) -> DataFrame:
    """The current rows of the buckets that these keys fall in."""
    found = manifest(spark, base)
    return _rows(spark, base, found, set(_touched(found, keys)))


def _write(rows: DataFrame, base: str, found: dict[str, Any], touched: Sequence[int], notes: dict[str, Any]) -> str:
    spark, run, previous = rows.sparkSession, uuid.uuid4().hex[:12], found.get("run")
    placed = rows.withColumn(BUCKET, _bucket(found["keys"], len(found["buckets"]))).repartition(BUCKET)
    placed.write.partitionBy(BUCKET).mode("errorifexists").parquet(f"{base}/{RUN}={run}")
    buckets = list(found["buckets"])
    for bucket in touched:
        buckets[bucket] = run
    new = {"keys": found["keys"], "schema": found["schema"], "buckets": buckets, "info": found.get("info", {}) | notes}
    write_text(spark, _manifest(base, run), json.dumps(new))
    succeed(spark, base, run, previous)
    return run


def create(rows: DataFrame, base: str, keys: Sequence[str], buckets: int = BUCKETS, notes: dict[str, Any] | None = None) -> str:
    """The first snapshot; raises if there is one. Keys may repeat, all rows of a key lie in one bucket."""
    if current_run(rows.sparkSession, base) is not None:
        raise ValueError(f"{base} has a snapshot")
    found = {"keys": list(keys), "schema": rows.schema.jsonValue(), "buckets": [None] * buckets}
    return _write(rows, base, found, range(buckets), notes or {})


def rewrite(
    changes: DataFrame, base: str, settle: Callable[[DataFrame, DataFrame], DataFrame], notes: dict[str, Any] | None = None
) -> str | None:
    """Replace the buckets that the keys of ``changes`` fall in by ``settle(their rows, changes)``.

    What ``settle`` returns must have the snapshot's columns and keys of these buckets only. Returns the new
    run, or None if there was no change. Of two writers at once one raises (``snapshots.succeed``).
    """
    spark = changes.sparkSession
    found = manifest(spark, base)
    if found is None:
        raise ValueError(f"{base} has no snapshot")
    changes = stage(changes, "changes")
    touched = _touched(found, changes)
    if not touched:
        return None
    new = settle(_rows(spark, base, found, set(touched)), changes)
    return _write(new.select(*StructType.fromJson(found["schema"]).names), base, found, touched, notes or {})


def info(spark: SparkSession, base: str, name: str) -> Any | None:
    found = manifest(spark, base)
    return None if found is None else found["info"].get(name)


def mark(spark: SparkSession, base: str) -> str | None:
    """The highest version that was merged, as text; kept with the snapshot, so that it needs no scan."""
    return info(spark, base, "mark")


def merge(changes: DataFrame, base: str, keys: Sequence[str], version: str, buckets: int = BUCKETS) -> str | None:
    """Merge by key, the newest version wins (as ``operators.upsert``); makes the snapshot if there is none.

    Merging the same changes again writes the touched buckets again, with the same rows.
    """
    spark, kind = changes.sparkSession, changes.schema[version].dataType.simpleString()
    changes = stage(changes, "changes")
    high, old = changes.agg(F.max(version)), mark(spark, base)
    high = high.select(F.greatest(F.col(f"max({version})"), F.lit(old).cast(kind)).cast("string")).first()[0]
    if current_run(spark, base) is None:
        return create(pick_per_key(changes, keys, [F.col(version)], newest=True), base, keys, buckets, {"mark": high})
    return rewrite(changes, base, lambda rows, new: upsert(rows, new, keys, version), {"mark": high})


def expire_runs(spark: SparkSession, base: str, keep: int, hours: float) -> list[str]:
    """Remove old runs (as ``snapshots.expire_runs``) that no bucket is read from."""
    found = manifest(spark, base)
    return expire(spark, base, keep, hours, {r for r in found["buckets"] if r} if found else ())
