"""Versioned snapshots on plain files: write a new run, then point to it.

Without a table format an overwrite is not atomic. A run is written beside the others,
and readers follow a small pointer file. A new pointer is written beside the old one and renamed
over it, which file systems do in one step; on an object store without such a rename use a table
format. The pointer is handled through the JVM's file systems, so this module, like
``session.estimated_bytes``, needs a classic session, not Spark Connect.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

ROUTE = "route"
POINTER = "_current"
CLAIM = "_next"


def write_routed(df: DataFrame, base: str, run: str, fmt: str = "parquet", distinct: Collection[str] = ()) -> DataFrame:
    """Write all routes in one pass to ``base/run=<run>/route=<name>`` and read the run back.

    Nothing is shuffled or sorted: each task writes a file for each route it meets. Parquet is packed with zstd, which
    takes two thirds of the default's disk where rows hold texts beside what was parsed from them. Of ``distinct`` columns
    no dictionary is tried.
    """
    path = f"{base}/run={run}"
    conf, setting = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting, None)
    conf.set(setting, "16")  # few routes: their files are open at once, and no task sorts its rows by route
    try:
        packed = {"compression": "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in distinct} if fmt == "parquet" else {}
        df.write.format(fmt).options(**packed).partitionBy(ROUTE).mode("errorifexists").save(path)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


def write_snapshot(df: DataFrame, base: str, fmt: str = "parquet") -> str:
    """Write a new run of a whole table and make it current. The frame may read the previous run.

    If another writer made a run current meanwhile, this one raises rather than undo the other's.
    """
    run, previous = uuid.uuid4().hex[:12], current_run(df.sparkSession, base)
    df.write.format(fmt).mode("errorifexists").save(f"{base}/run={run}")
    succeed(df.sparkSession, base, run, previous)
    return run


def succeed(spark: SparkSession, base: str, run: str, previous: str | None) -> None:
    """Make a run current that was made from ``previous``, or raise.

    A run has one successor: whoever creates the claim file named after it. The file system lets one writer
    create it, so of two writers that both started from ``previous`` and both still see it current, one raises. The claim
    stays, as a run never becomes current twice this way. A writer that dies between claim and rename leaves
    a claim on the current run; ``release_claim`` takes it away, once that writer is known to be gone.
    """
    found = current_run(spark, base)
    if found != previous:
        raise RuntimeError(f"run {found} became current while {run} was written on top of {previous}")
    path, fs = _file(spark, _claim(base, previous))
    try:
        out = fs.create(path, False)
    except Exception as taken:
        raise RuntimeError(f"another writer has claimed the run after {previous}; {run} was not published") from taken
    out.write(bytearray(run.encode()))
    out.close()
    # the claim may be of a run that was released and succeeded meanwhile
    if (found := current_run(spark, base)) != previous:
        raise RuntimeError(f"run {found} became current while {run} was written on top of {previous}")
    point_to(spark, base, run)


def _claim(base: str, previous: str | None) -> str:
    return f"{base}/{CLAIM}.{previous or 'first'}"


def release_claim(spark: SparkSession, base: str) -> str | None:
    """Take away the claim on the current run, left by a writer that died before it published; returns the run it wanted."""
    name = _claim(base, current_run(spark, base))
    path, fs = _file(spark, name)
    if not fs.exists(path):
        return None
    run = read_text(spark, name)
    fs.delete(path, False)
    return run


def _file(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointer(spark: SparkSession, base: str):
    return _file(spark, f"{base}/{POINTER}")


def write_text(spark: SparkSession, name: str, text: str) -> None:
    path, fs = _file(spark, name)
    out = fs.create(path, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, name: str) -> str:
    path, fs = _file(spark, name)
    stream = fs.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def point_to(spark: SparkSession, base: str, run: str) -> None:
    if not run:
        raise ValueError("a pointer needs a run")
    path, fs = _pointer(spark, base)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}.{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, True)
    out.write(bytearray(run.encode()))
    out.close()
    option = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(path), options)


def current_run(spark: SparkSession, base: str) -> str | None:
    path, fs = _pointer(spark, base)
    if not fs.exists(path):
        return None
    run = read_text(spark, f"{base}/{POINTER}")
    if not run:
        raise RuntimeError(f"the pointer of {base} is empty")
    return run


def read_snapshot(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """The current run, or None before the first."""
    run = current_run(spark, base)
    return None if run is None else spark.read.format(fmt).load(f"{base}/run={run}")


def expire_runs(spark: SparkSession, base: str, keep: int, hours: float, used: Collection[str] = ()) -> list[str]:
    """Remove runs that are older than ``hours`` and not among the newest ``keep``, and never the current one.

    Never part of a merge: a reader may still hold an older run, for as long as its job takes. ``used`` names further
    runs that stay, such as those a keyed snapshot still reads buckets of. Returns what was removed.
    """
    path, fs = _pointer(spark, base)
    now = current_run(spark, base)
    found = [f for f in fs.listStatus(path.getParent()) if f.isDirectory() and f.getPath().getName().startswith("run=")]
    found.sort(key=lambda f: f.getModificationTime(), reverse=True)
    aged = [f for f in found[keep:] if f.getModificationTime() <= (time.time() - hours * 3600) * 1000]
    old = [f.getPath() for f in aged if f.getPath().getName() not in {f"run={r}" for r in (now, *used)}]
    for p in old:
        fs.delete(p, True)
    return [p.getName() for p in old]
