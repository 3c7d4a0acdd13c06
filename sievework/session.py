"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Dates are read strictly and every timestamp is UTC.
# HotSpot does not compile methods above 8000 bytes; projections as wide as the returns feed
# are faster when Spark splits them than when it fuses them into one such method.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_job_settings(spark: SparkSession) -> SparkSession:
    """Set UTC and the strict date parser; ANSI mode is left as the cluster has it."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master gets a folder of its own when the setting is missing; on a
    cluster a driver-local folder would be invisible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievework-"))
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder.

    For a frame that is read several times: its source is read once, all readers see the
    same rows, and a lost executor costs a read of the table instead of the plan behind it.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files nothing refers to any more.

    They stay until the driver's JVM collects the plans that made them, which a large heap may not do for hours.
    """
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame | None) -> None:
    """Delete what ``stage`` has made, once nothing reads it any more, and the shuffle files behind it."""
    if df is None:
        return
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    root = path_of(shared_root(spark)).toUri().getPath()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = path_of(folder)
        if path.getParent().toUri().getPath() != root:
            raise ValueError(f"not in the shared folder: {folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def estimated_bytes(*frames) -> int:
    """Catalyst's size estimate of the files and relations the frames read; runs no job.

    Only the leaves are summed: estimates of joins multiply their sides and say little.
    """
    total = 0
    for frame in frames:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total


PARTITION_BYTES = 128 << 20


def size_shuffles(scan) -> None:
    """Raise the session's shuffle partitions, never lower them, to what a scan of this size needs.

    The default of 200 would leave hundreds of gigabytes to a task on the largest tables.
    Partitions that turn out small are merged by AQE.
    """
    conf = scan.sparkSession.conf
    needed = -(-estimated_bytes(scan) // PARTITION_BYTES)
    if needed > int(conf.get("spark.sql.shuffle.partitions")):
        conf.set("spark.sql.shuffle.partitions", str(needed))
