"""Keep expensive columns from being computed twice, and rows from crowding on few cores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on a computed column where it stands.

    Spark pushes a filter below the projections it depends on, with their expressions
    written out: a flag derived from parsed JSON would have the text parsed again, several
    times, in the filter. It does not push past an observation, which costs a row count.
    Filters on stored columns should stay ordinary filters, so that they do reach the scan.
    """
    return df.observe(f"computed-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows")).filter(condition)


def spread_over_cores(scan: DataFrame) -> DataFrame:
    """Redistribute a file scan that has fewer partitions than there are cores.

    For CPU-heavy work on few or unsplittable files; with enough files nothing is moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
