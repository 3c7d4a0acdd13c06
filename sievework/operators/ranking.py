"""RANK() within groups of any size, by prefix sums over range partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import stage
from .grouping import join_on


def rank_in_group(
    df: DataFrame, group: Sequence[str], measure: str, name: str = "rank", parts: int | None = None
) -> DataFrame:
    """RANK() by descending measure in each group; ties share a rank and leave a gap.

    A window over the group would send each group to one task. Here the different values of each group, ties
    collapsed to a count, are range-partitioned by group and falling measure, so a large group
    lies in several partitions, in order. A value's rank is 1 + the rows of its group in earlier partitions + those ahead of it
    in its own. The first comes from a row per partition and group, the second from a window within them.

    Both must see the same borders, which come from a sample, so the values are staged with the number of their partition
    (a row per different value; the number of partitions, ``parts`` or the session's shuffle partitions, is the table's layout).
    Leaving it to Spark to run the exchange once is not safe: over a cached input it runs twice, with other borders, and ranks are wrong.

    The input is read twice, for the values and for the rows that get a rank. Sums of floating-point numbers can come out
    differently the second time, and rows would miss their rank, so an input with such a measure is staged too.
    """
    spark = df.sparkSession
    if isinstance(df.schema[measure].dataType, (FloatType, DoubleType)):
        df = stage(df, "rank-input")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    falling = F.desc_nulls_first(measure)
    ranged = df.groupBy(*group, measure).agg(F.count("*").alias("_peers")).repartitionByRange(parts, *group, falling)
    values = stage(ranged.withColumn("_part", F.spark_partition_id()), "rank-values")
    totals = values.groupBy(*group, "_part").agg(F.sum("_peers").alias("_total"))
    # at most ``parts`` rows of a group
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*group, "_part").orderBy(falling).rowsBetween(Window.unboundedPreceding, -1)
    ahead = values.withColumn("_ahead", F.coalesce(F.sum("_peers").over(inside), F.lit(0)))
    place = (F.col("_before") + F.col("_ahead") + 1).cast("int")
    ranks = join_on(ahead, before, [*group, "_part"]).select(*group, measure, place.alias(name))
    return join_on(df, ranks, [*group, measure]).select(*df.columns, name)
