"""New rows into a keyed snapshot: as a stream of files that stops when it has caught up, or by a high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import newer_than
from ..sinks import keyed


def arrivals(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The files in a folder as a stream; each is read once per checkpoint."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def merge_batch(batch: DataFrame, base: str, keys: Sequence[str], version: str, buckets: int = keyed.BUCKETS) -> None:
    """Merge one batch into the keyed snapshot. Doing it twice changes nothing.

    Only the buckets that the batch touches are read and written. Earlier runs stay in place for readers;
    ``keyed.expire_runs`` removes old ones, by its own schedule.
    """
    keyed.merge(batch, base, keys, version, buckets)


def keep_merged(
    stream: DataFrame, base: str, checkpoint: str, keys: Sequence[str], version: str, buckets: int = keyed.BUCKETS
) -> None:
    """Run until every file that has arrived is merged; call again for the next ones."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: merge_batch(batch, base, keys, version, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_new(
    source: DataFrame, base: str, keys: Sequence[str], version: str, buckets: int = keyed.BUCKETS
) -> Any | None:
    """Merge what the source has from the stored mark on, and return that mark (None on the first load).

    The mark is kept in the snapshot's manifest and published with it in one step, so the two cannot disagree and no
    scan is needed to know it.
    """
    spark, kind = source.sparkSession, source.schema[version].dataType.simpleString()
    stored = keyed.mark(spark, base)
    mark = None if stored is None else spark.range(1).select(F.lit(stored).cast(kind)).first()[0]
    merge_batch(newer_than(source, version, mark, inclusive=True), base, keys, version, buckets)
    return mark
