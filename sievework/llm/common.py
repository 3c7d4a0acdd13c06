"""Small helpers the operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 256


def row_slices(batches, size: int = ROWS_AT_ONCE) -> Iterator:
    """Arrow batches in slices of few rows, so that long texts are not all Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def rows_of(batches, width: int) -> Iterator[tuple]:
    """The first columns of Arrow batches as tuples, few at a time."""
    for part in row_slices(batches):
        yield from zip(*(part.column(k).to_pylist() for k in range(width)), strict=True)


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of few rows."""
    rows = iter(rows)
    while some := list(islice(rows, size)):
        columns = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % F.lit(by)


def held(doc_id: Column, by: int, is_: int) -> Column:
    """Whether a row is held out. A row without an id is: nothing is learned from it."""
    return F.coalesce(remainder(doc_id, by) == F.lit(is_), F.lit(True))


def sampled(key: Column, share: Column, seed: int) -> Column:
    """A repeatable draw by hash of the key: true for about this share of the keys."""
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    return draw < share


SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for an application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        # the driver's own folder: Spark serves the file to the executors from there
        folder = tempfile.mkdtemp(prefix="sievework-")
        inside = shutil.copytree(top, f"{folder}/in/{os.path.basename(top)}", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{os.path.basename(inside)}", "zip", f"{folder}/in"))
        SHIPPED.add(app)
    return spark
