"""Row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number_rows(df: DataFrame, name: str = "_row_uid") -> DataFrame:
    """A bigint per row, unique within one evaluation; it depends on the partitioning.

    Good for telling rows apart in one output. Do not join two evaluations on it.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, name: str = "_row_key") -> DataFrame:
    """A 256-bit key of the row's content: the same in every run, on any partitioning.

    NULL and empty text differ, and the lengths of the parts are part of the key.
    Exact copies share it; name a further column, such as the source file, to part them.
    """
    parts = [F.coalesce(F.concat_ws(":", F.char_length(t), t), F.lit("-")) for t in (
        F.col(c).cast("string") for c in (columns or df.columns)
    )]
    return df.withColumn(name, F.sha2(F.concat_ws("|", *parts), 256))
