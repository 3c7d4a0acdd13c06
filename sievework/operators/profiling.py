"""Counts that describe a feed. Any number of columns costs one pass over the data; the shape audit reads it twice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .cleaning import text_columns


def tally(df: DataFrame, predicates: Mapping[str, Column], label: str = "column_name", value: str = "n") -> DataFrame:
    """(label, value): for every named predicate the number of rows where it holds."""
    counts = df.agg(*[F.count_if(p).alias(c) for c, p in predicates.items()])
    return counts.unpivot([], list(predicates), label, value)


def sentinel_profile(
    df: DataFrame, columns: Sequence[str] | None = None, sentinels: Iterable[str] = text.NULL_TEXT
) -> DataFrame:
    """How often each text column holds a sentinel; columns without one are left out."""
    sentinels = tuple(sentinels)
    found = {c: text.is_sentinel(F.col(c), sentinels) for c in columns or text_columns(df)}
    return tally(df, found, value="sentinels").filter("sentinels > 0").orderBy(F.desc("sentinels"), "column_name")


def misshapen(col: Column, pattern: str, sentinels: Iterable[str] = text.NULL_TEXT) -> Column:
    """True for a value that is there, is no sentinel, and does not have the shape."""
    return F.coalesce(~text.is_sentinel(col, sentinels) & ~col.rlike(pattern), F.lit(False))


def shape_audit(df: DataFrame, patterns: Mapping[str, str], samples: int = 5) -> DataFrame:
    """(column_name, misshapen, samples): count of bad values, and the first few of them in text order.

    One grouping by column and bad value feeds both: its counts add up to the total, and a top-k per column, of which
    each task passes on only ``samples`` values, gives the first ones. A bad value that a third of the rows have is a
    row per task there, and the input is read once, as both sides start with the same exchange.
    """
    bad = {c: misshapen(F.col(c), p) for c, p in patterns.items()}
    values = F.array(*[
        F.when(p, F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for c, p in bad.items()
    ])
    found = df.select(F.inline(F.filter(values, lambda v: v.isNotNull()))).groupBy("column_name", "value").agg(F.count("*").alias("_n"))
    counts = found.groupBy("column_name").agg(F.sum("_n").alias("misshapen"))
    first = Window.partitionBy("column_name").orderBy("value")
    shown = (
        found.filter("_n > 0")  # keeps the counts in the exchange, which so is the one that the sums read
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= samples)
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list("value")).alias("samples"))
    )
    audited = df.sparkSession.createDataFrame([(c,) for c in patterns], "column_name string")
    return audited.join(counts, "column_name", "left").join(shown, "column_name", "left").select(
        "column_name", F.coalesce("misshapen", F.lit(0)).cast("long").alias("misshapen"), "samples"
    )


def null_reconciliation(df: DataFrame, cleaned: Mapping[str, Column], expected: Mapping[str, Column]) -> DataFrame:
    """(column_name, expected, introduced, agrees): NULLs a clean-up brought in against those it should.

    ``cleaned`` maps a source column to its cleaned expression, ``expected`` to the
    predicate under which the value is meant to go; both sides count in the same pass.
    """
    sums = []
    for c, after in cleaned.items():
        sums.append(F.count_if(F.col(c).isNotNull() & after.isNull()).alias(f"introduced {c}"))
        sums.append(F.count_if(expected[c]).alias(f"expected {c}"))
    row = df.agg(*sums)
    parts = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), row[f"expected {c}"].alias("expected"), row[f"introduced {c}"].alias("introduced")
        )
        for c in cleaned
    ])
    return row.select(F.inline(parts)).withColumn("agrees", F.expr("expected = introduced"))


def key_uniqueness(df: DataFrame, candidates: Sequence[Sequence[str]], approximate: bool = False) -> DataFrame:
    """(key, n_rows, n_distinct, is_unique) for each candidate key; NULL counts as a value."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    names = [",".join(c) for c in candidates]
    row = df.agg(
        F.count("*").alias("n_rows"),
        *[count(F.struct(*keys)).alias(f"distinct {n}") for n, keys in zip(names, candidates)],
    )
    parts = F.array(*[
        F.struct(F.lit(n).alias("key"), row["n_rows"], row[f"distinct {n}"].alias("n_distinct")) for n in names
    ])
    return row.select(F.inline(parts)).withColumn("is_unique", F.expr("n_rows = n_distinct"))


def histogram(df: DataFrame, column: str, count_name: str = "n_rows") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(count_name))
