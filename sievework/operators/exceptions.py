"""Match a list element per row, classify faults, repair what is unambiguous, route the rest.

All steps are projections on the row itself. ``ListSpec`` and ``ObjectSpec`` name the
columns, so the same steps serve any feed with an embedded list and object.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from .barriers import where_computed

ITEMS, EXACT, ELEMENT, OBJECT = "_items", "_exact", "_element", "_object"
CLOSED, LOOSE = "_closed", "_loose"


@dataclass(frozen=True)
class ListSpec:
    """An embedded JSON list and how a row finds its element in it."""

    ddl: str
    source: str = "articles"
    key: str = "article_number"
    item_key: str = "articleNo"
    failed: str = "articles_parse_failed"
    count: str = "articles_match_count"
    no_match: str = "articles_no_match"
    duplicate: str = "articles_duplicate_match"


@dataclass(frozen=True)
class ObjectSpec:
    ddl: str
    source: str = "custom_fields"
    failed: str = "custom_fields_parse_failed"


def match_list(df: DataFrame, spec: ListSpec) -> DataFrame:
    """Add the parsed list, the matched element, the match count and the failure flag.

    The row count cannot change. Of several matches the first is shown, and the count
    tells that there were more.
    """
    df = df.withColumn(ITEMS, nested.parse_list(F.col(spec.source), spec.ddl))
    df = df.withColumn(EXACT, _exact(spec))
    return df.withColumns({
        spec.failed: _list_failed(spec),
        spec.count: nested.hits(F.col(EXACT)),
        ELEMENT: nested.first(F.col(EXACT)),
    })


def parse_object_column(df: DataFrame, spec: ObjectSpec) -> DataFrame:
    """Add the parsed object and its failure flag."""
    df = df.withColumn(OBJECT, nested.parse_object(F.col(spec.source), spec.ddl))
    return df.withColumn(spec.failed, nested.object_unreadable(F.col(OBJECT)))


def first_rule(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, NULL if none does."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def found_exception(items: ListSpec, obj: ObjectSpec, failed: Column, count: Column, object_failed: Column) -> Column:
    """The exception as found, before any repair."""
    return first_rule([
        (items.failed, failed), (items.no_match, count == 0), (items.duplicate, count > 1), (obj.failed, object_failed)
    ])


def mark_exceptions(df: DataFrame, items: ListSpec, obj: ObjectSpec) -> DataFrame:
    """Add ``exception_type`` and ``has_exception`` to a matched and parsed frame."""
    found = found_exception(items, obj, F.col(items.failed), F.col(items.count), F.col(obj.failed))
    df = df.withColumn("exception_type", found)
    return df.withColumn("has_exception", F.col("exception_type").isNotNull())


def _exact(spec: ListSpec) -> Column:
    return nested.matching(F.col(ITEMS), spec.item_key, F.col(spec.key))


def _list_failed(spec: ListSpec) -> Column:
    return nested.list_unreadable(F.col(spec.source), F.col(ITEMS))


def closed_list_hits(spec: ListSpec, failed: Column) -> Column:
    """Matches in a truncated list after closing it; only unreadable lists are parsed again."""
    again = nested.parse_closed_list(F.col(spec.source), spec.ddl)
    return F.when(failed, nested.matching(again, spec.item_key, F.col(spec.key)))


def loose_hits(spec: ListSpec, failed: Column, count: Column) -> Column:
    """Matches but for case and blanks, for readable lists without an exact match."""
    loose = nested.matching(F.col(ITEMS), spec.item_key, F.col(spec.key), nested.alike)
    return F.when(~failed & (count == 0), loose)


def _retries(spec: ListSpec, failed: Column, count: Column) -> dict[str, Column]:
    return {CLOSED: closed_list_hits(spec, failed), LOOSE: loose_hits(spec, failed, count)}


def _settled(obj: ObjectSpec, found: Column, object_failed: Column, element: Column, reclassify: bool) -> dict[str, Column]:
    """The final columns, from the exception as found and the two retries."""
    one = [F.coalesce(F.array_size(c) == 1, F.lit(False)) for c in (CLOSED, LOOSE)]
    left = first_rule([(obj.failed, object_failed)] if reclassify else [])
    final = F.when(one[0] | one[1], left).otherwise(found)
    return {
        "exception_type": final,
        "has_exception": final.isNotNull(),
        "repair_attempted": found.isNotNull(),
        "repaired": found.isNotNull() & final.isNull(),
        ELEMENT: F.coalesce(nested.only(F.col(CLOSED)), nested.only(F.col(LOOSE)), element),
    }


def repair(df: DataFrame, items: ListSpec, obj: ObjectSpec, reclassify: bool = True) -> DataFrame:
    """Put a found element in place where exactly one was found, and settle the final state.

    Match count and parse flags keep their values from before. ``repair_attempted`` is set
    on every exception, ``repaired`` where the row ends up clean. With ``reclassify`` a row
    whose list was repaired but whose object is unreadable stays an exception; without it,
    the first fault alone decides.
    """
    df = df.withColumns(_retries(items, F.col(items.failed), F.col(items.count)))
    df = df.withColumns(_settled(obj, F.col("exception_type"), F.col(obj.failed), F.col(ELEMENT), reclassify))
    return df.drop(CLOSED, LOOSE, EXACT)


def resolve(df: DataFrame, items: ListSpec, obj: ObjectSpec, reclassify: bool = True) -> DataFrame:
    """``match_list`` to ``repair`` in one go, with the same result.

    Spark keeps a projection per step whose result is used more than once, and each copies
    the wide row. Here the flags are written out from the parsed values, which leaves four.
    """
    failed, count = _list_failed(items), nested.hits(F.col(EXACT))
    object_failed = nested.object_unreadable(F.col(OBJECT))
    df = df.withColumns({
        ITEMS: nested.parse_list(F.col(items.source), items.ddl),
        OBJECT: nested.parse_object(F.col(obj.source), obj.ddl),
    })
    df = df.withColumn(EXACT, _exact(items))
    df = df.withColumns(_retries(items, failed, count))
    found = found_exception(items, obj, failed, count, object_failed)
    df = df.withColumns({
        items.failed: failed,
        items.count: count,
        obj.failed: object_failed,
        **_settled(obj, found, object_failed, nested.first(F.col(EXACT)), reclassify),
    })
    return df.drop(CLOSED, LOOSE, EXACT, ITEMS)


def unresolved() -> Column:
    return F.col("has_exception") & ~F.col("repaired")


def route(df: DataFrame, diagnostics: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to publish, unresolved rows); every row is in exactly one.

    Each of the two evaluates the frame for itself. To store both, use ``write_routed``,
    which does so once.
    """
    bad = where_computed(df, unresolved())
    return where_computed(df, ~unresolved()), bad.select(*diagnostics) if diagnostics else bad


def route_name(published: str, rest: str) -> Column:
    """Which way a row goes; every row has one."""
    return F.when(unresolved(), rest).otherwise(published)


def summary_counts() -> dict[str, Column]:
    """The run's five figures as aggregates over the repaired frame."""
    # The metric names of the published summary.
    return {
        "Total input rows": F.count(F.lit(1)),
        "Successfully processed rows": F.count_if(~unresolved()),
        "Rows requiring exception handling": F.count_if("repair_attempted"),
        "Rows successfully repaired": F.count_if("repaired"),
        "Rows still unresolved": F.count_if(unresolved()),
    }


def run_summary(df: DataFrame) -> DataFrame:
    """(metric, value) in one pass."""
    counts = summary_counts()
    row = df.agg(*[c.alias(name) for name, c in counts.items()])
    return row.unpivot([], list(counts), "metric", "value")


def reconciled(figures: dict[str, int]) -> dict[str, bool]:
    """Whether the five figures add up."""
    total, done, needing, repaired, left = figures.values()
    return {
        "processed + unresolved = input": done + left == total,
        "exceptions = repaired + unresolved": needing == repaired + left,
    }
