"""The daily returns feed: from raw text to a typed table and a table of exceptions.

There is no join, grouping or cache between the scan and the write: one job reads the
feed once, writes published and unresolved rows side by side, and collects the profile,
the losses and the summary on the way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contracts import Contract
from ..functions import nested, scalars, text
from ..layouts import returns as layout
from ..operators import exceptions as ex
from ..operators.cleaning import in_order, null_sentinels, redact, redact_text
from ..operators.flatten import narrow_decimals
from ..operators.keys import number_rows
from ..sinks.snapshots import ROUTE, current_run, succeed, write_routed
from ..sinks.tables import lay_table_over, read_back, write_table
from ..sources.files import read_fitting_csv

ITEMS = ex.ListSpec(layout.ARTICLE)
OBJECT = ex.ObjectSpec(layout.CUSTOM_FIELDS)
PUBLISHED, UNRESOLVED = "published", "unresolved"


def scalar_columns() -> dict[str, Column]:
    """Typed columns of the cleaned feed; flags, counts and price replace their text."""
    out = {c: text.flag_tf(F.col(c)) for c in layout.FLAGS}
    out |= {c: scalars.moment(F.col(d), F.col(t)) for c, (d, t) in layout.MOMENTS.items()}
    out |= {c: scalars.timestamp_of(F.col(s)) for c, s in layout.TIMESTAMPS.items()}
    out |= {c: scalars.date_of(F.col(s)) for c, s in layout.DATES.items()}
    out[layout.PRICE] = scalars.money(F.col(layout.PRICE))
    out |= {c: scalars.whole(F.col(c)) for c in layout.DAY_COUNTS}
    return out


def clean(raw: DataFrame) -> DataFrame:
    """Row key, NULL sentinels, types. Raw dates and times stay beside the combined ones."""
    if layout.ROW_KEY not in raw.columns:
        raw = number_rows(raw, layout.ROW_KEY)
    return null_sentinels(raw).withColumns(scalar_columns())


def typed_extras(df: DataFrame) -> DataFrame:
    """Optional typed companions of two columns that are published as text."""
    return df.withColumns({
        "return_quantity_int": scalars.whole(F.col("return_quantity")),
        "export_created_ts": scalars.timestamp_of(F.col("export_created_time")),
    })


def resolve(cleaned: DataFrame, reclassify: bool = True) -> DataFrame:
    """Parse, match, classify and repair; parsed columns stay nested."""
    return ex.resolve(cleaned, ITEMS, OBJECT, reclassify)


def lay_out(resolved: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """Flatten, narrow the money columns, and put everything in the published order, extra columns last."""
    wide = resolved.select(
        "*",
        *nested.flat(ex.ELEMENT, layout.article_fields(), layout.LIST_PREFIX),
        *nested.flat(ex.OBJECT, layout.custom_fields(), layout.OBJECT_PREFIX),
    )
    p = layout.LIST_PREFIX
    wide = narrow_decimals(
        wide, [p + c for c in layout.ARTICLE_MONEY], {p + s: m for s, m in layout.ARTICLE_MONEY_NESTED.items()}
    )
    return in_order(wide, layout.published_columns(), extras)


def extra_columns(raw: DataFrame) -> list[str]:
    """Columns that the feed has beyond the known ones; they are kept as they come."""
    extras = [c for c in raw.columns if c not in layout.RAW_COLUMNS and c != layout.ROW_KEY]
    clash = sorted(set(extras) & {*layout.published_columns(), ROUTE, ex.ELEMENT, ex.OBJECT})
    if clash:
        raise ValueError(f"feed has columns named like derived ones: {clash}")
    return extras


def transform(raw: DataFrame, reclassify: bool = True) -> DataFrame:
    """Raw feed to all rows in the published layout, exceptions still among them."""
    return lay_out(resolve(clean(raw), reclassify), extra_columns(raw))


def without_personal(laid_out: DataFrame, salt: str | None = None) -> DataFrame:
    """Personal members blanked, or hashed with a salt, in the parsed object, and blanked in its raw text.

    A raw text that cannot be parsed is blanked as a whole, since nothing tells where it holds them.
    """
    members = {layout.OBJECT_PREFIX + struct: fields for struct, fields in layout.PERSONAL_FIELDS.items()}
    names = [f for fields in layout.PERSONAL_FIELDS.values() for f in fields]
    raw = redact_text(F.col(layout.OBJECT_SOURCE), names, ~F.col("custom_fields_parse_failed"))
    return redact(laid_out.withColumn(layout.OBJECT_SOURCE, raw), members, salt)


def present(df: DataFrame, columns: list[str], stage: str) -> list[Column]:
    """Non-NULL counts, named by stage; comparing stages tells what a step emptied."""
    return [F.count(c).alias(f"{stage} {c}") for c in columns if c in df.columns]


@cache
def output_contract() -> Contract:
    """The published layout: text, but for the columns the cleaning and parsing steps type."""
    kinds = dict.fromkeys(layout.RAW_COLUMNS, "string") | dict.fromkeys(layout.FLAGS, "boolean")
    kinds |= dict.fromkeys(layout.DAY_COUNTS, "int") | {layout.PRICE: "decimal(12,2)", layout.ROW_KEY: "bigint"}
    kinds |= dict.fromkeys([*layout.MOMENTS, *layout.TIMESTAMPS], "timestamp") | dict.fromkeys(layout.DATES, "date")
    for ddl, prefix in ((layout.ARTICLE, layout.LIST_PREFIX), (layout.CUSTOM_FIELDS, layout.OBJECT_PREFIX)):
        kinds |= {prefix + f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl)}
    money = [layout.LIST_PREFIX + c for c in layout.ARTICLE_MONEY]
    kinds |= dict.fromkeys(money, "decimal(12,2)")
    for struct, members in layout.ARTICLE_MONEY_NESTED.items():
        kinds[layout.LIST_PREFIX + struct] = f"struct<{','.join(m + ':decimal(12,2)' for m in members)}>"
    kinds |= dict.fromkeys(layout.CHECK_COLUMNS, "boolean") | {"articles_match_count": "bigint", "exception_type": "string"}
    return Contract(
        "returns",
        ", ".join(f"`{c}` {kinds[c]}" for c in layout.published_columns()),
        text_ids=tuple(layout.TEXT_IDS),
        typed_prefixes=("is_", "has_"),
    )


@dataclass
class ReturnsRun:
    """Where a run wrote and what it counted; the column counts leave out zeros."""

    base: str
    run: str
    sentinels: dict[str, int]
    unreadable: dict[str, int]
    damaged_ids: dict[str, int]
    summary: dict[str, int]
    checks: dict[str, bool] = field(default_factory=dict)

    def path(self, which: str = PUBLISHED) -> str:
        return f"{self.base}/run={self.run}/{ROUTE}={which}"


def _emptied(before: dict, after: dict, columns: list[str]) -> dict[str, int]:
    found = {c: before[f"before {c}"] - after[f"after {c}"] for c in columns}
    return {c: n for c, n in found.items() if n}


def run(
    raw: DataFrame,
    base: str,
    exceptions_target: str,
    fmt: str = "parquet",
    table: str | None = None,
    reclassify: bool = True,
    redacted: bool = False,
    salt: str | None = None,
) -> ReturnsRun:
    """Process a feed: published and unresolved rows below ``base``, diagnostics in ``exceptions_target``.

    The wide transformation runs once; what it emptied is told from non-NULL counts before
    and after each step, taken on the way. Columns the layout does not know come last, as
    they are. The exceptions table is then read off the unresolved part. ``table`` also publishes to a catalog table. With
    ``redacted``, nothing written holds personal members (see ``without_personal``). A run that does not
    reconcile raises and leaves the previous run current, in ``base`` as in both targets.
    """
    spark = raw.sparkSession
    run_id, previous = uuid.uuid4().hex[:12], current_run(spark, base)
    on_raw, on_nulled, on_final = Observation(), Observation(), Observation()
    sources = {**layout.TIMESTAMPS, **layout.DATES}
    retyped = [layout.PRICE, *layout.DAY_COUNTS]

    missing = sorted(set(layout.RAW_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"feed lacks columns {missing}")
    keyed = raw if layout.ROW_KEY in raw.columns else number_rows(raw, layout.ROW_KEY)
    keyed = keyed.observe(on_raw, F.count(F.lit(1)).alias("rows"), *present(keyed, layout.RAW_COLUMNS, "before"))
    nulled = null_sentinels(keyed)
    both_parts = [
        F.count_if(F.col(d).isNotNull() & F.col(t).isNotNull()).alias(f"before {c}") for c, (d, t) in layout.MOMENTS.items()
    ]
    nulled = nulled.observe(
        on_nulled,
        *present(nulled, layout.RAW_COLUMNS, "after"),
        *[F.count(c).alias(f"before {c}") for c in retyped],
        *[F.count(s).alias(f"before {c}") for c, s in sources.items()],
        *both_parts,
        *[F.count_if(text.scientific_id(F.col(c))).alias(f"damaged {c}") for c in layout.TEXT_IDS],
    )
    extras = extra_columns(raw)
    final = lay_out(resolve(nulled.withColumns(scalar_columns()), reclassify), extras)
    if redacted:
        final = without_personal(final, salt)
    drift = output_contract().drift(final.drop(*extras).schema)
    if drift:
        raise ValueError(f"output differs from its contract: {drift}")
    final = final.observe(
        on_final,
        *[c.alias(name) for name, c in ex.summary_counts().items()],
        *present(final, [*retyped, *sources, *layout.MOMENTS], "after"),
    )
    marked = final.withColumn(ROUTE, ex.route_name(PUBLISHED, UNRESOLVED))
    written = write_routed(marked, base, run_id, distinct=layout.MOSTLY_DISTINCT)

    got_raw, got_nulled, got = on_raw.get, on_nulled.get, on_final.get
    out = ReturnsRun(
        base,
        run_id,
        sentinels=_emptied(got_raw, got_nulled, layout.RAW_COLUMNS),
        unreadable=_emptied(got_nulled, got, [*retyped, *sources, *layout.MOMENTS]),
        damaged_ids={c: n for c in layout.TEXT_IDS if (n := got_nulled[f"damaged {c}"])},
        summary={m: got[m] for m in ex.summary_counts()},
    )
    stored = {r[ROUTE]: r["n"] for r in written.groupBy(ROUTE).agg(F.count("*").alias("n")).collect()}
    out.checks = ex.reconciled(out.summary) | {
        "rows read = rows in": got_raw["rows"] == out.summary["Total input rows"],
        "published rows stored": stored.get(PUBLISHED, 0) == out.summary["Successfully processed rows"],
        "unresolved rows stored": stored.get(UNRESOLVED, 0) == out.summary["Rows still unresolved"],
    }
    failed = [name for name, ok in out.checks.items() if not ok]
    if failed:
        raise RuntimeError(f"run {run_id} does not reconcile: {failed}")
    succeed(spark, base, run_id, previous)
    refresh(written, base, exceptions_target, fmt, table)
    return out


def refresh(stored: DataFrame, base: str, exceptions_target: str, fmt: str = "parquet", table: str | None = None) -> None:
    """Bring the exceptions table and the catalog table to the current run; ``stored`` is that run read as a whole.

    The run is the truth, both are derived from it and refreshed behind the pointer's move: after a crash in between, call
    this again. The catalog table is not a second copy; it lies over the run's published files.
    """
    spark = stored.sparkSession
    bad = stored.filter(F.col(ROUTE) == UNRESOLVED).select(*layout.DIAGNOSTIC_COLUMNS)
    write_table(bad, exceptions_target, fmt)
    if table:
        place = f"{base}/run={current_run(spark, base)}/{ROUTE}={PUBLISHED}"
        lay_table_over(spark, table, place, stored.drop(ROUTE).schema, fmt)


@dataclass
class ReturnsBatch:
    """What a batch of files came to: the run of those that fit (None if none did) and the faults of the others."""

    done: ReturnsRun | None
    set_aside: DataFrame


def run_files(
    spark: SparkSession, path: str | list[str], base: str, exceptions_target: str, rejects: str, multiline: bool = True, **options
) -> ReturnsBatch:
    """Process a batch of CSV files, each by its own header: a file whose layout does not fit is set aside and costs itself only.

    ``rejects`` gets (file, rule, column) of the files that were left out; their rows stay where they are and come with
    a later batch, once the file or the layout is mended. With no fitting file the previous run stays current.
    """
    raw, faults = read_fitting_csv(spark, path, [c for c in layout.RAW_COLUMNS if c != layout.ROW_KEY], multiline)
    write_table(faults, rejects)
    return ReturnsBatch(None if raw is None else run(raw, base, exceptions_target, **options), read_back(spark, rejects))
