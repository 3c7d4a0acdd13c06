"""Whole-frame clean-up steps; each is one projection, whatever the number of columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text


def standard_names(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case names with blanks as underscores; two that end up equal are an error."""
    names = [re.sub(r"\s+", "_", c.strip()).lower() for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns collide after renaming: {clash}")
    return df.toDF(*names)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def null_sentinels(df: DataFrame, sentinels: Iterable[str] = text.NULL_TEXT) -> DataFrame:
    """NULL instead of a sentinel in every text column."""
    sentinels = tuple(sentinels)
    return df.withColumns({c: text.blank_sentinel(F.col(c), sentinels) for c in text_columns(df)})


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(exprs))


def in_order(df: DataFrame, *groups: Sequence[str]) -> DataFrame:
    """The named columns, group after group; a repeated name is kept once, where it came first."""
    return df.select(*dict.fromkeys(c for g in groups for c in g))


def redact(df: DataFrame, members: Mapping[str, Sequence[str]], salt: str | None = None) -> DataFrame:
    """Blank members of struct columns, or with a salt replace them by a salted SHA-256."""

    def masked(struct: str) -> Column:
        out = F.col(struct)
        for name in members[struct]:
            value = F.col(struct)[name].cast("string")
            out = out.withField(
                name,
                F.lit(None).cast("string") if salt is None else F.sha2(F.concat(F.lit(salt), value), 256),
            )
        return out

    return df.withColumns({s: masked(s) for s in members})


def redact_text(raw: Column, fields: Sequence[str], readable: Column) -> Column:
    """Raw JSON text without the values of the named members, at whatever depth.

    A text that cannot be parsed goes as a whole, and so does one where a value might hide: a name spelled
    with escapes, or a member that is still something other than a string, number, boolean or null.
    """
    out = raw
    for name in fields:
        # most texts lack most names, and a plain search is far cheaper than a pattern
        value = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][-+0-9.eE]*|true|false|null)'
        pattern = rf'("{name}"\s*:\s*){value}'
        out = _once(out, lambda text: F.when(_named(raw, name), F.regexp_replace(text, pattern, "$1null")).otherwise(text))  # noqa: B023

    def without_hiding(cleared: Column) -> Column:
        hides = F.contains(raw, F.lit("\\u"))
        for name in fields:
            hides = hides | (_named(raw, name) & cleared.rlike(rf'"{name}"\s*:\s*(?!null)\S'))
        return F.when(~hides, cleared)

    return F.when(readable, _once(out, without_hiding))


def _once(text: Column, step: Callable[[Column], Column]) -> Column:
    """A step that looks at a text more than once; as the element of a list the text is made once for all of it."""
    return F.get(F.transform(F.array(text), step), F.lit(0))


def _named(raw: Column, name: str) -> Column:
    return F.contains(raw, F.lit(f'"{name}"'))
