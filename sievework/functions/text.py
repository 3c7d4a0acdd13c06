"""Column expressions for text clean-up. None of them can fail on a bad value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings the feeds use.
NULL_TEXT = ("null",)
YES_TEXT = ("true", "1", "yes")
NO_TEXT = ("false", "0", "no")
SCIENTIFIC_ID = r"^\d\.\d+E\+\d+$"


def is_sentinel(col: Column, sentinels: Iterable[str] = NULL_TEXT) -> Column:
    """True where the trimmed text is a stand-in for a missing value (case matters)."""
    return F.coalesce(F.trim(col).isin(*sentinels), F.lit(False))


def blank_sentinel(col: Column, sentinels: Iterable[str] = NULL_TEXT) -> Column:
    """NULL for a sentinel, the untouched text otherwise."""
    return F.when(F.trim(col).isin(*sentinels), F.lit(None)).otherwise(col)


def flag_tf(col: Column) -> Column:
    """``t`` is true, any other text false, NULL stays NULL."""
    return col == F.lit("t")


def tri_state(col: Column, yes: Iterable[str] = YES_TEXT, no: Iterable[str] = NO_TEXT) -> Column:
    """Known spellings in any case become true or false; the rest, padded ones too, NULL."""
    low = F.lower(col)
    return F.when(low.isin(*yes), True).when(low.isin(*no), False)


def tidy(col: Column, default: str | None = None, empty_as_null: bool = False) -> Column:
    """Trim; optionally treat an empty result as missing; fill missing with a default."""
    out = F.trim(col)
    if empty_as_null:
        out = F.nullif(out, F.lit(""))
    return out if default is None else F.coalesce(out, F.lit(default))


def tidy_lower(col: Column, default: str | None = None) -> Column:
    return tidy(F.lower(col), default)


def scientific_id(col: Column) -> Column:
    """True for an identifier a spreadsheet has already turned into ``1.5502E+13``."""
    return F.coalesce(col.contains("E+") & col.rlike(SCIENTIFIC_ID), F.lit(False))
