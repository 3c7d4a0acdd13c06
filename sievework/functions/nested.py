"""JSON text to lists and objects, and picking from them, as plain expressions.

Each row's list is searched in place with higher-order functions, so matching needs
no explode, no join back and no surrogate key, and cannot change the row count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def unescape_commas(col: Column) -> Column:
    r"""Turn ``\,`` into ``,``; other escapes such as ``\n`` and ``\"`` stay."""
    return F.replace(col, F.lit("\\,"), F.lit(","))


def parse_list(col: Column, item_ddl: str) -> Column:
    """JSON list of objects, commas unescaped first; unreadable text becomes NULL."""
    return F.from_json(unescape_commas(col), f"array<struct<{item_ddl}>>")


def parse_closed_list(col: Column, item_ddl: str) -> Column:
    """Parse a list cut off inside its last object, by closing object and list."""
    return F.from_json(F.concat(unescape_commas(col), F.lit("}]")), f"array<struct<{item_ddl}>>")


def parse_object(col: Column, ddl: str) -> Column:
    """JSON object that keeps the source text in ``_corrupt_record`` if anything was unreadable."""
    return F.from_json(
        unescape_commas(col), f"struct<{ddl},{CORRUPT}:string>", {"columnNameOfCorruptRecord": CORRUPT}
    )


def list_unreadable(source: Column, parsed: Column) -> Column:
    return source.isNotNull() & parsed.isNull()


def object_unreadable(parsed: Column) -> Column:
    return parsed[CORRUPT].isNotNull()


def same(a: Column, b: Column) -> Column:
    return a == b


def alike(a: Column, b: Column) -> Column:
    """Equal but for case and outer blanks."""
    return F.upper(F.trim(a)) == F.upper(F.trim(b))


def matching(items: Column, field: str, key: Column, test: Callable[[Column, Column], Column] = same) -> Column:
    """The list elements whose ``field`` meets the row's key; NULL never matches."""
    return F.filter(items, lambda item: test(item[field], key))


def hits(found: Column) -> Column:
    """How many elements were found, 0 for a missing list, as bigint."""
    return F.coalesce(F.array_size(found), F.lit(0)).cast("long")


def only(found: Column) -> Column:
    """The element if exactly one was found."""
    return F.when(F.array_size(found) == 1, F.get(found, F.lit(0)))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def flat(struct: str, fields: list[str], prefix: str) -> list[Column]:
    """One prefixed column per top-level field; what is nested deeper stays whole."""
    return [F.col(struct)[name].alias(prefix + name) for name in fields]


def open_keys(col: Column) -> Column:
    """An object with unknown keys, as a map of text."""
    return F.from_json(unescape_commas(col), "map<string,string>")
