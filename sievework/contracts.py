"""Table contracts: names, types, NOT NULL, key, text length, text-only identifiers.

A contract is checked as data, not enforced by a store: faulty rows can be counted or
routed away while the rest is loaded.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .functions.text import scientific_id


@dataclass(frozen=True)
class Contract:
    name: str
    columns: str | StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    text_ids: tuple[str, ...] = ()
    # prefixes whose columns must not be left as text
    typed_prefixes: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns) if isinstance(self.columns, str) else self.columns

    @property
    def names(self) -> list[str]:
        return self.schema.names

    def project(self, df: DataFrame) -> DataFrame:
        """The contract's columns in the contract's order."""
        return df.select(*self.names)

    def drift(self, schema: StructType) -> list[tuple[str, str, str]]:
        """(rule, column, detail) wherever a schema departs from the contract; runs no job."""
        have = {f.name: f.dataType for f in schema}
        want = {f.name: f.dataType for f in self.schema}
        out = [("missing_column", c, t.simpleString()) for c, t in want.items() if c not in have]
        out += [("unexpected_column", c, t.simpleString()) for c, t in have.items() if c not in want]
        out += [
            ("type_mismatch", c, f"{have[c].simpleString()} instead of {t.simpleString()}")
            for c, t in want.items()
            if c in have and have[c] != t
        ]
        if [c for c in have if c in want] != [c for c in want if c in have]:
            out.append(("column_order", self.name, ",".join(have)))
        return out + self.misplaced_text(schema)

    def misplaced_text(self, schema: StructType) -> list[tuple[str, str, str]]:
        """Identifiers that lost their text type, and flags still stored as text."""
        out = []
        for f in schema:
            kind = f.dataType.simpleString()
            if f.name in self.text_ids and not isinstance(f.dataType, StringType):
                out.append(("id_not_text", f.name, kind))
            if isinstance(f.dataType, StringType) and f.name.startswith(self.typed_prefixes or ("\0",)):
                out.append(("flag_left_as_text", f.name, kind))
        return out

    def row_rules(self) -> dict[tuple[str, str], Column]:
        """(rule, column) to a predicate that is true on a violation and never NULL."""
        rules = {("not_null", c): F.col(c).isNull() for c in self.not_null()}
        for c, limit in self.max_length.items():
            rules["max_length", c] = F.coalesce(F.char_length(c) > limit, F.lit(False))
        for c in self.text_ids:
            rules["scientific_id", c] = scientific_id(F.col(c))
        return rules

    def not_null(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required]))


def identify(header: Column, contracts: list[Contract], sep: str = ",") -> Column:
    """Name of the contract whose column set a header line carries, else NULL."""
    names = F.array_sort(F.transform(F.split(header, sep), lambda x: F.lower(F.trim(F.regexp_replace(x, '"', "")))))
    hit = F.lit(None).cast("string")
    for c in reversed(contracts):
        columns = F.array(*[F.lit(n) for n in sorted(x.lower() for x in c.names)])
        hit = F.when(names == columns, F.lit(c.name)).otherwise(hit)
    return hit
