"""Read from a database over JDBC, in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}


@dataclass(frozen=True)
class Split:
    """Even ranges of a numeric, date or timestamp column; rows outside the bounds are read too."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


def read_options(db: Database, table: str, split: Split | None = None, fetch_rows: int = 10_000) -> dict[str, str]:
    out = {**db.options(), "dbtable": table, "fetchsize": str(fetch_rows)}
    return out | split.options() if split else out


def read_relational(
    spark: SparkSession,
    db: Database,
    table: str,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table scan; filters and column choices on the result are pushed to the database.

    Without ``split`` or ``predicates`` one task reads everything. If values crowd in one
    range, give ``predicates``: disjoint conditions, together complete, one task each.
    """
    if predicates:
        props = {"user": db.user, "password": db.password, "driver": db.driver, "fetchsize": "10000"}
        return spark.read.jdbc(db.url, table, predicates=list(predicates), properties=props)
    return spark.read.format("jdbc").options(**read_options(db, table, split)).load()
