"""Compare a registered query with its SQL in DuckDB: types, row count, and all values."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _type(simple: str) -> str:
    return TYPES.get(simple, simple.upper())


def differences(df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    found = db.sql(sql)
    want = {n: str(t) for n, t in zip(found.columns, found.types)}
    have = {f.name: _type(f.dataType.simpleString()) for f in df.schema}
    if have != want:
        return [f"schema {set(have.items()) ^ set(want.items())}"]
    order = sorted(have)
    got = Counter(tuple(r[c] for c in order) for r in df.collect())
    at = [found.columns.index(c) for c in order]
    expected = Counter(tuple(r[i] for i in at) for r in found.fetchall())
    if got != expected:
        extra, lacking = list((got - expected).items())[:3], list((expected - got).items())[:3]
        return [f"{sum(got.values())} rows for {sum(expected.values())}", f"extra {extra}", f"lacking {lacking}"]
    return []
