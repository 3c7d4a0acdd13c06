"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from sievework.session import apply_job_settings, size_shuffles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The given tables by attribute; a file's schema is inferred once per process."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        scan = self.spark.read.schema(SCHEMAS[path]).parquet(path)
        size_shuffles(scan)
        return scan


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking engine has them."""
    moments = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in moments}) if moments else df


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return zoneless(fn(Tables(apply_job_settings(spark), folder)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
