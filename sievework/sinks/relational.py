"""Write to a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.relational import Database


def reload_options(db: Database, table: str, writers: int | None = None, batch_rows: int = 10_000) -> dict[str, str]:
    """Overwrite by TRUNCATE + INSERT, so the target keeps its column types and keys."""
    out = {**db.options(), "dbtable": table, "truncate": "true", "batchsize": str(batch_rows)}
    return out | {"numPartitions": str(writers)} if writers else out


def reload_table(df: DataFrame, db: Database, table: str, writers: int | None = None) -> int:
    """Replace the target's rows and return how many were written; ``writers`` bounds the connections.

    Each task commits for itself. After a lost executor a task may insert again, which
    the target's primary key then rejects; the reload can simply be started anew.
    """
    rows = Observation()
    out = df.observe(rows, F.count(F.lit(1)).alias("n"))
    out.write.format("jdbc").options(**reload_options(db, table, writers)).mode("overwrite").save()
    return rows.get["n"]
