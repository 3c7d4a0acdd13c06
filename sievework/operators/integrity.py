"""Checks across tables and against contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Contract
from ..sinks.snapshots import ROUTE, write_routed
from .barriers import where_computed
from .grouping import repeated_keys
from .keys import fingerprint


def orphans(child: DataFrame, parent: DataFrame, keys: Mapping[str, str], repeated_parents: bool = False) -> DataFrame:
    """Child rows, whole, whose key (child column: parent column) no parent has.

    A NULL key has no parent either. Written as an anti join: Spark keeps
    LEFT JOIN ... IS NULL as an outer join with a filter. Where parent keys may repeat,
    ``repeated_parents`` reduces them before the shuffle, so that a hot one costs a row per task.
    """
    known = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(keys.values())])
    if repeated_parents:
        known = known.distinct()
    met = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(keys)]
    return child.join(known, met, "left_anti")


def childless(parent: DataFrame, child: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Parent rows no child refers to (keys: parent column to child column)."""
    return orphans(parent, child, keys, repeated_parents=True)


def keyed(df: DataFrame, contract: Contract, name: str = "_digest") -> DataFrame:
    """Each row with a digest of the contract's key, which is what is shuffled however long the key is."""
    return fingerprint(df, contract.key, name)


def contract_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, column_name, violations), zeros included: one aggregate, and one grouping for the key."""
    rules = contract.row_rules()
    names = {f"{rule}|{column}": p for (rule, column), p in rules.items()}
    row = df.agg(*[F.count_if(p).alias(n) for n, p in names.items()]).unpivot([], list(names), "check", "violations")
    parts = F.split("check", "[|]")
    out = row.select(parts[0].alias("rule"), parts[1].alias("column_name"), "violations")
    if contract.key:
        extra = repeated_keys(keyed(df, contract).select("_digest"), ["_digest"], "_n").agg(
            F.lit("unique").alias("rule"),
            F.lit(",".join(contract.key)).alias("column_name"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations"),
        )
        out = out.unionByName(extra)
    return out


def row_violations(contract: Contract) -> Column:
    """The broken row rules as a list of ``rule:column``."""
    marks = [F.when(p, F.lit(f"{rule}:{column}")) for (rule, column), p in contract.row_rules().items()]
    return F.filter(F.array(*marks), lambda m: m.isNotNull())


def with_violations(df: DataFrame, contract: Contract, name: str = "violations") -> DataFrame:
    """Each row with everything the contract holds against it, a repeated key included."""
    out = df.withColumn(name, row_violations(contract))
    if not contract.key:
        return out
    out = keyed(out, contract)
    again = repeated_keys(out.select("_digest"), ["_digest"]).select("_digest", F.lit(True).alias("_again"))
    key = F.lit("unique:" + ",".join(contract.key))
    listed = F.when(F.col("_again"), F.array_append(name, key)).otherwise(F.col(name))
    return out.join(again, "_digest", "left").select(*df.columns, listed.alias(name))


ACCEPTED, REJECTED = "accepted", "rejected"


def split_by_contract(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their violations)."""
    checked = with_violations(df, contract)
    clean = F.array_size("violations") == 0
    return where_computed(checked, clean).drop("violations"), where_computed(checked, ~clean)


def split_written(df: DataFrame, contract: Contract, base: str, run: str) -> tuple[DataFrame, DataFrame]:
    """``split_by_contract`` in one evaluation: the verdict is a column, and one job writes both sides by it.

    The input is scanned once and its key grouped once, whoever reads the sides and how often; each side is read
    from its own files below ``base``.
    """
    checked = with_violations(df, contract)
    verdict = F.when(F.array_size("violations") == 0, ACCEPTED).otherwise(REJECTED)
    written = write_routed(checked.withColumn(ROUTE, verdict), base, run)
    good, bad = (written.filter(F.col(ROUTE) == side).drop(ROUTE) for side in (ACCEPTED, REJECTED))
    return good.drop("violations"), bad


def violations_summary(checks: Mapping[str, DataFrame | tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(check_name, violations) over frames that each list the offenders of one check."""
    parts = [
        df.agg(F.lit(name).alias("check_name"), F.count("*").alias("violations")) for name, df in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
