"""Two sources, a product file and an orders table, cleaned to their contracts and loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Contract
from ..functions import scalars, text
from ..layouts.shop import ORDERS_LOADED, PRODUCTS_LOADED
from ..operators.cleaning import standard_names
from ..operators.integrity import split_written
from ..session import shared_folder, stage
from ..sinks.relational import reload_table
from ..sinks.tables import write_table
from ..sources.files import read_text_csv
from ..sources.relational import Database, Split, read_relational


def prepare_products(raw: DataFrame, run_at: dt.datetime) -> DataFrame:
    df = standard_names(raw)
    return PRODUCTS_LOADED.project(
        df.withColumns({
            "product_id": scalars.whole(F.col("product_id")),
            "product_name": text.tidy(F.col("product_name"), "Unknown Product"),
            "category": text.tidy(F.col("category")),
            "price": scalars.money(F.col("price"), 10),
            "is_active": text.tri_state(F.col("is_active")),
            "ingestion_timestamp": scalars.load_time(run_at),
        })
    )


def prepare_orders(raw: DataFrame, run_at: dt.datetime) -> DataFrame:
    df = standard_names(raw)
    return ORDERS_LOADED.project(
        df.withColumns({
            "order_id": scalars.whole(F.col("order_id")),
            "customer_id": scalars.whole(F.col("customer_id")),
            "order_date": scalars.timestamp_of(F.col("order_date"), None),
            "status": text.tidy_lower(F.col("status"), "unknown"),
            "order_total": scalars.money_or_zero(F.col("order_total")),
            "ingestion_timestamp": scalars.load_time(run_at),
        })
    )


@dataclass(frozen=True)
class Loaded:
    accepted: int
    rejected: int
    drift: tuple[tuple[str, str, str], ...] = ()


def load(df: DataFrame, contract: Contract, deliver: Callable[[DataFrame], int], rejects: str) -> Loaded:
    """Deliver the rows that meet the contract; write the others, with what they violate, to ``rejects``.

    A batch whose columns differ from the contract is set aside whole instead of failing the run.
    The batch is checked once: one job marks its rows and writes both sides to the shared folder, and delivery and rejects
    read them there. A source that changes in between, or a delivery that is tried again, loses and repeats nothing.
    """
    drift = tuple(contract.drift(df.schema))
    if drift:
        return Loaded(0, write_table(df, rejects), drift)
    if contract.key:  # the key is grouped beside the rows it is joined back to, and both must be of one read of the source
        df = stage(df, contract.name)
    good, bad = split_written(df, contract, shared_folder(df.sparkSession, contract.name), "checked")
    return Loaded(deliver(good), write_table(bad, rejects))


def run(
    spark: SparkSession,
    products_path: str,
    source: Database,
    target: Database,
    rejects: str,
    run_at: dt.datetime | None = None,
    orders_table: str = "orders",
    targets: tuple[str, str] = ("dbo.products_loaded", "dbo.orders_loaded"),
    split: Split | None = None,
    writers: int | None = None,
) -> dict[str, Loaded]:
    """Reload both targets; one load time, so both tables and any retry of the run agree."""
    run_at = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    products = prepare_products(read_text_csv(spark, products_path, multiline=False), run_at)
    orders = prepare_orders(read_relational(spark, source, orders_table, split), run_at)
    out = {}
    for df, contract, name in ((products, PRODUCTS_LOADED, targets[0]), (orders, ORDERS_LOADED, targets[1])):
        def deliver(good: DataFrame, name: str = name) -> int:
            return reload_table(good, target, name, writers)

        out[contract.name] = load(df, contract, deliver, f"{rejects}/{contract.name}")
    return out
