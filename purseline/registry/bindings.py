"""How the given tables are read as transactions and as events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purseline.schema import Transactions
from purseline.sources.tables import read_transactions

EVENTS = Transactions("user_id", "value", "ts", "event_type", ("event_id",), scale=2)
ORDERS = Transactions("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", ("o_orderkey",), scale=2)

# Listed categories of the events; the fifth type, error, stays without a count of its own.
EVENT_LABELS = ("click", "purchase", "signup", "view")


@dataclass(frozen=True)
class Query:
    """A registered query and, where SQL can say it, the SQL it must agree with."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_transactions(spark, f"{sf_dir}/events.parquet", EVENTS)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_transactions(spark, f"{sf_dir}/orders.parquet", ORDERS)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the shape of decoded stream events."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("value").alias("transaction_amount"), F.col("ts").alias("timestamp")
    )


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round what two engines add up in different order, for comparison."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})
