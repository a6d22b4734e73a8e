"""Column bindings and declared schemas.

Every operator takes its column names from a binding, so one implementation serves any
table that has a user, an amount, a time and a category.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The four categories of the default transaction table.
CATEGORIES = ("Electronics", "Groceries", "Clothing", "Entertainment")


@dataclass(frozen=True)
class Transactions:
    """Which columns of a table play which part.

    ``tiebreak`` names columns that, after ``time``, put one user's rows in a total order.
    Without any, rows of equal time are ordered by amount, which leaves only rows that are
    interchangeable for every ordered feature.

    ``scale`` says that amounts are money with that many decimals. Sums then run on whole
    units, so they are exact and do not depend on partitioning. ``None`` adds doubles.
    """

    user: str = "user_id"
    amount: str = "amount"
    time: str = "timestamp"
    category: str = "category"
    tiebreak: tuple[str, ...] = ()
    scale: int | None = None

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *(self.tiebreak or (self.amount,)))

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.user, self.amount, self.time, self.category, *self.tiebreak)))

    def check(self, df: DataFrame) -> DataFrame:
        """Fail early, with the names, when the table lacks a bound column or has it in a wrong type."""
        missing = [name for name in self.required if name not in df.columns]
        if missing:
            raise ValueError(f"missing columns {missing}; the table has {df.columns}")
        if not isinstance(df.schema[self.amount].dataType, T.NumericType):
            raise TypeError(f"{self.amount} must be numeric, not {df.schema[self.amount].dataType.simpleString()}")
        time_type = df.schema[self.time].dataType
        if not isinstance(time_type, (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)):
            raise TypeError(f"{self.time} must be a time or its text, not {time_type.simpleString()}")
        return df


@dataclass(frozen=True)
class Events:
    """Column names of decoded stream events."""

    key: str = "event_id"
    user: str = "user_id"
    amount: str = "transaction_amount"
    time: str = "timestamp"


# The fields of the JSON message, a wire contract. Ids are BIGINT, so that ids beyond 2^31 are kept.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# What the topic source delivers for each message; only ``value`` is used.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
