"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def amount_above(df: DataFrame, amount: str, minimum: float = 0.0) -> DataFrame:
    """Keep amounts strictly above ``minimum``; NULL goes, NaN (the largest double) stays.

    A plain comparison with a literal, so it reaches the Parquet scan.
    """
    return df.where(F.col(amount) > F.lit(minimum))
