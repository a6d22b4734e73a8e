"""One 0/1 flag per listed category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_flags(category: Column, labels: Sequence[str]) -> dict[str, Column]:
    """``is_<label>`` for each listed label; NULL for a NULL category, no flag for other labels."""
    return {f"is_{label.lower()}": (category == F.lit(label)).cast("int") for label in labels}


def with_category_flags(df: DataFrame, category: str, labels: Sequence[str]) -> DataFrame:
    return df.withColumns(category_flags(F.col(category), labels))
