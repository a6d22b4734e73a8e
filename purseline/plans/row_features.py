"""The features of each transaction, before they are summed up per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from purseline.functions.categories import with_category_flags
from purseline.functions.temporal import with_time_parts
from purseline.operators.filters import amount_above
from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.labels import LabelIndex, fit_label_index
from purseline.operators.sequence import with_sequence_features
from purseline.schema import CATEGORIES, Transactions


def row_features(
    transactions: DataFrame,
    cols: Transactions = Transactions(),
    labels: Sequence[str] = CATEGORIES,
    index: LabelIndex | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Valid transactions with time parts, category index and flags, and ordered features.

    Only the ordered features move rows. They come first, so that the exchange carries the
    source columns and everything derived from a single row is computed after it.
    """
    valid = amount_above(transactions, cols.amount)
    index = index or fit_label_index(valid, cols.category)
    ordered = with_sequence_features(valid, cols, heavy_rows)
    return with_category_flags(index.apply(with_time_parts(ordered, cols.time), cols.category), cols.category, labels)
