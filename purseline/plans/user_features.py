"""The whole feature table: filter, time parts, categories, statistics, z-scores, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from purseline.functions.temporal import with_event_time
from purseline.operators.filters import amount_above
from purseline.operators.labels import LabelIndex, fit_label_index
from purseline.operators.normalise import with_zscores
from purseline.operators.profile import (
    amount_measures,
    category_measures,
    sequence_measures,
    temporal_measures,
    user_profile,
)
from purseline.schema import CATEGORIES, Transactions
from purseline.staging import stage


def user_statistics(
    transactions: DataFrame,
    cols: Transactions = Transactions(),
    labels: Sequence[str] = CATEGORIES,
    index: LabelIndex | None = None,
) -> DataFrame:
    """The 19 statistics per user (with four listed labels), in one pass over the table.

    ``index`` may come from an earlier fit; otherwise it is fitted here, which reads the
    amount and category columns once.
    """
    valid = with_event_time(amount_above(transactions, cols.amount), cols.time)
    index = index or fit_label_index(valid, cols.category)
    indexed = index.apply(valid, cols.category)
    measures = (
        amount_measures(cols)
        + temporal_measures(cols)
        + category_measures(cols, labels)
        + sequence_measures(valid, cols)
    )
    return user_profile(indexed, cols, measures)


def user_features(
    transactions: DataFrame,
    cols: Transactions = Transactions(),
    labels: Sequence[str] = CATEGORIES,
    index: LabelIndex | None = None,
    sort_output: bool = True,
) -> DataFrame:
    """The 19 statistics and 3 z-scores per user, ordered by user.

    The statistics are staged: they are far smaller than the transactions, and z-scores
    (and the sampling of the final sort) then read them instead of the transactions again.
    """
    features = with_zscores(stage(user_statistics(transactions, cols, labels, index), "user-statistics"))
    return features.orderBy(cols.user) if sort_output else features
