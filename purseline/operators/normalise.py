"""Population statistics over users and z-scores against them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import ratio

# Feature -> name of its z-score, and feature -> suffix of its statistics.
ZSCORES = {
    "total_spent": "total_spent_zscore",
    "avg_transaction": "avg_transaction_zscore",
    "transaction_count": "txn_count_zscore",
}
STATISTICS = {"total_spent": "total", "avg_transaction": "avg", "transaction_count": "count"}


def population_stats(features: DataFrame, columns: Mapping[str, str] = STATISTICS) -> DataFrame:
    """One row: ``mu_<suffix>`` and sample ``sigma_<suffix>`` of each column."""
    return features.agg(
        *[
            statistic(column).alias(f"{name}_{suffix}")
            for column, suffix in columns.items()
            for name, statistic in (("mu", F.avg), ("sigma", F.stddev_samp))
        ]
    )


def with_zscores(features: DataFrame, zscores: Mapping[str, str] = ZSCORES) -> DataFrame:
    """Add (x - mean) / sample deviation; NULL where the deviation is 0 or unknown.

    The statistics enter as one scalar subquery: nothing is collected, nothing is joined.
    ``features`` is evaluated for the statistics and for the rows; stage it first when it is
    costly to compute.
    """
    stats = population_stats(features, {column: column for column in zscores})
    one_row = stats.select(F.struct(*stats.columns)).scalar()
    scored = features.withColumn("_population", one_row)
    return scored.withColumns(
        {
            name: ratio(F.col(column) - F.col(f"_population.mu_{column}"), F.col(f"_population.sigma_{column}"))
            for column, name in zscores.items()
        }
    ).drop("_population")
