"""Command line job: transactions in, user features out.

    python -m purseline.plans.feature_job --input IN --output OUT

or, where the package is not installed, with it in a zip (see README):

    spark-submit --py-files purseline.zip purseline/plans/feature_job.py --input IN --output OUT [--master M] [--partitions N]
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from purseline.plans.user_features import user_features
from purseline.schema import CATEGORIES, Transactions
from purseline.session import build_session
from purseline.sources.tables import read_transactions, write_table


def run(
    spark: SparkSession,
    source: str,
    target: str,
    cols: Transactions = Transactions(),
    labels: tuple[str, ...] = CATEGORIES,
    sort_output: bool = True,
) -> dict[str, float]:
    """Read, compute, write; returns runtime and number of features."""
    started = time.perf_counter()
    features = user_features(read_transactions(spark, source, cols), cols, labels, sort_output=sort_output)
    write_table(features, target)
    return {
        # The two names under which the job's numbers are reported.
        "total_runtime_seconds": time.perf_counter() - started,
        "num_features_engineered": len(features.columns) - 1,
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build per-user features from a transaction table")
    parser.add_argument("--input", required=True, help="folder of Parquet transactions")
    parser.add_argument("--output", required=True, help="folder of the feature table; replaced")
    parser.add_argument("--master", help="Spark master; left to spark-submit when not given")
    parser.add_argument("--partitions", type=int, help="shuffle partitions")
    parser.add_argument("--tiebreak", nargs="*", default=[], help="columns that order rows of equal time")
    parser.add_argument("--scale", type=int, help="decimals of the amounts, for exact sums")
    parser.add_argument("--unsorted", action="store_true", help="skip the final sort")
    args = parser.parse_args(argv)

    spark = build_session("user-features", args.master, args.partitions)
    cols = Transactions(tiebreak=tuple(args.tiebreak), scale=args.scale)
    for name, value in run(spark, args.input, args.output, cols, sort_output=not args.unsorted).items():
        print(f"{name}: {value}")
    spark.stop()


if __name__ == "__main__":
    main()
