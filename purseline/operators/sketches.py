"""Approximate percentiles and distinct counts from stored summaries that merge.

Percentiles come from counts in buckets whose bounds grow by a constant factor: the value
read off a bucket is within ``ERROR`` of any value in it. Buckets of two batches are merged by
adding counts, so a summary does not depend on how rows were dealt over batches. Distinct
counts come from HyperLogLog sketches, as built in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from purseline.operators.latency import PERCENTILES

#: Relative error of a percentile; the factor between bounds of buckets follows.
ERROR = 0.01
#: log2 of a sketch's registers: 4,096, a relative deviation of 1.04 / 64 = 1.6 %.
REGISTERS = 12
DEVIATION = 1.04 / 2 ** (REGISTERS / 2)


def bucket_of(value: Column, error: float = ERROR) -> Column:
    """The bucket of a number: by sign and size; NULL, NaN and infinite values have none."""
    value = value.cast("double")
    size = F.ceil(F.log(F.abs(value)) / F.lit(log((1 + error) / (1 - error))))
    # Sizes of doubles stay far below 2^40, so the sign can be told by shifting the number.
    signed = F.when(value > 0, size + (1 << 40)).when(value < 0, -size - (1 << 40)).otherwise(F.lit(0).cast("long"))
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), signed)


def value_of(bucket: Column, error: float = ERROR) -> Column:
    """A value within ``error`` of all values of the bucket, which rises with the bucket."""
    factor = (1 + error) / (1 - error)
    size = F.abs(bucket) - (1 << 40)
    middle = F.pow(F.lit(factor), size.cast("double")) * F.lit(1 - error)
    return F.when(bucket == 0, F.lit(0.0)).when(bucket > 0, middle).otherwise(-middle)


def percentile_buckets(df: DataFrame, by: Sequence[str], value: str, error: float = ERROR) -> DataFrame:
    """``(by..., bucket, n)``: a summary to store, some hundred rows per group for values of usual spread."""
    known = df.withColumn("bucket", bucket_of(F.col(value), error)).where(F.col("bucket").isNotNull())
    return known.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))


def bucket_percentiles(
    buckets: DataFrame, by: Sequence[str], percentiles: Mapping[str, float] = PERCENTILES, error: float = ERROR
) -> DataFrame:
    """Per group the number of values and each percentile within ``error`` of the value of that rank.

    The rank is the lower one where a percentile lies between two. ``buckets`` may come from
    any number of batches. A group has as many rows as different buckets after merging, a few
    thousand at most per decade of the spread's logarithm, so its window is small at any size.
    """
    merged = buckets.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumns({"_upto": F.sum("n").over(order), "_all": F.sum("n").over(Window.partitionBy(*by))})
    found = ranked.groupBy(*by).agg(
        F.max("_all").alias("n"),
        *[
            F.min(F.when(F.col("_upto") > F.floor(F.lit(p) * (F.col("_all") - 1)), F.col("bucket"))).alias(name)
            for name, p in percentiles.items()
        ],
    )
    return found.withColumns({name: value_of(F.col(name), error) for name in percentiles})


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, registers: int = REGISTERS) -> DataFrame:
    """``(by..., sketch)``: a summary of the different values, to store; NULL is no value."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(registers)).alias("sketch"))


def sketch_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group about how many different values all its sketches together have seen."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
