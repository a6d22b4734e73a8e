"""Ordered work on keys of any size: slices of consecutive rows, and what one tells the next.

A window by key sends all rows of a key to one task. That is right for almost every key and
fatal for one that holds a third of the table. Rows of such heavy keys are range-partitioned
by key and order into slices; each slice is a window of its own, and one small row per slice
and key carries to it what the slices before have left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.operators.heavy import HEAVY_ROWS, key_sizes
from purseline.sources.local import local_table
from purseline.staging import stage, staging_path

#: Columns that tell a row's slice, and its place in the order of all rows.
SLICE, AT = "_slice", "_at"


def split_heavy(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> tuple[DataFrame, DataFrame | None, int, int]:
    """Rows of light keys, rows of heavy ones (None: there are none), their number, and the largest key's.

    The key column is read to count. Only if a key is heavy the table is read once more and
    written with a mark, so that the two parts are read back each for itself. With
    ``heavy_rows`` 0 all keys are heavy, and a written table is passed on as it is.
    """
    heavy, largest = key_sizes(df, key, heavy_rows)
    rows = sum(n for _, n in heavy)
    if not heavy:
        return df, None, 0, largest
    if heavy_rows < 1:
        return df.where(F.lit(False)), df, rows, largest
    spark = df.sparkSession
    names = local_table(spark, {"_heavy": [item for item, _ in heavy], "_mark": [1] * len(heavy)}, {
        "_heavy": df.schema[key].dataType, "_mark": T.IntegerType(),
    })
    marked = df.join(F.broadcast(names), F.col(key).eqNullSafe(F.col("_heavy")), "left")
    marked = marked.withColumn("_mark", F.coalesce("_mark", F.lit(0))).drop("_heavy")
    path = staging_path(spark, "marked-rows")
    marked.write.partitionBy("_mark").parquet(path)
    # The mark is a folder: reading one part does not touch the other.
    schema = T.StructType([*df.schema.fields, T.StructField("_mark", T.IntegerType())])
    back = spark.read.schema(schema).parquet(path)
    parts = [back.where(F.col("_mark") == mark).drop("_mark") for mark in (0, 1)]
    return parts[0], parts[1], rows, largest


def slice_count(df: DataFrame, rows: int, heavy_rows: int) -> int:
    """As many slices as keep each at half the size of a heavy key, and as many as tasks anyway."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, -(-2 * rows // (heavy_rows or HEAVY_ROWS)))


def in_slices(df: DataFrame, key: str, order: Sequence[str], slices: int, unique: bool = False) -> DataFrame:
    """The rows with ``_slice`` and ``_at``, written, which fixes them.

    ``_at`` rises with the slice and, in order, within it. Where rows of a key may tie
    (``unique`` false), a row id completes the order, or a hot group of copies would end up in
    one slice; ``df`` must then be a written table, whose ids are the same in every attempt.
    """
    total = (key, *order)
    if not unique:
        df = df.withColumn("_row", F.monotonically_increasing_id())
        total = (*total, "_row")
    rows = df.repartitionByRange(slices, *total).sortWithinPartitions(*total).drop("_row")
    return stage(rows.withColumns({SLICE: F.spark_partition_id(), AT: F.monotonically_increasing_id()}), "slices")


def slice_window(key: str) -> WindowSpec:
    """The rows of a key in one slice, in order."""
    return Window.partitionBy(key, SLICE).orderBy(AT)


def with_starts(
    sliced: DataFrame, key: str, ends: dict[str, Column], starts: Callable[[WindowSpec], dict[str, Column]]
) -> DataFrame:
    """Add to each row what the slices before its own have left of its key.

    ``ends`` sums up a slice; ``starts`` reads these sums over the window of earlier slices.
    There is one row per slice and key that meets it, at most slices + heavy keys of them, so
    they may be broadcast.
    """
    summed = sliced.groupBy(key, SLICE).agg(*[end.alias(name) for name, end in ends.items()])
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    told = summed.select(
        F.col(key).alias("_start_key"), F.col(SLICE).alias("_start_of"), *[value.alias(name) for name, value in starts(earlier).items()]
    )
    same = F.col(key).eqNullSafe(F.col("_start_key")) & (F.col(SLICE) == F.col("_start_of"))
    return sliced.join(F.broadcast(told), same, "left").drop("_start_key", "_start_of")
