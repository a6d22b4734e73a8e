"""Small tables made on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_table(spark: SparkSession, columns: dict[str, Sequence], types: dict[str, T.DataType]) -> DataFrame:
    """A table of the given lists; part of the plan itself, so reading it runs no job."""
    schema = T.StructType([T.StructField(name, types[name]) for name in columns])
    return spark.createDataFrame(pa.table({name: list(values) for name, values in columns.items()}), schema)
