"""Intermediate tables in the shared folder the cluster names.

A staged table cuts lineage: what reads it sees the same rows however often a task is
repeated, and the loss of an executor costs no more than the tasks it ran.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="purseline-")


def staging_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master, which has one machine, may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root()


def staging_path(spark: SparkSession, name: str) -> str:
    """A folder nobody used before."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the table once and go on from the written copy."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
