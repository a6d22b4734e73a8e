from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from purseline.operators.labels import fit_label_index


def indexed(df, fitted, **kwargs):
    return {r.c: r.category_index for r in fitted.apply(df, "c", **kwargs).collect()}


def test_order_is_frequency_then_label_and_null_comes_last(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("b",), ("",)], "c string")
    assert indexed(df, fit_label_index(df, "c")) == {"b": 0.0, "": 1.0, "a": 2.0, None: 3.0}


def test_unseen_label_gets_number_of_labels(spark):
    fitted = fit_label_index(spark.createDataFrame([("a",), ("b",)], "c string"), "c")
    assert indexed(spark.createDataFrame([("z",), ("b",)], "c string"), fitted) == {"z": 2.0, "b": 1.0}


def test_no_labels(spark):
    df = spark.createDataFrame([], "c string")
    fitted = fit_label_index(df, "c")
    assert fitted.size == 0 and fitted.apply(df, "c").count() == 0


def test_same_as_string_indexer(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderpriority").alias("c"))
    model = StringIndexer(inputCol="c", outputCol="expected", handleInvalid="keep").fit(rows)
    both = fit_label_index(rows, "c").apply(model.transform(rows), "c")
    assert both.where("expected <> category_index").count() == 0
    assert both.count() == rows.count()


@pytest.mark.parametrize("type_name", ["int", "double", "string"])
def test_numbers_tie_like_string_indexer(spark, type_name):
    rows = spark.createDataFrame([(x,) for x in (10, 9, 9, 2, 10, 100, None)], "c int")
    rows = rows.withColumn("c", F.col("c").cast(type_name))
    model = StringIndexer(inputCol="c", outputCol="expected", handleInvalid="keep").fit(rows)
    both = fit_label_index(rows, "c").apply(model.transform(rows), "c")
    assert both.where("expected <> category_index").count() == 0 and both.count() == 7


def test_more_labels_than_are_kept_on_the_driver(spark):
    """The parallel numbering, in slices."""
    n = F.col("id")
    labels = F.when(n < 600, F.lit("hot")).when(n % 7 == 0, F.lit(None)).otherwise((n % 211).cast("string"))
    df = spark.range(2000).select(labels.alias("c"))
    fitted = fit_label_index(df, "c", local_labels=20, slices=5)
    counts = Counter(r.c for r in df.collect() if r.c is not None)
    expected = {label: float(i) for i, (label, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    expected[None] = float(len(counts))
    assert fitted.size == len(counts) and fitted.rare is not None
    assert indexed(df, fitted) == expected
    assert fitted.apply(df, "c").count() == df.count()
