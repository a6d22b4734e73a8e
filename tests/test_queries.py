"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as driver
import pytest
from compare import mismatches

ORACLE = driver.oracle_sql()


def test_every_query_of_the_library_has_sql():
    assert set(driver.REGISTRY) <= set(ORACLE)


@pytest.mark.parametrize("name", list(driver.REGISTRY))
def test_query_matches_sql(spark, sf_dir, name):
    result = driver.queries()[name](spark, sf_dir)
    assert mismatches(result, ORACLE[name], sf_dir) == []


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_flagship_does_not_depend_on_shuffle_width(spark, sf_dir, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        result = driver.queries()["user_features"](spark, sf_dir)
        assert mismatches(result, ORACLE["user_features"], sf_dir) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
