"""A key that holds a third of all rows."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from shopstrata.operators import merge
from shopstrata.operators.dedup import latest_per_key
from shopstrata.operators.joins import left_lookup


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Thresholds scaled down to test data; no broadcast, so that both sides shuffle.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
    "spark__sql__shuffle__partitions": "8",
}

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has key 7, another tenth has none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 5000)
    )
    return spark.range(0, ROWS, 1, 8).select(
        key.cast("bigint").alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v")
    )


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["lookup", "append"])
def test_joins_split_the_hot_key(spark, hot, how):
    side = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with settings(spark, **SMALL):
        if how == "lookup":
            df = left_lookup(hot, side, "k")
            wanted = ROWS
        else:
            df = merge.append_new(hot, side.where("k <> 7"), ["k"])
            wanted = hot.where("k = 7 or k is null").count()
        assert "skew=true" in executed(df)
        assert df.count() == wanted


def test_dedup_ships_one_row_of_the_hot_key_per_task(spark, hot):
    df = latest_per_key(hot, ["k"], ["id"])
    got = df.where("k = 7").first()
    assert got["id"] == max(i for i in range(ROWS) if i % 3 == 0 or (i % 5000 == 7 and i % 10 != 1))
    assert df.count() == hot.select("k").distinct().count()
