"""The sample feeds over single files: how their rows are dealt to tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shopstrata.plans import silver
from shopstrata.plans.catalogue import RUN, all_queries
from shopstrata.sources import sample_tables
from shopstrata.sources.sample_tables import SampleTables
from tests.conftest import rows
from tests.test_skew import settings


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One file of parts; two keys repeat and two are absent."""
    to = str(tmp_path_factory.mktemp("feeds"))
    key = F.when(F.col("id") % 100 == 99, None).when(F.col("id") % 100 == 98, F.col("id") - 1).otherwise(F.col("id"))
    spark.range(0, 200, 1, 1).select(
        key.alias("p_partkey"),
        F.concat(F.lit("part "), key.cast("string")).alias("p_name"),
        F.lit("Brand#1").alias("p_brand"),
        F.lit("SMALL").alias("p_type"),
        F.lit(7).alias("p_size"),
        F.lit(1.5).alias("p_retailprice"),
    ).write.parquet(f"{to}/part.parquet")
    # Orders 0 to 59, of which 10 to 19 come twice and two have no key; lines for 0 to 49 and for no order.
    at = "timestamp_ntz '2024-01-05 10:00:00'"
    tables = {
        "orders": f"""SELECT CASE WHEN id >= 70 THEN NULL WHEN id >= 60 THEN id - 50 ELSE id END o_orderkey, id % 7 o_custkey,
            CASE WHEN id % 3 = 0 THEN 'P' ELSE 'O' END o_orderstatus, id * 1.25D o_totalprice, {at} o_orderdate FROM range(72)""",
        "lineitem": f"""SELECT CASE WHEN id >= 200 THEN NULL ELSE id % 50 END l_orderkey, id % 90 l_partkey, id % 4 l_suppkey,
            CAST(1 + id % 9 AS DOUBLE) l_quantity, 2.5D * id l_extendedprice, 0.05D l_discount, {at} l_shipdate FROM range(205)""",
        "customer": "SELECT id c_custkey, CAST(id % 2 AS INT) c_nationkey, 'BUILDING' c_mktsegment, id * 1.5D c_acctbal FROM range(6)",
        "supplier": "SELECT id s_suppkey, 'shop' s_name, CAST(id % 2 AS INT) s_nationkey, 1.5D s_acctbal FROM range(3)",
        "nation": "SELECT CAST(id AS INT) n_nationkey, concat('NATION_', id) n_name FROM range(2)",
        "events": f"SELECT id event_id, {at} ts, id % 5 user_id, 'view' event_type, 1.5D value, '' props FROM range(20)",
    }
    for name, text in tables.items():
        spark.sql(text).coalesce(1).write.parquet(f"{to}/{name}.parquet")
    return to


def tasks_of(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_the_snapshots_of_one_file_are_not_sorted_in_one_task(spark, folder):
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        feed = sample_tables.products(SampleTables(spark, folder))
        assert tasks_of(feed) > 1
        assert feed.count() == 800
        latest = all_queries()["silver_products"](spark, folder)
        assert latest.count() == 197  # a row a key, one of them for the absent ones
        assert latest.select("last_run_id").distinct().first()[0] == "p3"


def test_the_product_dimension_sorts_no_more_than_its_share_in_a_task(spark, folder):
    with settings(spark, spark__sql__adaptive__enabled="false"):
        dim = all_queries()["dim_product"](spark, folder)
        text = dim._jdf.queryExecution().executedPlan().toString()
        limit, explode, scan = text.index("1, Partial"), text.index("Generate explode"), text.index("FileScan")
        # Top down: the limit's sort, the snapshots, the exchange that deals out the parts, and their file.
        assert limit < explode < text.index("Exchange hashpartitioning(p_partkey", explode) < scan
        assert dim.count() == 197


def test_orders_dealt_by_their_text_id_are_the_same_rows(spark, folder):
    tables = SampleTables(spark, folder)
    plain, dealt = sample_tables.orders(tables), sample_tables.orders(tables, dealt_by_id=True)
    assert plain.schema == dealt.schema
    assert plain.count() == 72 and rows(plain) == rows(dealt)
    got = silver.orders(dealt, RUN)
    assert got.count() == 61  # sixty keys, and one row of those without
    assert rows(got.select("order_id", "net_total", "top_seller_id")) == rows(
        silver.orders(plain, RUN).select("order_id", "net_total", "top_seller_id")
    )


def test_the_fact_shuffles_its_wide_order_rows_once_before_the_user_join(spark, folder):
    # Without the broadcasts that tables as small as these would get.
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        fact = all_queries()["fact_orders"](spark, folder)
        text = fact._jdf.queryExecution().executedPlan().toString()
        # By day and id only the order times are dealt out, for the first day of the calendar.
        assert len(re.findall(r"Exchange hashpartitioning\(ingestion_date#\d+, order_id#", text)) == 1
        assert fact.count() == 61
