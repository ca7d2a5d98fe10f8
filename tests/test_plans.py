"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest


from shopstrata.plans import gold, silver
from shopstrata.plans.catalogue import RUN, all_queries
from shopstrata.sources import sample_tables
from shopstrata.sources.sample_tables import SampleTables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name) -> str:
    return plan(all_queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = query_plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "MapInPandas", "ExistingRDD"):
        assert node not in text


@pytest.mark.parametrize("name", ["dedup_latest", "first_per_category", "silver_orders", "silver_users", "silver_fx_rates"])
def test_first_row_per_key_is_limited_before_the_shuffle(spark, name):
    text = query_plan(spark, name)
    # The plan is printed top down: the partial limit is below the exchange.
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("row_number(), 1, Partial")


def test_scans_read_only_what_is_needed(spark):
    text = query_plan(spark, "scan_partition")
    assert "PushedFilters" in text and text.count("FileScan") == 1 and "Exchange" not in text
    text = query_plan(spark, "append_new")
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linestatus:string>" in text


def test_unused_order_columns_do_not_cost_anything(spark):
    text = query_plan(spark, "report_status_breakdown")
    assert "to_json" not in text and "collect_list" not in text


def test_no_order_up_to_the_last_day_is_without_a_date(spark):
    fact = all_queries()["fact_orders"](spark, FOLDER)
    assert fact.where("date_sk = -1 AND ordered_at <= TIMESTAMP_NTZ '2024-01-31 23:59:59'").isEmpty()


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        for build in all_queries().values():
            build(spark, FOLDER)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_phone_extensions_are_stripped_first(spark):
    users = all_queries()["silver_users"](spark, FOLDER)
    assert users.where("user_id = 2").first()["phone_number_clean"] == "5550000002"


def test_quality_gate_is_one_pass(spark):
    feed = sample_tables.weather(SampleTables(spark, FOLDER))
    from shopstrata.operators.quality import measure

    text = plan(measure(feed, silver.WEATHER.gate))
    assert text.count("FileScan") == 1 and text.count("Exchange SinglePartition") == 1


def test_big_dimensions_are_never_forced_into_a_broadcast(spark):
    tables = SampleTables(spark, FOLDER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dims = gold.Dimensions(
            users=gold.user_dim(silver.users(sample_tables.users(tables), RUN)),
            dates=gold.date_dim(sample_tables.order_times(tables), RUN.as_of),
            currencies=gold.currency_dim(silver.fx_rates(sample_tables.fx_rates(tables), RUN)),
            sellers=gold.seller_dim(silver.sellers(sample_tables.sellers(tables), RUN)),
            products=gold.product_dim(silver.products(sample_tables.products(tables), RUN)),
        )
        fact = gold.fact_orders(silver.orders(sample_tables.orders(tables), RUN), dims)
        text = plan(fact.select("user_sk", "top_seller_sk", "currency_sk", "date_sk", "product_sk"))
        joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
        assert any("user_id" in j for j in joins) and any("top_seller_id" in j for j in joins)
        lookups = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
        assert any("currency" in j for j in lookups)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
