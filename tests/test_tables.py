from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shopstrata.operators.merge import DuplicateKeyError
from shopstrata.schemas import BRONZE, SILVER
from shopstrata.sources import tables as catalog
from tests.conftest import rows


@pytest.fixture
def database(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_create_tables(spark, tmp_path):
    name = "c_" + uuid.uuid4().hex[:8]
    created = catalog.create_tables(spark, name + "b", name + "s", root=str(tmp_path))
    assert len(created) == 12
    assert catalog.create_tables(spark, name + "b", name + "s", root=str(tmp_path)) == created
    users = spark.table(f"{name}s.silver_users")
    assert dict(users.dtypes) == {f.name: f.dataType.simpleString() for f in SILVER["silver_users"]}
    assert "email" not in users.columns and "phone" not in users.columns
    assert "email" in SILVER["silver_sellers"].names
    partitions = [c.name for c in spark.catalog.listColumns(f"{name}b.bronze_orders") if c.isPartition]
    assert partitions == ["landing_batch", "ingestion_date"]


def test_scan_reads_one_folder(spark, database):
    table = f"{database}.events"
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING, day DATE) USING parquet PARTITIONED BY (day)")
    df = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2))], "k int, v string, day date"
    )
    catalog.append_table(df, table)
    scanned = catalog.scan_partition(spark, table, dt.date(2024, 1, 2), "day", ["k"])
    assert rows(scanned) == [(2,)]
    text = plan(scanned)
    assert "PartitionFilters: [isnotnull(day" in text and "ReadSchema: struct<k:int>" in text
    assert catalog.scan_partition(spark, table, dt.date(2030, 1, 1), "day").isEmpty()
    assert catalog.scan_existing(spark, f"{database}.absent", dt.date(2024, 1, 1), ["k"], "day") is None


def test_append_is_by_name(spark, database):
    table = f"{database}.named"
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING) USING parquet")
    catalog.append_table(spark.createDataFrame([("x", 1, "more")], "v string, k int, extra string"), table)
    assert rows(spark.table(table)) == [(1, "x")]
    with pytest.raises(Exception, match="v"):
        catalog.append_table(spark.createDataFrame([(1,)], "k int"), table)


def test_upsert_table_swaps_snapshots(spark, database):
    table = f"{database}.keyed"
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING) USING parquet")

    def put(*values, **kwargs):
        catalog.upsert_table(spark, table, spark.createDataFrame(list(values), "k int, v string"), ["k"], **kwargs)

    put((1, "a"), (2, "a"))
    before = spark.table(table)
    seen = rows(before)
    put((2, "b"), (3, "b"))
    assert seen == [(1, "a"), (2, "a")]
    assert rows(before) == seen  # a reader of the old snapshot is not disturbed
    assert rows(spark.table(table)) == [(1, "a"), (2, "b"), (3, "b")]
    put((2, "b"), (3, "b"))
    assert rows(spark.table(table)) == [(1, "a"), (2, "b"), (3, "b")]
    with pytest.raises(DuplicateKeyError):
        put((9, "x"), (9, "y"))
    assert rows(spark.table(table)) == [(1, "a"), (2, "b"), (3, "b")]


def test_merge_statement_is_understood(spark, database):
    """No row-level provider is installed: the statement gets as far as being refused for Parquet."""
    table = f"{database}.flat"
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING) USING parquet")
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    for newer_by in (None, "v"):
        with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
            catalog._merge_into(table, source, ["k"], newer_by)


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, database):
    table = f"{database}.safe"
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING) USING parquet")
    catalog.append_table(spark.createDataFrame([(1, "a")], "k int, v string"), table)
    broken = spark.range(1).select(
        F.lit(2).alias("k"), F.raise_error(F.lit("boom")).cast("string").alias("v")
    )
    with pytest.raises(Exception, match="boom"):
        catalog.upsert_table(spark, table, broken, ["k"], source_is_unique=True)
    assert rows(spark.table(table)) == [(1, "a")]


def test_overwrite_clusters_on_the_given_columns(spark, database):
    table = f"{database}.derived"
    catalog.overwrite_table(spark.range(100).withColumnRenamed("id", "n"), table, ["n"])
    catalog.overwrite_table(spark.range(50).withColumnRenamed("id", "n"), table, ["n"])
    assert spark.table(table).count() == 50


def test_properties_on_many_tables(spark, database):
    for name in ("p1", "p2"):
        spark.sql(f"CREATE TABLE {database}.{name} (k INT) USING parquet")
    names = catalog.set_properties(spark, f"{database}.p1, {database}.p2", {"owner.team": "retail"})
    assert len(names) == 2
    for name in names:
        value = spark.sql(f"SHOW TBLPROPERTIES {name} ('owner.team')").first()["value"]
        assert value == "retail"


def test_temp_view_makes_a_frame_usable_in_sql(spark):
    spark.range(3).createOrReplaceTempView("updates")
    assert spark.sql("SELECT sum(id) FROM updates").first()[0] == 3


def test_feed_schemas_end_with_lineage():
    for schema in BRONZE.values():
        assert schema.names[-5:] == ["dataset", "source", "run_id", "ingested_at", "ingestion_date"]
