"""Catalog tables: create, scan a day, append, upsert, overwrite, set properties."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopstrata.operators import merge
from shopstrata.schemas import BRONZE, LANDING_BATCH, PARTITION_COLUMNS, SILVER

# Providers that accept MERGE themselves.
ROW_LEVEL_PROVIDERS = {"iceberg", "delta"}


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    provider: str = "parquet",
    location: str | None = None,
) -> None:
    clauses = [f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(schema)}) USING {provider}"]
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if location:
        clauses.append(f"LOCATION '{location}'")
    spark.sql(" ".join(clauses))


def create_tables(
    spark: SparkSession,
    bronze_db: str,
    silver_db: str,
    provider: str = "parquet",
    root: str | None = None,
) -> list[str]:
    """Create the six feed tables and the six clean tables.

    With ``root`` every table gets its own folder there, and a keyed table
    keeps its snapshots next to each other in it.
    """
    created = []
    for database, tables in ((bronze_db, BRONZE), (silver_db, SILVER)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, schema in tables.items():
            partitions = PARTITION_COLUMNS[name]
            if LANDING_BATCH in partitions:
                schema = StructType(list(schema.fields)).add(LANDING_BATCH, "string")
            table = f"{database}.{name}"
            location = f"{root.rstrip('/')}/{database}/{name}/base" if root else None
            create_table(spark, table, schema, partitions, provider, location)
            created.append(table)
    return created


def set_properties(
    spark: SparkSession, tables: str | Sequence[str], properties: Mapping[str, str]
) -> list[str]:
    """Set the same table properties on several tables (list, or comma-separated text)."""
    names = tables.split(",") if isinstance(tables, str) else tables
    names = [n.strip() for n in names if n.strip()]
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    for name in names:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    return names


def scan_partition(
    spark: SparkSession,
    table: str,
    day: date,
    column: str = "ingestion_date",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One day of a table. The comparison is on the DATE partition, so it prunes folders."""
    return rows_of_day(spark.read.table(table), day, column, columns)


def rows_of_day(
    df: DataFrame, day: date, column: str = "ingestion_date", columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows of one day, all columns or the named ones."""
    found = df.where(F.col(column) == F.lit(day).cast("date"))
    return found.select(*columns) if columns else found


def scan_existing(
    spark: SparkSession, table: str, day: date, columns: Sequence[str], column: str
) -> DataFrame | None:
    """Keys a table already holds for a day, or None when there is no such table yet."""
    if not spark.catalog.tableExists(table):
        return None
    return scan_partition(spark, table, day, column, columns)


def to_table_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, in table order and type. A missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _sized_for_writing(df: DataFrame) -> DataFrame:
    # Lets the adaptive planner merge small output files and split large ones.
    return df.hint("rebalance")


def append_table(df: DataFrame, table: str) -> int:
    """Appends the rows and says how many there were, counted by the write itself."""
    spark = df.sparkSession
    aligned = to_table_schema(df, spark.read.table(table).schema)
    seen = Observation()
    counted = _sized_for_writing(aligned).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").insertInto(table)
    return seen.get["rows"]


def overwrite_table(
    df: DataFrame,
    table: str,
    order_by: Sequence[str] = (),
    provider: str = "parquet",
) -> None:
    """Full refresh of a derived table. ``order_by`` clusters the files on those columns."""
    if order_by:
        df = df.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(*order_by)
    else:
        df = _sized_for_writing(df)
    df.write.mode("overwrite").format(provider).saveAsTable(table)


def _detail(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: str | None = None,
    source_is_unique: bool = False,
) -> None:
    """Upsert ``source`` into a keyed table.

    A provider with row-level operations gets a MERGE. On plain files the merged
    table is written to a new folder first and the table is then pointed at it:
    one catalog update, so readers see the old table or the new one, and a job
    that dies half-way leaves the old one in place. The folders of earlier
    snapshots stay for readers that still use them.
    """
    if not source_is_unique:
        merge.reject_duplicate_keys(source, keys)
    detail = _detail(spark, table)
    if detail.get("Provider", "").lower() in ROW_LEVEL_PROVIDERS:
        _merge_into(table, source, keys, newer_by)
        return
    target = spark.read.table(table)
    merged = merge.upsert(target, to_table_schema(source, target.schema), keys, newer_by)
    snapshot = f"{detail['Location'].rsplit('/', 1)[0]}/snapshot-{uuid.uuid4().hex}"
    _sized_for_writing(merged).write.parquet(snapshot)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{snapshot}'")
    spark.catalog.refreshTable(table)


def _merge_into(
    table: str, source: DataFrame, keys: Sequence[str], newer_by: str | None
) -> None:
    same_key = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    newest = (
        f" AND (target.`{newer_by}` IS NULL OR source.`{newer_by}` >= target.`{newer_by}`)"
        if newer_by
        else ""
    )
    source.sparkSession.sql(
        f"MERGE INTO {table} AS target USING {{rows}} AS source ON {same_key}"
        f" WHEN MATCHED{newest} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
        rows=source,
    )
