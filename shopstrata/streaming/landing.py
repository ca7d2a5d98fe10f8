"""Routed landing of JSON feeds: one stream of mixed records -> one table per dataset.

Tables are append-only and never collapse rows by key. Each micro-batch owns the
partitions that carry its name and replaces exactly those when it is replayed, so
a restart after a lost driver or executor neither loses nor repeats rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType

from shopstrata.functions.json_text import with_parsed
from shopstrata.functions.times import utc_from_text
from shopstrata.schemas import BRONZE, LANDING_BATCH, columns

REJECTS_SCHEMA = columns(
    f"value STRING, dataset STRING, reason STRING, {LANDING_BATCH} STRING"
)
_BROKEN = "_broken"
UNKNOWN_DATASET = "unknown dataset"
MALFORMED = "malformed"


def with_dataset(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add the routing field of each JSON line."""
    return lines.select(
        F.col(line).alias("value"), F.get_json_object(F.col(line), "$.dataset").alias("dataset")
    )


def _as_read(schema: StructType) -> StructType:
    # Times are read as text first: only text still has its offset.
    fields = [
        StructField(
            f.name,
            StringType() if isinstance(f.dataType, (TimestampNTZType, DateType)) else f.dataType,
        )
        for f in schema.fields
    ]
    return StructType(fields).add(_BROKEN, "string")


def _typed(schema: StructType, record: Column) -> tuple[list[Column], Column]:
    """Typed columns of a parsed record, and whether it could not be read in full."""
    typed, unreadable = [], record[_BROKEN].isNotNull()
    for field in schema.fields:
        value = record[field.name]
        if isinstance(field.dataType, TimestampNTZType):
            converted = utc_from_text(value)
        elif isinstance(field.dataType, DateType):
            converted = value.try_cast("date")
        else:
            typed.append(value.alias(field.name))
            continue
        unreadable = unreadable | (value.isNotNull() & converted.isNull())
        typed.append(converted.alias(field.name))
    return typed, unreadable


def _unreadable(schema: StructType) -> Callable[[Column], Column]:
    return lambda record: _typed(schema, record)[1]


def _parse(schema: StructType) -> Column:
    return F.from_json("value", _as_read(schema), {"columnNameOfCorruptRecord": _BROKEN})


def decode(routed: DataFrame, schema: StructType) -> DataFrame:
    """Typed columns of one dataset's lines, next to ``value`` and a ``malformed`` flag."""
    typed, unreadable = _typed(schema, F.col("_record"))
    parsed = with_parsed(routed.select("value"), "_record", _parse(schema))
    return parsed.select("value", *typed, unreadable.alias("malformed"))


def accepted(routed: DataFrame, dataset: str, schema: StructType) -> DataFrame:
    mine = decode(routed.where(F.col("dataset") == dataset), schema)
    return mine.where(~F.col("malformed")).drop("malformed", "value")


def rejected(routed: DataFrame, registry: Mapping[str, StructType]) -> DataFrame:
    """Lines that go to no table, with the reason."""
    known = F.col("dataset").isin(list(registry))
    unknown = routed.where(F.col("dataset").isNotNull() & ~known).withColumn(
        "reason", F.lit(UNKNOWN_DATASET)
    )
    no_dataset = routed.where(F.col("dataset").isNull()).withColumn("reason", F.lit(MALFORMED))
    out = unknown.unionByName(no_dataset)
    for dataset, schema in registry.items():
        broken = decode(routed.where(F.col("dataset") == dataset), schema).where("malformed")
        out = out.unionByName(
            broken.select("value", F.lit(dataset).alias("dataset"), F.lit(MALFORMED).alias("reason"))
        )
    return out


def route_outcomes(routed: DataFrame, registry: Mapping[str, StructType]) -> DataFrame:
    """(dataset, outcome, rows): what would be landed and what refused. One scan."""
    outcome = F.when(F.col("dataset").isNull(), F.lit(MALFORMED))
    for dataset, schema in registry.items():
        # Bound to a lambda, the parsed record is made once and looked at often.
        broken = F.exists(F.array(_parse(schema)), _unreadable(schema))
        outcome = outcome.when(
            F.col("dataset") == dataset, F.when(broken, MALFORMED).otherwise("landed")
        )
    outcome = outcome.otherwise(F.lit(UNKNOWN_DATASET))
    return (
        routed.select("dataset", outcome.alias("outcome"))
        .groupBy("dataset", "outcome")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def land_batch(
    batch: DataFrame, batch_name: str, tables: Mapping[str, str], rejects_table: str,
    registry: Mapping[str, StructType] = BRONZE,
) -> None:
    """Write one batch of lines; running it again with the same name changes nothing."""
    routed = with_dataset(batch).persist()
    try:
        for dataset, table in tables.items():
            _replace_batch(accepted(routed, dataset, registry[dataset]), batch_name, table)
        refused = rejected(routed, {d: registry[d] for d in tables})
        _replace_batch(refused, batch_name, rejects_table)
    finally:
        routed.unpersist()


def _replace_batch(rows: DataFrame, batch_name: str, table: str) -> None:
    """Write the rows as the only content of this batch's partitions."""
    spark = rows.sparkSession
    columns = [c for c in spark.read.table(table).columns if c != LANDING_BATCH]
    within = ", ingestion_date" if "ingestion_date" in columns else ""
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({LANDING_BATCH} = '{batch_name}'{within})"
        " SELECT * FROM {rows}",
        rows=rows.select(*columns).hint("rebalance"),
    )


def create_rejects_table(spark: SparkSession, table: str) -> None:
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REJECTS_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet PARTITIONED BY ({LANDING_BATCH})"
    )


def stream_name(checkpoint: str) -> str:
    """Names a stream by its checkpoint, so two streams never share batch names."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def route(
    lines: DataFrame,
    tables: Mapping[str, str],
    rejects_table: str,
    checkpoint: str,
    registry: Mapping[str, StructType] = BRONZE,
    available_now: bool = False,
    every: str = "15 minutes",
) -> StreamingQuery:
    """Start landing a stream of JSON lines (``value``) into ``tables`` (dataset -> table)."""
    name = stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, f"{name}-{batch_id}", tables, rejects_table, registry)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def read_lines(spark: SparkSession, folder: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Stream of the lines of all text files that arrive in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(folder)
