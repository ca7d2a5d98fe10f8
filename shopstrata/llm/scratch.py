"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where no folder is configured (local runs, tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once and read back: cuts the lineage, survives lost executors, and gives
    the optimizer real sizes. The folder stays, because the returned frame reads it lazily."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
