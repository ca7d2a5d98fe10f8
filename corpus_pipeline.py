"""A corpus pipeline over the table ``documents``: each stage applies one operator of ``shopstrata.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstrata.llm import chosenpath, decontaminate, mixing, quality, secrets
from shopstrata.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    return quality.keep(docs, quality.PRODUCTION)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles, the one with the smallest id stays."""
    return chosenpath.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked."""
    return secrets.redact(docs)


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets the rate at which it is to be drawn."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixing_rates),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written and reread for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, "stage-" + name.replace(" ", "-"))
    return docs
