"""Lineage columns."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.schemas import LANDING_BATCH

FEED_ONLY = ["dataset", "source", "ingestion_date", "ingested_at", "run_id", LANDING_BATCH]


@dataclass(frozen=True)
class Run:
    """One batch run. Every value is fixed up front, so a retried task repeats it."""

    run_timestamp: datetime
    as_of: date
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    @classmethod
    def for_schedule(cls, logical_date: datetime, run_id: str | None = None) -> "Run":
        kwargs = {"run_id": run_id} if run_id else {}
        return cls(run_timestamp=logical_date, as_of=logical_date.date(), **kwargs)


def process_day(logical_date: datetime) -> date:
    """A scheduled run works on the day before its logical date."""
    return logical_date.date() - timedelta(days=1)


def clean_lineage(df: DataFrame, run: Run, keep_updated_at: bool) -> DataFrame:
    """Swap feed lineage for clean-table lineage.

    The feed's run id moves to ``last_run_id`` and this run's id takes its
    place; the processed day is the partition a row came from.
    """
    kept = [c for c in df.columns if c not in FEED_ONLY]
    shifted = [
        F.col("run_id").alias("last_run_id"),
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.run_timestamp.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_timestamp"),
        F.col("ingestion_date").alias("silver_processed_date"),
    ]
    if keep_updated_at:
        shifted.insert(0, F.col("ingested_at").alias("last_updated_at"))
    return df.select(*kept, *shifted)


def stamp(df: DataFrame, dataset: str, source: str, run_id: str, at: datetime) -> DataFrame:
    """Ingestion stamp of a batch: one value of each for all of its rows (``at`` is UTC)."""
    moment = F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumns(
        {
            "dataset": F.lit(dataset),
            "source": F.lit(source),
            "run_id": F.lit(run_id),
            "ingested_at": moment,
            "ingestion_date": F.to_date(moment),
        }
    )
