"""Upsert and replay-safe append as joins of DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """An upsert source holds a key twice, so the winning row is undefined."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def reject_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> None:
    known = df.select(*keys).dropna("any")
    sample = duplicate_keys(known, keys).limit(1).collect()
    if sample:
        raise DuplicateKeyError(f"source key occurs more than once: {sample[0].asDict()}")


def append_new(source: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not there yet. A NULL key never matches, so it stays."""
    if existing is None:
        return source
    return source.join(existing.select(*keys), list(keys), "left_anti").select(*source.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: str | None = None,
) -> DataFrame:
    """Target with every source row put in: replaced on a key match, else added.

    Source keys must be unique. The last writer wins, also on the replay of an
    old day; with ``newer_by`` a source row older than its target row is left out.
    A target row without a time is always replaced, a source row without one never
    replaces a target row that has one. NULL keys match nothing.

    Only the key column of the source takes part in the join, so one day's
    changes are usually small enough for the optimizer to broadcast and the big
    target is streamed through without a shuffle. The source is evaluated twice,
    so a costly one is best written first. With ``newer_by`` each side is read
    once and both are shuffled on the key.
    """
    incoming = source.select(*target.columns)
    if newer_by:
        return _newer_rows(target, incoming, keys, newer_by)
    kept = append_new(target, incoming, keys)
    return kept.unionByName(incoming)


def _newer_rows(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], newer_by: str
) -> DataFrame:
    # A side's struct is NULL exactly where its side has no row, whatever its columns hold.
    ours, theirs = F.col("_ours"), F.col("_theirs")
    matched = reduce(lambda a, b: a & b, [ours[k] == theirs[k] for k in keys])
    both = target.select(F.struct("*").alias("_ours")).join(
        incoming.select(F.struct("*").alias("_theirs")), matched, "full_outer"
    )
    replaces = ours[newer_by].isNull() | (theirs[newer_by] >= ours[newer_by])
    row = F.when(ours.isNull() | (theirs.isNotNull() & replaces), theirs).otherwise(ours)
    return both.select(row.alias("_row")).select("_row.*")
