"""Joins against lookup tables.

A broadcast is only asked for when the size of the lookup side is fixed by
construction. Every other join is left to the optimizer, which goes by runtime
sizes, or shuffles both sides and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def left_lookup(
    facts: DataFrame, lookup: DataFrame, condition: Column | str | Sequence[str]
) -> DataFrame:
    """Keep every fact row, add the lookup's columns where it matches."""
    on = [condition] if isinstance(condition, str) else condition
    return facts.join(lookup, on, "left")


def decode(
    df: DataFrame, codes: DataFrame, on: str, label: str, default: str
) -> DataFrame:
    """Replace a code by its label from a fixed code table, ``default`` on a miss."""
    matched = df.join(F.broadcast(codes), on, "left")
    return matched.withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def allowed_only(df: DataFrame, allowed: DataFrame, on: str) -> DataFrame:
    """Rows whose value occurs in a fixed allow-list."""
    return df.join(F.broadcast(allowed), on, "left_semi")
