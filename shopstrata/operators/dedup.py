"""One row per key.

Filtering straight on the row number lets Catalyst put a group limit in front
of the shuffle, so every task ships at most one row per key: a key that holds a
third of all rows costs no more network than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Newest row of each key; NULL times lose, ties go to the smallest tie-break."""
    order = [F.col(c).desc_nulls_last() for c in order_by]
    order += [F.col(c).asc_nulls_last() for c in tie_break]
    return _first_row(df, keys, order)


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Row with the smallest ``order_by`` in each group."""
    narrow = df.select(*columns) if columns else df
    return _first_row(narrow, keys, [F.col(c).asc_nulls_last() for c in order_by])
