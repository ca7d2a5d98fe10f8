"""Reading JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parsed(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Add a parsed document as a column, parsed once per row.

    A filter on a plain parsed column is pushed below its projection together
    with a copy of the parser call, which then runs twice. Producing the column
    from a one-element generator keeps filters above it.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))
