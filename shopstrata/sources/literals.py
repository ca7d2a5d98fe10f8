"""Small fixed tables as SQL VALUES: known size, no job and no Python worker to build them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_array(values: Iterable) -> Column:
    """Constant array, made in one call instead of one per value."""
    return F.expr("array(" + ", ".join(_literal(v) for v in values) + ")")


def literal_table(spark: SparkSession, columns: str, rows: Iterable[Sequence]) -> DataFrame:
    """``columns`` is a list of names such as ``"code, name"``."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")
