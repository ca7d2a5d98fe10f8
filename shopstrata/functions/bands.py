"""Banding: a number -> the label of the range it falls in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    otherwise: str,
    op: str = "<",
) -> Column:
    """Label of the first edge that ``value op edge`` holds for, else ``otherwise``.

    ``op="<"`` reads edges upwards, ``op=">="`` downwards. A NULL value meets no
    edge, so it gets ``otherwise``.
    """
    if len(edges) != len(labels):
        raise ValueError("one label per edge is needed")
    tests = {"<": Column.__lt__, ">=": Column.__ge__}
    meets = tests[op]
    steps = list(zip(edges, labels))
    # Built from the last edge inwards: each step wraps the ones after it.
    return reduce(
        lambda rest, step: F.when(meets(value, F.lit(step[0])), step[1]).otherwise(rest),
        reversed(steps),
        F.lit(otherwise),
    )


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))
