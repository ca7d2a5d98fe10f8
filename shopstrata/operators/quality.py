"""Quality gates: rules that stop a load before anything is written.

All rules of a table are measured in one pass over the data. A uniqueness rule
adds one pre-aggregated shuffle of the key; the other rules ride along in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_COUNT = "row_count"


class QualityError(AssertionError):
    """At least one rule was broken; nothing has been written."""


@dataclass(frozen=True)
class Rule:
    """``failed(column)`` is TRUE on a bad row; NULL counts as good."""

    name: str
    column: str
    failed: Callable[[Column], Column]

    def failures(self) -> Column:
        return F.count_if(self.failed(F.col(self.column)))


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", column, lambda value: value.isNull())


def positive(column: str, null_fails: bool = False) -> Rule:
    def failed(value: Column) -> Column:
        return value.isNull() | (value <= 0) if null_fails else value <= 0

    return Rule(f"{column}_positive", column, failed)


def in_range(column: str, low: float, high: float) -> Rule:
    """Closed range; NULL fails."""
    return Rule(
        f"{column}_in_range", column, lambda value: value.isNull() | ~value.between(low, high)
    )


def allowed(column: str, values: Sequence[str]) -> Rule:
    """NULL passes."""
    return Rule(f"{column}_allowed", column, lambda value: ~value.isin(list(values)))


@dataclass(frozen=True)
class Gate:
    """The rule set of one table."""

    rules: Sequence[Rule] = ()
    min_rows: int | None = None
    unique: Sequence[str] = ()
    null_key_is_duplicate: bool = True
    required: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def names(self) -> list[str]:
        names = [rule.name for rule in self.rules]
        if self.min_rows is not None:
            names.append("min_row_count")
        if self.unique:
            names.append("_".join(self.unique) + "_unique")
        names += [f"{column}_required_values" for column in self.required]
        return names


def _seen(column: str, index: int) -> str:
    return f"_seen_{column}_{index}"


def measure(df: DataFrame, gate: Gate) -> DataFrame:
    """One row: ``row_count`` and, per rule, the number of failures."""
    counts = {rule.name: rule.failures() for rule in gate.rules}
    # A required value is missing when no row carries it. The expected list is
    # fixed, so one flag per value does without collecting or joining anything.
    flags = {
        _seen(column, i): F.bool_or(F.col(column) == F.lit(value))
        for column, values in gate.required.items()
        for i, value in enumerate(values)
    }
    rows = F.count(F.lit(1))

    if gate.unique:
        per_key = df.groupBy(*gate.unique).agg(
            rows.alias(ROW_COUNT),
            *[c.alias(n) for n, c in counts.items()],
            *[c.alias(n) for n, c in flags.items()],
        )
        repeated = F.col(ROW_COUNT) > 1
        if not gate.null_key_is_duplicate:
            for key in gate.unique:
                repeated = repeated & F.col(key).isNotNull()
        totals = per_key.agg(
            F.count_if(repeated).alias("_repeated"),
            F.coalesce(F.sum(ROW_COUNT), F.lit(0)).alias(ROW_COUNT),
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
            *[F.bool_or(n).alias(n) for n in flags],
        )
    else:
        totals = df.agg(
            rows.alias(ROW_COUNT),
            *[c.alias(n) for n, c in counts.items()],
            *[c.alias(n) for n, c in flags.items()],
        )

    columns = [F.col(ROW_COUNT).cast("bigint").alias(ROW_COUNT)]
    columns += [F.col(n).cast("bigint").alias(n) for n in counts]
    if gate.min_rows is not None:
        short = F.greatest(F.lit(gate.min_rows) - F.col(ROW_COUNT), F.lit(0))
        columns.append(short.cast("bigint").alias("min_row_count"))
    if gate.unique:
        columns.append(F.col("_repeated").alias("_".join(gate.unique) + "_unique"))
    for column, values in gate.required.items():
        missing = sum(
            (
                F.when(F.coalesce(F.col(_seen(column, i)), F.lit(False)), 0).otherwise(1)
                for i in range(len(values))
            ),
            F.lit(0),
        )
        columns.append(missing.cast("bigint").alias(f"{column}_required_values"))
    return totals.select(*columns)


def as_report(measured: DataFrame, gate: Gate, table: str | None = None) -> DataFrame:
    """(rule, failed_rows), one row per rule."""
    names = gate.names()
    entries = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_rows")) for n in names]
    )
    report = measured.select(F.inline(entries))
    return report.select(F.lit(table).alias("table"), "*") if table else report


def check(df: DataFrame, gate: Gate, table: str | None = None) -> DataFrame:
    return as_report(measure(df, gate), gate, table)


def require(report: DataFrame | Iterable) -> None:
    """Raise if any rule of the report failed."""
    rows = report.where("failed_rows > 0").collect() if isinstance(report, DataFrame) else report
    broken = {row["rule"]: row["failed_rows"] for row in rows if row["failed_rows"] > 0}
    if broken:
        raise QualityError(", ".join(f"{rule}: {n} failed" for rule, n in sorted(broken.items())))


def missing_values(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values that no row carries (expected minus present)."""
    present = df.select(column).where(F.col(column).isNotNull()).distinct()
    return expected.select(column).join(present, column, "left_anti")
