"""Money arithmetic.

Tables hold money as DOUBLE. Sums run over whole cents (BIGINT) instead, because
adding doubles gives other last digits whenever partitions arrive in another
order. Cents stay in generated code, which wide decimals do not; an overflow
raises an error under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOISE_FREE = "decimal(28,8)"


def round_half_up(value: Column, digits: int) -> Column:
    """Round a DOUBLE half up, as its decimal value reads.

    2.005 computed as 2.00499999999999989 still rounds to 2.01: the detour over
    a decimal with many digits takes off the binary noise first.
    """
    return F.round(value.cast(_NOISE_FREE), digits).cast("double")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; NULL on a zero denominator."""
    return round_half_up(F.try_divide(numerator, denominator), digits)


def to_base_currency(amount: Column, rate: Column) -> Column:
    return round_half_up(amount / rate, 2)


def exact(amount: Column) -> Column:
    """The decimal value a DOUBLE stands for, without binary noise."""
    return amount.cast(_NOISE_FREE)


def cents(amount: Column) -> Column:
    """Whole cents of an amount with at most two decimals."""
    return F.rint(amount * 100).cast("bigint")


def from_cents(amount: Column) -> Column:
    return amount / F.lit(100.0)


def exact_sum(amount: Column) -> Column:
    """Order-independent sum of amounts with at most two decimals."""
    return from_cents(F.sum(cents(amount)))


def decimal_sum(amount: Column) -> Column:
    """Order-independent sum of products of amounts and rates: a cent amount times a rate of ten decimals is exact."""
    return F.sum(amount.cast("decimal(28,12)")).cast("double")


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` in percent of ``whole``; NULL when there is no whole."""
    return round_half_up(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)
