"""Column helpers: let-binding, words, prefix sums. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six white-space characters that separate words.
BLANKS = " \t\n\x0b\f\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain alias is not enough: the optimizer may substitute the expression
    into a lambda, which then evaluates it again for every element.
    """
    return F.transform(F.array(value), body).getItem(0)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def split_words(text: Column) -> Column:
    """Maximal runs of characters that are not BLANKS; an empty array for empty text."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+")
    )


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Sum of all earlier elements at each place of an int array.

    Works in blocks, so that a long array costs n * block copies and not n * n.
    """

    def running(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        state = F.struct(start.cast("bigint").alias("total"), empty.alias("seen"))
        return F.aggregate(
            values,
            state,
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"),
                F.array_append(acc["seen"], acc["total"]).alias("seen"),
            ),
            lambda acc: acc["seen"],
        )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def blocked(values: Column) -> Column:
        count = F.ceil(F.size(values) / F.lit(block)).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * block + 1, F.lit(block))
        )
        return let(
            blocks,
            lambda bs: let(
                running(F.transform(bs, total), F.lit(0)),
                lambda starts: F.flatten(F.transform(bs, lambda b, i: running(b, F.get(starts, i)))),
            ),
        )

    return let(
        lengths,
        lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>"))
        .when(F.size(v) <= block, running(v, F.lit(0)))
        .otherwise(blocked(v)),
    )


def spans(text: Column, pattern: str, around: int = 40, least: int = 0) -> Column:
    """All matches as ``array<struct<start, end, hit, before, after>>``, in code points, end exclusive.

    The texts between the matches give the places: Java's split and find see the same matches.
    ``before`` and ``after`` are up to ``around`` characters on either side, up to the next match. If
    ``least`` is given, a match has at least so many characters, and the texts on either side go on through
    other matches.
    """
    reach = -(-around // least) if least else 0

    def through(hits: Column, gaps: Column, sides: Callable[[Column, Column], Column]) -> Column:
        if not least:
            return sides(F.array().cast("array<string>"), F.array().cast("array<string>"))
        # Each match with the gap before it, and with the gap after it.
        ends = F.transform(hits, lambda h, i: F.right(F.concat(F.right(F.get(gaps, i), F.lit(around)), h), F.lit(around)))
        heads = F.transform(hits, lambda h, i: F.left(F.concat(h, F.left(F.get(gaps, i + 1), F.lit(around))), F.lit(around)))
        return let(ends, lambda e: let(heads, lambda b: sides(e, b)))

    def before(ends: Column, gaps: Column, i: Column) -> Column:
        gap = F.right(F.get(gaps, i), F.lit(around))
        if not least:
            return gap
        first = F.greatest(i - reach, F.lit(0))
        return F.right(F.concat(F.array_join(F.slice(ends, first + 1, i - first), ""), gap), F.lit(around))

    def after(heads: Column, gaps: Column, i: Column) -> Column:
        gap = F.left(F.get(gaps, i + 1), F.lit(around))
        if not least:
            return gap
        return F.left(F.concat(gap, F.array_join(F.slice(heads, i + 2, F.lit(reach)), "")), F.lit(around))

    def placed(hits: Column, gaps: Column) -> Column:
        lengths = F.transform(hits, lambda h, i: F.char_length(F.get(gaps, i)) + F.char_length(h))
        return through(hits, gaps, lambda ends, heads: let(
            prefix_sums(lengths),
            lambda sums: F.transform(
                hits,
                lambda h, i: F.struct(
                    (F.get(sums, i) + F.char_length(F.get(gaps, i))).alias("start"),
                    (F.get(sums, i) + F.char_length(F.get(gaps, i)) + F.char_length(h)).alias("end"),
                    h.alias("hit"),
                    before(ends, gaps, i).alias("before"),
                    after(heads, gaps, i).alias("after"),
                ),
            ),
        ))

    empty = F.array().cast(
        "array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>"
    )
    found = let(
        F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
            F.split(text, pattern, -1).alias("gaps"),
        ),
        lambda m: let(m["hits"], lambda hits: let(m["gaps"], lambda gaps: placed(hits, gaps))),
    )
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(empty)
