"""Timestamps and calendar parts. Nothing here depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HAS_OFFSET = r"(?:Z|[+\-]\d{2}:?\d{2})$"


def utc_from_text(text: Column) -> Column:
    """ISO-8601 text -> zone-free UTC timestamp; NULL when it is not one.

    Text with an offset names an instant, which a direct cast to TIMESTAMP_NTZ
    would lose (the offset is silently dropped there).
    """
    micros = F.unix_micros(text.try_cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at_instant = F.timestamp_add("MICROSECOND", micros, epoch)
    return F.when(F.rlike(text, F.lit(_HAS_OFFSET)), at_instant).otherwise(
        text.try_cast("timestamp_ntz")
    )


def round_to_millis(ts: Column) -> Column:
    """Round microseconds half up to milliseconds (may cross into the next day)."""
    seconds = F.extract(F.lit("SECOND"), ts)
    return ts + F.make_dt_interval(secs=F.round(seconds, 3) - seconds)


def business_date(ts: Column) -> Column:
    return F.to_date(round_to_millis(ts))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))


def calendar_parts(date: Column) -> dict[str, Column]:
    """Every calendar attribute of a date; weeks and weekdays are ISO."""
    year, month, day = F.year(date), F.month(date), F.dayofmonth(date)
    weekday = F.weekday(date) + F.lit(1)  # Monday = 1
    month_name = F.date_format(date, "MMM")
    return {
        "date_sk": year * 10000 + month * 100 + day,
        "date_str": F.date_format(date, "yyyy-MM-dd"),
        "year": year,
        "quarter": F.quarter(date),
        "month": month,
        "month_name": month_name,
        "week_of_year": F.weekofyear(date),
        "day_of_month": day,
        "day_of_week": weekday,
        "day_name": F.date_format(date, "EEEE"),
        # FALSE, not NULL, for a missing date.
        "is_weekend": F.coalesce(weekday >= 6, F.lit(False)),
        "is_holiday_season": F.coalesce(month >= 11, F.lit(False)),
        "quarter_label": F.concat(
            F.lit("Q"), F.quarter(date).cast("string"), F.lit(" "), year.cast("string")
        ),
        "month_label": F.concat(month_name, F.lit(" "), year.cast("string")),
    }
