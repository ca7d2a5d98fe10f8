from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.functions.bands import band, blank_to_null
from shopstrata.functions.money import exact_sum, ratio, round_half_up, share_pct, to_base_currency
from shopstrata.functions.people import (
    email_parts,
    name_parts,
    phone_parts,
    plain_name,
    without_extension,
)
from shopstrata.functions.times import (
    business_date,
    calendar_parts,
    days_between,
    round_to_millis,
    utc_from_text,
)


def column(spark, values, type_name):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")


def mapped(df, *columns):
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


NAMES = [
    ("Dr. Ann Lee Ray PhD", "Ann", "Lee Ray"),
    ("Mrs. Cher", "Cher", None),
    ("Bob Stone DDS", "Bob", "Stone DDS"),
    (" Miss Kim  Wu Jr.", "Miss", "Kim  Wu"),
    ("Sir Ian Roe III", "Ian", "Roe"),
    ("Mr. Dr. X Y", "Dr.", "X Y"),
    ("", "", None),
    (None, None, None),
]


def test_names(spark):
    df = column(spark, [n for n, _, _ in NAMES], "string").withColumn("c", plain_name(F.col("v")))
    parts = name_parts(F.col("c"))
    assert mapped(df, parts["first_name"], parts["last_name"]) == [n[1:] for n in NAMES]


PHONES = [
    ("+1-555-123-4567x634", "+1", True, "5551234567"),
    ("001-555-1234", "+1", True, "5551234"),
    ("(555)123.4567", None, False, "5551234567"),
    ("+4412345", None, False, "4412345"),
    ("5551234ext12", None, False, "555123412"),
    ("+1-001-555", "+1", True, "555"),
    (None, None, None, None),
]


def test_phones(spark):
    df = column(spark, [p[0] for p in PHONES], "string")
    parts = phone_parts(F.col("v"))
    got = mapped(df, parts["phone_country_code"], parts["has_country_code"], parts["phone_number_clean"])
    assert got == [p[1:] for p in PHONES]


def test_phone_extensions(spark):
    given = ["+1-555-123-4567x634", "5551234ext12", "555 ext. 9", "555 X77", "5 ext 4x5", None]
    df = column(spark, given, "string")
    assert mapped(df, without_extension(F.col("v"))) == [
        ("+1-555-123-4567",), ("5551234",), ("555",), ("555",), ("5",), (None,),
    ]


EMAILS = [
    ("a.b@X.com", True, "x.com"),
    ("nobody", False, None),
    ("a@b_c.com", False, "b_c.com"),
    ("a@@b.com", False, ""),
    ("a@b.c", False, "b.c"),
    ("@x.com", False, "x.com"),
    (None, None, None),
]


def test_emails(spark):
    df = column(spark, [e[0] for e in EMAILS], "string")
    parts = email_parts(F.col("v"))
    assert mapped(df, parts["is_valid_email"], parts["email_domain"]) == [e[1:] for e in EMAILS]


@pytest.mark.parametrize(
    "bands, op, cases",
    [
        (fixed.ORDER_VALUE_BAND, "<", {99.99: "low", 100.0: "medium", 499.99: "medium", 500.0: "high",
                                       1999.99: "high", 2000.0: "premium", None: "premium",
                                       float("nan"): "premium"}),
        (fixed.PRICE_BAND, "<", {19.99: "budget", 20.0: "mid-range", 100.0: "premium", 500.0: "luxury", None: "luxury"}),
        (fixed.SELLER_TIER, ">=", {4.5: "platinum", 4.49: "gold", 4.0: "gold", 3.5: "silver", 3.49: "bronze", None: "bronze"}),
        (fixed.FULFILLMENT_BAND, ">=", {95.0: "excellent", 94.9: "good", 85.0: "good", 70.0: "average", 69.9: "poor", None: "poor"}),
        (fixed.ACCOUNT_AGE_SEGMENT, "<", {89.0: "new", 90.0: "growing", 365.0: "established", 730.0: "loyal", None: "loyal"}),
        (fixed.SPEND_SEGMENT, "<", {-5.0: "low", 100.0: "medium", 500.0: "high", 2000.0: "vip", None: "vip"}),
    ],
)
def test_bands(spark, bands, op, cases):
    df = column(spark, list(cases), "double")
    assert mapped(df, band(F.col("v"), *bands, op)) == [(label,) for label in cases.values()]


def test_band_needs_a_label_per_edge():
    with pytest.raises(ValueError):
        band(None, [1, 2], ["a"], "b")


def test_blank_to_null(spark):
    df = column(spark, ["  ", "", " x ", None], "string")
    assert mapped(df, blank_to_null(F.col("v"))) == [(None,), (None,), ("x",), (None,)]


def test_calendar(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 1, 6), dt.date(2026, 11, 1)]
    parts = calendar_parts(F.col("v"))
    wanted = ["date_sk", "quarter", "month_name", "week_of_year", "day_of_week", "day_name",
              "is_weekend", "is_holiday_season", "quarter_label", "month_label"]
    assert mapped(column(spark, days, "date"), *[parts[n] for n in wanted]) == [
        (20241230, 4, "Dec", 1, 1, "Monday", False, True, "Q4 2024", "Dec 2024"),
        (20240106, 1, "Jan", 1, 6, "Saturday", True, False, "Q1 2024", "Jan 2024"),
        (20261101, 4, "Nov", 44, 7, "Sunday", True, True, "Q4 2026", "Nov 2026"),
    ]


def test_calendar_flags_of_no_date_are_false(spark):
    parts = calendar_parts(F.col("v"))
    df = column(spark, [None], "date")
    assert mapped(df, parts["is_weekend"], parts["is_holiday_season"]) == [(False, False)]


def test_millis_rounding_may_cross_midnight(spark):
    stamps = [dt.datetime(2024, 1, 1, 23, 59, 59, 999600), dt.datetime(2024, 1, 1, 12, 0, 0, 400),
              dt.datetime(2024, 1, 1, 12, 0, 0, 500), None]
    df = column(spark, stamps, "timestamp_ntz")
    assert mapped(df, round_to_millis(F.col("v")), business_date(F.col("v"))) == [
        (dt.datetime(2024, 1, 2), dt.date(2024, 1, 2)),
        (dt.datetime(2024, 1, 1, 12), dt.date(2024, 1, 1)),
        (dt.datetime(2024, 1, 1, 12, 0, 0, 1000), dt.date(2024, 1, 1)),
        (None, None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_utc_from_text_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-10T10:00:00+05:30", "2024-03-10T10:00:00.25Z", "2024-03-10T02:30:00", "soon", None]
        df = column(spark, texts, "string")
        assert mapped(df, utc_from_text(F.col("v"))) == [
            (dt.datetime(2024, 3, 10, 4, 30),),
            (dt.datetime(2024, 3, 10, 10, 0, 0, 250000),),
            (dt.datetime(2024, 3, 10, 2, 30),),
            (None,),
            (None,),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days_between(spark):
    df = column(spark, [dt.datetime(2024, 1, 1, 23), None], "timestamp_ntz")
    assert mapped(df, days_between(F.lit(dt.date(2024, 1, 3)), F.col("v"))) == [(2,), (None,)]


def test_money(spark):
    df = column(spark, [1.005, 0.285, 2.675, -1.005, None], "double")
    assert mapped(df, round_half_up(F.col("v"), 2)) == [(1.01,), (0.29,), (2.68,), (-1.01,), (None,)]
    assert mapped(df, ratio(F.col("v"), F.lit(0.0), 4)) == [(None,)] * 5
    assert mapped(df, to_base_currency(F.lit(10.0), F.lit(3.0)))[0] == (3.33,)
    assert df.select(exact_sum(F.round(F.col("v"), 2))).first()[0] == pytest.approx(2.97)
    assert mapped(df, share_pct(F.lit(1), F.lit(8)), share_pct(F.lit(1), F.lit(0)))[0] == (12.5, None)


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9] * 50
    one = column(spark, values, "double").coalesce(1).select(exact_sum(F.col("v"))).first()[0]
    many = column(spark, values[::-1], "double").repartition(7).select(exact_sum(F.col("v"))).first()[0]
    assert one == many == 30.5
