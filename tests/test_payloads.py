from __future__ import annotations

import json

from shopstrata import fixed_values as fixed
from shopstrata.sources import payloads
from tests.conftest import rows


def test_rates_document(spark):
    good = {
        "result": "success",
        "conversion_rates": {"USD": 1, "EUR": 0.9, "INR": None, "XAU": 0.0004, "JPY": 151},
        "time_last_update_utc": "Thu, 17 Apr 2025 00:00:01 +0000",
        "time_next_update_utc": "Fri, 18 Apr 2025 00:00:01 +0000",
        "time_last_update_unix": 1744848001,
    }
    failed = {**good, "result": "error"}
    df = spark.createDataFrame(
        [("a", json.dumps(good)), ("b", json.dumps(failed)), ("c", "{not json"), ("d", None)],
        "id string, payload string",
    )
    got = payloads.flatten_rates(df, payloads.target_currencies(spark))
    assert rows(got.select("id", "base_currency", "target_currency", "exchange_rate", "pair", "rate_unix")) == [
        ("a", "USD", "EUR", 0.9, "USD/EUR", 1744848001),
        ("a", "USD", "JPY", 151.0, "USD/JPY", 1744848001),
    ]
    assert got.first()["rate_date_utc"].startswith("Thu, 17")


def flat(spark, *documents):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "id int, payload string")
    return payloads.flatten_weather(df, payloads.cities(spark), payloads.weather_codes(spark))


def test_weather_defaults_nulls_and_positions(spark):
    document = json.dumps([
        {"current": {"time": "t0", "temperature_2m": 20, "weather_code": 61, "is_day": 0}, "timezone": "Asia/Tokyo"},
        {"current": {"time": "t1", "weather_code": None, "is_day": None}, "timezone": None},
        {"current": {"time": "t2", "weather_code": 7}},
        {},
    ])
    got = flat(spark, document).select(
        "city", "observation_time", "temperature_c", "weather_code", "weather_description", "is_day", "timezone"
    )
    assert {r["city"]: tuple(r)[1:] for r in got.collect()} == {
        "Mumbai": ("t0", 20.0, 61, "Slight rain", False, "Asia/Tokyo"),
        "Delhi": ("t1", None, None, "Unknown", False, None),
        "New York": ("t2", None, 7, "Unknown", True, "UTC"),
        "London": (None, None, -1, "Unknown", True, "UTC"),
    }


def test_weather_lone_object_surplus_objects_and_junk(spark):
    lone = json.dumps({"current": {"time": "x", "weather_code": 0}})
    many = json.dumps([{"current": {"time": str(i)}} for i in range(13)])
    got = rows(flat(spark, lone, many, "[{", None).groupBy("id").count())
    assert got == [(0, 1), (1, len(fixed.CITIES))]


def test_code_table_is_complete(spark):
    assert payloads.weather_codes(spark).count() == 21
    assert payloads.cities(spark).where("city = 'Frankfurt' and position = 9").count() == 1


def test_unreadable_and_failed_payloads_are_refused(spark):
    rates = ['{"result":"success","conversion_rates":{"EUR":0.9}}', '{"result":"success","conversion_ra', "junk", '{"result":"error"}', None]
    frame = spark.createDataFrame(list(enumerate(rates)), "n int, payload string")
    got = {r["n"]: r["reason"] for r in payloads.refused_rates(frame).collect()}
    assert got == {1: "malformed", 2: "malformed", 3: "failed answer", 4: "malformed"}

    weather = ['[{"current":{"time":"2024-01-01T00:00"}}]', '[{"current":{"ti', "junk", '{"error":true}', None]
    frame = spark.createDataFrame(list(enumerate(weather)), "n int, payload string")
    got = {r["n"]: r["reason"] for r in payloads.refused_weather(frame).collect()}
    assert got == {1: "malformed", 2: "malformed", 3: "failed answer", 4: "malformed"}
    rows = payloads.flatten_weather(frame, payloads.cities(spark), payloads.weather_codes(spark))
    assert [r["n"] for r in rows.collect()] == [0]
