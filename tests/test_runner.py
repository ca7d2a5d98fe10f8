"""Feeds in catalog tables -> clean tables -> star schema, day by day."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shopstrata.operators.lineage import Run
from shopstrata.operators.quality import QualityError
from shopstrata.plans import gold, reports, silver
from shopstrata.plans.runner import gold_report, run_gold, run_partition
from shopstrata.schemas import BRONZE, LANDING_BATCH
from shopstrata.sources import tables as catalog
from tests.conftest import rows

DAY = dt.date(2024, 1, 30)
NEXT = dt.date(2024, 1, 31)
AS_OF = dt.date(2024, 2, 2)


def run_of(day, name):
    return Run(dt.datetime.combine(day + dt.timedelta(days=1), dt.time(2)), AS_OF, name)


def feed(spark, name, records, day=DAY, at="12:00:00"):
    """Feed rows from dicts; absent fields are NULL."""
    schema = BRONZE[name]
    stamp = dt.datetime.fromisoformat(f"{day}T{at}")
    base = {"dataset": name, "source": "test", "run_id": "feed", "ingested_at": stamp, "ingestion_date": day}
    data = [tuple({**base, **r}.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema).withColumn(LANDING_BATCH, F.lit("t"))


def user(i, **more):
    return {"user_id": i, "name": f"Dr. A{i} B{i}", "email": f"a{i}@x.com", "phone": "+1-555",
            "account_status": "active", "customer_tier": "gold", "country": "India",
            "lifetime_spend_usd": 150.0, "created_at": dt.datetime(2024, 1, 1), **more}


def seller(i, **more):
    return {"seller_id": i, "seller_name": f"S{i}", "email": f"s{i}@x.com", "seller_rating": 4.2,
            "fulfillment_score": 96.0, "commission_rate": 0.1, "account_status": "active",
            "category_specialisation": "Toys", "joined_at": "2023-02-02T00:00:00+00:00", **more}


def order(i, **more):
    return {"order_id": f"o{i}", "user_id": 1, "order_status": "delivered", "channel": "web", "currency": "EUR",
            "ordered_at": dt.datetime(2024, 1, 29, 10), "estimated_delivery_at": dt.datetime(2024, 2, 1),
            "gross_total": 110.0, "discount_total": 10.0, "net_total": 100.0, "order_total": 120.0,
            "item_count": 2, "total_quantity": 3, "top_category": "Toys", "top_seller_id": 1,
            "is_gift": False, "promo_code_used": True, **more}


def fx(code, rate, **more):
    return {"base_currency": "USD", "target_currency": code, "exchange_rate": rate, "pair": f"USD/{code}", **more}


def all_rates(eur=0.8):
    from shopstrata import fixed_values as fixed
    return [fx(c, eur if c == "EUR" else 2.0) for c in fixed.TARGET_CURRENCIES]


def observation(city, **more):
    return {"city": city, "observation_time": "2024-01-30T00:15", "temperature_c": 20.0, "humidity_pct": 50.0, **more}


def all_cities(**more):
    from shopstrata import fixed_values as fixed
    return [observation(c[0], **more) for c in fixed.CITIES]


@pytest.fixture
def lake(spark, tmp_path):
    name = "r_" + uuid.uuid4().hex[:10]
    for suffix in "bsg":
        spark.sql(f"CREATE DATABASE {name}{suffix} LOCATION '{tmp_path}/{suffix}'")
    catalog.create_tables(spark, name + "b", name + "s", root=str(tmp_path / "tables"))

    class Lake:
        bronze, silver, gold = name + "b", name + "s", name + "g"

        def put(self, feed_name, records, day=DAY, **kwargs):
            catalog.append_table(feed(spark, feed_name, records, day, **kwargs), f"{self.bronze}.{feed_name}")

        def clean(self, table, day=DAY, run="run", **more):
            return run_partition(spark, table, day, run_of(day, run), self.bronze, self.silver, **more)

        def table(self, table):
            return spark.table(f"{self.silver}.silver_{table}")

    return Lake()


def test_empty_day_writes_nothing(lake):
    outcome = lake.clean("orders")
    assert (outcome.rows_read, outcome.written) == (0, False)
    assert lake.table("orders").isEmpty()


def test_orders_are_appended_once(lake):
    lake.put("bronze_orders", [order(1), order(2, order_total=2000.0, discount_total=0.0, estimated_delivery_at=None)])
    assert lake.clean("orders", run="first").rows_read == 2
    again = lake.clean("orders", run="again")
    assert (again.rows_read, again.written) == (2, False)
    lake.put("bronze_orders", [order(3)])
    assert lake.clean("orders", run="third").written
    got = lake.table("orders").select(
        "order_id", "has_discount", "order_value_band", "days_to_delivery", "last_run_id", "run_id",
        "run_timestamp", "silver_processed_date",
    )
    at = dt.datetime(2024, 1, 31, 2)
    assert rows(got) == [
        ("o1", True, "medium", 3, "feed", "first", at, DAY),
        ("o2", False, "premium", None, "feed", "first", at, DAY),
        ("o3", True, "medium", 3, "feed", "third", at, DAY),
    ]


@pytest.mark.parametrize(
    "bad, rule",
    [
        ({"order_id": None}, "order_id_not_null"),
        ({"order_id": "o1"}, "order_id_unique"),
        ({"order_total": 0.0}, "order_total_positive"),
        ({"order_status": "lost"}, "order_status_allowed"),
        ({"item_count": 0}, "item_count_positive"),
    ],
)
def test_a_broken_rule_stops_before_writing(lake, bad, rule):
    lake.put("bronze_orders", [order(1), order(2, **bad)])
    with pytest.raises(QualityError, match=f"{rule}: 1"):
        lake.clean("orders")
    assert lake.table("orders").isEmpty()


def test_null_status_and_total_pass(lake):
    lake.put("bronze_orders", [order(1, order_status=None, order_total=None)])
    lake.clean("orders")
    assert lake.table("orders").first()["order_value_band"] == "premium"


def test_users_are_upserted_without_personal_data(lake):
    lake.put("bronze_users", [user(1), user(2)], at="10:00:00")
    lake.put("bronze_users", [user(1, customer_tier="platinum")], at="11:00:00")
    lake.clean("users", run="d1")
    lake.put("bronze_users", [user(2, customer_tier="silver"), user(3)], day=NEXT)
    lake.clean("users", NEXT, run="d2")
    got = lake.table("users")
    assert rows(got.select("user_id", "customer_tier", "first_name", "last_name", "account_age_days", "run_id")) == [
        (1, "platinum", "A1", "B1", 32, "d1"),
        (2, "silver", "A2", "B2", 32, "d2"),
        (3, "gold", "A3", "B3", 32, "d2"),
    ]
    assert not {"name", "email", "phone"} & set(got.columns)


def test_the_repeat_of_an_old_day_can_leave_newer_rows(lake):
    lake.put("bronze_users", [user(1), user(2)])
    lake.put("bronze_users", [user(2, customer_tier="silver")], day=NEXT)
    lake.clean("users", NEXT, run="d2")
    lake.clean("users", run="d1", newer_by="silver_processed_date")
    tiers = lake.table("users").select("user_id", "customer_tier")
    assert rows(tiers) == [(1, "gold"), (2, "silver")]
    lake.clean("users", run="d1")
    assert rows(tiers.sparkSession.table(f"{lake.silver}.silver_users").select("user_id", "customer_tier")) == [(1, "gold"), (2, "gold")]


def test_products_division_guard(lake):
    lake.put("bronze_products", [
        {"product_id": 1, "base_price": 3.0, "current_price": 2.0},
        {"product_id": 2, "base_price": 0.0, "current_price": 2.0},
    ])
    lake.clean("products")
    assert rows(lake.table("products").select("product_id", "price_vs_base", "last_updated_at")) == [
        (1, 0.6667, dt.datetime(2024, 1, 30, 12)), (2, None, dt.datetime(2024, 1, 30, 12)),
    ]


def test_sellers_need_ninety_rows(lake):
    lake.put("bronze_sellers", [seller(i) for i in range(89)])
    with pytest.raises(QualityError, match="min_row_count: 1"):
        lake.clean("sellers")
    lake.put("bronze_sellers", [seller(89, seller_rating=4.5)])
    lake.clean("sellers")
    tiers = lake.table("sellers").groupBy("seller_tier", "account_age_days").count()
    assert rows(tiers) == [("gold", 365, 89), ("platinum", 365, 1)]
    assert lake.table("sellers").first()["email"] is not None


def test_rates_need_the_required_currencies(lake):
    lake.put("bronze_fx_rates", [r for r in all_rates() if r["target_currency"] != "AED"] + [fx("USD", 1.0)])
    with pytest.raises(QualityError, match="target_currency_required_values: 1"):
        lake.clean("fx_rates")


def test_weather_rerun_writes_nothing_twice(lake):
    lake.put("bronze_weather", all_cities())
    lake.clean("weather", run="one")
    lake.clean("weather", run="two")
    assert lake.table("weather").count() == 10
    lake.put("bronze_weather", all_cities(run_id="feed-2"))
    lake.clean("weather", run="three")
    assert rows(lake.table("weather").groupBy("last_run_id", "run_id").count()) == [
        ("feed", "one", 10), ("feed-2", "three", 10),
    ]


@pytest.mark.parametrize("bad, rule", [
    ({"temperature_c": 60.1}, "temperature_c_in_range"), ({"humidity_pct": None}, "humidity_pct_in_range"),
])
def test_weather_ranges(lake, bad, rule):
    lake.put("bronze_weather", all_cities() + [observation("Delhi", **bad)])
    with pytest.raises(QualityError, match=f"{rule}: 1"):
        lake.clean("weather")


def test_star_schema(spark, lake):
    lake.put("bronze_users", [user(1), user(2, account_status="suspended"), user(3, account_status=None)])
    lake.put("bronze_products", [
        {"product_id": 5, "category": "Toys", "base_price": 20.0, "current_price": 20.0},
        {"product_id": 4, "category": "Toys", "base_price": 600.0, "current_price": 20.0},
    ])
    lake.put("bronze_sellers", [seller(i) for i in range(1, 92)] + [seller(99, account_status="suspended")])
    lake.put("bronze_fx_rates", all_rates(eur=0.5))
    lake.put("bronze_fx_rates", all_rates(eur=0.8), day=NEXT)
    late = dt.datetime(2024, 1, 29, 23, 59, 59, 999600)
    lake.put("bronze_orders", [
        order(1, ordered_at=late),
        order(2, user_id=2, currency="XXX", top_seller_id=99, top_category="Books"),
        order(3, currency="USD", ordered_at=dt.datetime(2024, 2, 20)),
        order(4, order_status="cancelled"),
        order(5, order_status="refunded"),
        order(6, order_status=None),
        order(7, top_seller_id=None, order_status="returned", discount_total=0.0),
    ])
    for table in ("users", "products", "sellers", "orders"):
        lake.clean(table)
    for day in (DAY, NEXT):
        lake.clean("fx_rates", day)
    run_gold(spark, lake.silver, lake.gold, AS_OF)
    run_gold(spark, lake.silver, lake.gold, AS_OF)  # a refresh gives the same

    fact = spark.table(f"{lake.gold}.fact_orders")
    assert fact.count() == 7
    keys = fact.select("order_id", "product_sk", "user_sk", "date_sk", "currency_sk", "top_seller_sk", "order_total_usd")
    assert rows(keys)[:3] == [
        ("o1", 4, 1, 20240130, "EUR", 1, 150.0),
        ("o2", -1, -1, 20240129, "USD", -1, 120.0),
        ("o3", 4, 1, -1, "USD", 1, 120.0),
    ]
    o2 = fact.where("order_id = 'o2'").first()
    assert o2["customer_tier"] is None and o2["seller_tier"] is None and o2["currency"] == "XXX"
    assert fact.where("order_id = 'o1'").first()["product_price_band"] == "luxury"

    currencies = spark.table(f"{lake.gold}.dim_currency")
    assert currencies.count() == 21
    assert rows(currencies.where("code in ('USD', 'EUR')").select("code", "usd_exchange_rate", "rate_date")) == [
        ("EUR", 0.8, NEXT), ("USD", 1.0, None),
    ]
    # NULL status is not "!= suspended" either.
    assert rows(spark.table(f"{lake.gold}.dim_user").select("user_id", "spend_segment")) == [(1, "medium")]
    dates = spark.table(f"{lake.gold}.dim_date")
    assert (dates.count(), dates.agg(F.min("date"), F.max("date")).first()) == (5, (dt.date(2024, 1, 29), AS_OF))

    daily = spark.table(f"{lake.gold}.fact_daily_sales")
    assert daily.agg(F.sum("total_orders")).first()[0] == 4
    assert daily.agg(F.sum("cancelled_orders"), F.sum("refunded_orders"), F.sum("returned_orders")).first() == (0, 0, 1)
    unknown_seller = daily.where("seller_tier is null and category = 'Toys'").first()
    assert unknown_seller["total_commission_usd"] is None and unknown_seller["unique_sellers"] == 1
    first = daily.where("date_sk = 20240130").first()
    assert (first["revenue_usd"], first["total_commission_usd"], first["discount_rate_pct"]) == (150.0, 15.0, 100.0)

    assert {r["failed_rows"] for r in gold_report(spark, lake.gold).collect()} == {0}
    assert gold_report(spark, lake.gold).count() == 12
    assert rows(reports.status_breakdown(fact)) == sorted([
        ("delivered", 3), ("cancelled", 1), ("refunded", 1), (None, 1), ("returned", 1)], key=repr)
    assert rows(reports.spend_segments(spark.table(f"{lake.gold}.dim_user"))) == [("medium", 1, 100.0)]


def test_date_spine_bounds(spark):
    orders = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 3, 1),)], "ordered_at timestamp_ntz")
    assert gold.date_dim(orders, dt.date(2024, 1, 10)).count() == 10
    assert gold.date_dim(orders, dt.date(2030, 1, 1), max_days=7).count() == 7
    assert gold.date_dim(orders, dt.date(2030, 1, 1)).count() == 2193
    assert gold.date_dim(orders, dt.date(2023, 1, 1)).count() == 0
    assert gold.date_dim(orders.limit(0), dt.date(2024, 1, 10)).count() == 0


def test_a_backfill_equals_the_days_run_one_by_one(spark, lake):
    lake.put("bronze_users", [user(1), user(2)])
    lake.put("bronze_users", [user(2, customer_tier="silver"), user(3)], day=NEXT)
    run = run_of(NEXT, "r")
    backfill = silver.users(spark.table(f"{lake.bronze}.bronze_users"), run)
    for day in (DAY, NEXT):
        run_partition(spark, "users", day, run, lake.bronze, lake.silver)
    one_by_one = lake.table("users").select(*backfill.columns)
    assert rows(backfill) == rows(one_by_one)
