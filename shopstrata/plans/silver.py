"""The six clean tables: what gates a feed, how it is cleaned, how it is written.

``transform`` functions are pure: DataFrame in, DataFrame out, no action. They
take one day of a feed or many at once; every row belongs to the day of its
``ingestion_date``, so a backfill of a whole history is one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.functions.bands import band, blank_to_null
from shopstrata.functions.money import ratio
from shopstrata.functions.people import email_parts, name_parts, phone_parts, plain_name, without_extension
from shopstrata.functions.times import days_between, utc_from_text
from shopstrata.operators import quality
from shopstrata.operators.dedup import latest_per_key
from shopstrata.operators.lineage import Run, clean_lineage
from shopstrata.operators.quality import Gate

_NEWEST = ["ingestion_date", "ingested_at"]


def _latest(feed: DataFrame, key: str) -> DataFrame:
    """Last state of each entity: later days win, within a day the later record."""
    return latest_per_key(feed, [key], _NEWEST, ["run_id"])


def _latest_of_day(feed: DataFrame, key: str) -> DataFrame:
    """Last record of each entity and day."""
    return latest_per_key(feed, ["ingestion_date", key], ["ingested_at"], ["run_id"])


def products(feed: DataFrame, run: Run) -> DataFrame:
    priced = (
        _latest(feed, "product_id")
        .drop("orders_last_15min")
        .withColumn("price_vs_base", ratio(F.col("current_price"), F.col("base_price"), 4))
    )
    return clean_lineage(priced, run, keep_updated_at=True)


def users(feed: DataFrame, run: Run) -> DataFrame:
    people = _latest(feed, "user_id").withColumns(
        {"_name": plain_name(F.col("name")), "_phone": without_extension(F.col("phone"))}
    )
    derived: dict[str, Column] = {
        **name_parts(F.col("_name")),
        **email_parts(F.col("email")),
        **phone_parts(F.col("_phone")),
        "account_age_days": days_between(F.lit(run.as_of), F.col("created_at")),
    }
    anonymous = people.withColumns(derived).drop("_name", "_phone", "name", "email", "phone")
    return clean_lineage(anonymous, run, keep_updated_at=True)


def sellers(feed: DataFrame, run: Run) -> DataFrame:
    edges, labels, otherwise = fixed.SELLER_TIER
    rated = _latest(feed, "seller_id").withColumns(
        {
            "seller_tier": band(F.col("seller_rating"), edges, labels, otherwise, ">="),
            "account_age_days": days_between(
                F.lit(run.as_of), utc_from_text(F.col("joined_at"))
            ),
        }
    )
    return clean_lineage(rated, run, keep_updated_at=True)


def orders(feed: DataFrame, run: Run) -> DataFrame:
    delivery = F.col("estimated_delivery_at")
    if dict(feed.dtypes)["estimated_delivery_at"] == "string":
        delivery = utc_from_text(blank_to_null(delivery))
    edges, labels, otherwise = fixed.ORDER_VALUE_BAND
    derived = _latest_of_day(feed, "order_id").withColumns(
        {
            "estimated_delivery_at": delivery,
            "has_discount": F.col("discount_total") > 0,
            "order_value_band": band(F.col("order_total"), edges, labels, otherwise),
            "days_to_delivery": days_between(delivery, F.col("ordered_at")),
        }
    )
    return clean_lineage(derived, run, keep_updated_at=False)


def fx_rates(feed: DataFrame, run: Run) -> DataFrame:
    return clean_lineage(_latest_of_day(feed, "pair"), run, keep_updated_at=False)


def weather(feed: DataFrame, run: Run) -> DataFrame:
    return clean_lineage(feed, run, keep_updated_at=False)


@dataclass(frozen=True)
class CleanTable:
    """How one feed becomes one clean table."""

    feed: str
    table: str
    transform: Callable[[DataFrame, Run], DataFrame]
    gate: Gate
    keys: Sequence[str]
    upserts: bool
    # Append guard: feed column -> column of the clean table holding the same value.
    guard: tuple[tuple[str, str], ...] = ()


PRODUCTS = CleanTable("bronze_products", "silver_products", products, Gate(), ["product_id"], True)

USERS = CleanTable("bronze_users", "silver_users", users, Gate(), ["user_id"], True)

SELLERS = CleanTable(
    "bronze_sellers",
    "silver_sellers",
    sellers,
    Gate(
        rules=[
            quality.not_null("seller_id"),
            quality.in_range("seller_rating", *fixed.RATING_RANGE),
            quality.in_range("fulfillment_score", *fixed.FULFILLMENT_RANGE),
        ],
        min_rows=fixed.MIN_SELLERS,
    ),
    ["seller_id"],
    True,
)

ORDERS = CleanTable(
    "bronze_orders",
    "silver_orders",
    orders,
    Gate(
        rules=[
            quality.not_null("order_id"),
            quality.positive("order_total"),
            quality.allowed("order_status", fixed.ORDER_STATUSES),
            quality.positive("item_count"),
        ],
        unique=["order_id"],
    ),
    ["order_id"],
    False,
    guard=(("order_id", "order_id"),),
)

FX_RATES = CleanTable(
    "bronze_fx_rates",
    "silver_fx_rates",
    fx_rates,
    Gate(
        rules=[
            quality.positive("exchange_rate", null_fails=True),
            quality.allowed("base_currency", [fixed.BASE_CURRENCY]),
        ],
        min_rows=fixed.MIN_PAIRS,
        required={"target_currency": fixed.REQUIRED_CURRENCIES},
    ),
    ["pair"],
    False,
    guard=(("pair", "pair"),),
)

WEATHER = CleanTable(
    "bronze_weather",
    "silver_weather",
    weather,
    Gate(
        rules=[
            quality.not_null("city"),
            quality.in_range("temperature_c", *fixed.TEMPERATURE_RANGE),
            quality.in_range("humidity_pct", *fixed.HUMIDITY_RANGE),
        ],
        required={"city": [city[0] for city in fixed.CITIES]},
    ),
    ["city", "observation_time", "run_id"],
    False,
    # The feed's run id is kept as last_run_id in the clean table.
    guard=(("city", "city"), ("observation_time", "observation_time"), ("run_id", "last_run_id")),
)

CLEAN_TABLES = {
    c.table.removeprefix("silver_"): c
    for c in (PRODUCTS, USERS, SELLERS, ORDERS, FX_RATES, WEATHER)
}
