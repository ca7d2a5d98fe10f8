"""Declared table schemas.

A clean ("silver") table is its feed ("bronze") table minus some columns plus
derived ones, so it is declared that way. Timestamps are zone-free UTC.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "STRING": StringType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def columns(text: str) -> StructType:
    """``"a INT, b STRING"`` as a schema; unlike ``fromDDL`` it needs no session."""
    pairs = (column.split() for column in text.split(","))
    return StructType([StructField(name, _TYPES[type_name]) for name, type_name in pairs])


FEED_LINEAGE = (
    "dataset STRING, source STRING, run_id STRING, ingested_at TIMESTAMP_NTZ, ingestion_date DATE"
)
CLEAN_LINEAGE = (
    "last_run_id STRING, run_id STRING, run_timestamp TIMESTAMP_NTZ, silver_processed_date DATE"
)
LANDING_BATCH = "landing_batch"

# Column names and types of the six feeds.
_FEED_COLUMNS = {
    "bronze_products": (
        "product_id INT, seller_id INT, sku STRING, name STRING, category STRING,"
        " subcategory STRING, brand STRING, base_price DOUBLE, weight_kg DOUBLE,"
        " is_active BOOLEAN, current_price DOUBLE, discount_active BOOLEAN,"
        " discount_pct DOUBLE, final_price DOUBLE, stock_quantity INT,"
        " is_low_stock BOOLEAN, rating DOUBLE, review_count INT, orders_last_15min INT"
    ),
    "bronze_orders": (
        "order_id STRING, user_id INT, order_status STRING, channel STRING,"
        " payment_method STRING, currency STRING, ordered_at TIMESTAMP_NTZ,"
        " estimated_delivery_at TIMESTAMP_NTZ, gross_total DOUBLE, discount_total DOUBLE,"
        " net_total DOUBLE, shipping_cost DOUBLE, tax_rate DOUBLE, tax_amount DOUBLE,"
        " order_total DOUBLE, item_count INT, total_quantity INT, top_category STRING,"
        " top_seller_id INT, products_json STRING, is_gift BOOLEAN, promo_code_used BOOLEAN"
    ),
    "bronze_users": (
        "user_id INT, name STRING, email STRING, phone STRING, gender STRING,"
        " date_of_birth STRING, country STRING, city STRING, address_line STRING,"
        " postal_code STRING, created_at TIMESTAMP_NTZ, preferred_category STRING,"
        " marketing_opt_in BOOLEAN, account_status STRING, customer_tier STRING,"
        " last_login_at TIMESTAMP_NTZ, session_count INT, lifetime_spend_usd DOUBLE,"
        " cart_item_count INT, wishlist_item_count INT, is_verified BOOLEAN"
    ),
    "bronze_weather": (
        "city STRING, country STRING, lat DOUBLE, lon DOUBLE, observation_time STRING,"
        " temperature_c DOUBLE, feels_like_c DOUBLE, humidity_pct DOUBLE,"
        " precipitation_mm DOUBLE, rain_mm DOUBLE, weather_code INT,"
        " weather_description STRING, wind_speed_kmh DOUBLE, wind_direction_deg DOUBLE,"
        " surface_pressure_hpa DOUBLE, cloud_cover_pct DOUBLE, visibility_m DOUBLE,"
        " is_day BOOLEAN, timezone STRING"
    ),
    "bronze_fx_rates": (
        "base_currency STRING, target_currency STRING, exchange_rate DOUBLE,"
        " rate_date_utc STRING, rate_unix BIGINT, next_update_utc STRING, pair STRING"
    ),
    "bronze_sellers": (
        "seller_id INT, seller_name STRING, email STRING, country STRING, city STRING,"
        " category_specialisation STRING, commission_rate DOUBLE, joined_at STRING,"
        " seller_rating DOUBLE, total_reviews INT, is_verified BOOLEAN,"
        " account_status STRING, total_products_listed INT, fulfillment_score DOUBLE"
    ),
}

# table -> (columns dropped from the feed, derived columns, partitioned by day?)
_CLEAN_CHANGES = {
    "silver_products": (
        ["orders_last_15min"],
        "price_vs_base DOUBLE, last_updated_at TIMESTAMP_NTZ",
        False,
    ),
    "silver_users": (
        ["name", "email", "phone"],
        "first_name STRING, last_name STRING, is_valid_email BOOLEAN, email_domain STRING,"
        " phone_country_code STRING, phone_number_clean STRING, has_country_code BOOLEAN,"
        " account_age_days INT, last_updated_at TIMESTAMP_NTZ",
        False,
    ),
    "silver_sellers": (
        [],
        "seller_tier STRING, account_age_days INT, last_updated_at TIMESTAMP_NTZ",
        False,
    ),
    "silver_orders": (
        [],
        "has_discount BOOLEAN, order_value_band STRING, days_to_delivery INT",
        True,
    ),
    "silver_fx_rates": ([], "", True),
    "silver_weather": ([], "", True),
}

LINE_ITEM = columns(
    "product_id INT, seller_id INT, category STRING, subcategory STRING, unit_price DOUBLE,"
    " quantity INT, discount_pct DOUBLE, final_unit_price DOUBLE, line_gross_total DOUBLE,"
    " line_net_total DOUBLE"
)


def _build_feeds() -> dict[str, StructType]:
    return {
        name: columns(f"{own}, {FEED_LINEAGE}") for name, own in _FEED_COLUMNS.items()
    }


def _build_clean() -> dict[str, StructType]:
    tables = {}
    for name, (dropped, derived, _) in _CLEAN_CHANGES.items():
        feed = columns(_FEED_COLUMNS[name.replace("silver_", "bronze_")])
        fields: list[StructField] = [f for f in feed.fields if f.name not in dropped]
        if derived:
            fields += columns(derived).fields
        fields += columns(CLEAN_LINEAGE).fields
        tables[name] = StructType(fields)
    return tables


BRONZE: dict[str, StructType] = _build_feeds()
SILVER: dict[str, StructType] = _build_clean()
PARTITION_COLUMNS: dict[str, list[str]] = {
    # The batch comes first, so one batch can be replaced as a whole.
    **{name: [LANDING_BATCH, "ingestion_date"] for name in BRONZE},
    **{
        name: ["silver_processed_date"] if by_day else []
        for name, (_, _, by_day) in _CLEAN_CHANGES.items()
    },
}
