"""Star schema: five dimensions, the order fact and the daily sales fact."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.functions.bands import band
from shopstrata.functions.money import (
    exact_sum,
    decimal_sum,
    ratio,
    round_half_up,
    share_pct,
    to_base_currency,
)
from shopstrata.functions.times import business_date, calendar_parts, round_to_millis
from shopstrata.operators import quality
from shopstrata.operators.dedup import latest_per_key
from shopstrata.operators.joins import allowed_only, left_lookup
from shopstrata.operators.quality import Gate
from shopstrata.sources.literals import literal_table


# --- dimensions --------------------------------------------------------------


def currency_list(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "code, currency_name, region, symbol", fixed.CURRENCIES)


def currency_dim(rates: DataFrame) -> DataFrame:
    """The known currencies with their latest rate; 1.0 where no rate is known."""
    known = currency_list(rates.sparkSession)
    codes = known.select(F.col("code").alias("target_currency"))
    listed = allowed_only(
        rates.select("target_currency", "exchange_rate", "silver_processed_date"),
        codes,
        "target_currency",
    )
    newest = latest_per_key(
        listed, ["target_currency"], ["silver_processed_date"], ["exchange_rate"]
    )
    # The fixed list bounds both sides: at most one rate per listed currency is left.
    on = F.col("code") == F.col("target_currency")
    return left_lookup(known, F.broadcast(newest), on).select(
        F.col("code").alias("currency_sk"),
        "code",
        "currency_name",
        "region",
        "symbol",
        F.coalesce("exchange_rate", F.lit(fixed.DEFAULT_RATE)).alias("usd_exchange_rate"),
        F.col("silver_processed_date").alias("rate_date"),
    )


def date_dim(
    orders: DataFrame,
    as_of: date,
    max_days: int | None = None,
) -> DataFrame:
    """One row per day from the first order up to ``as_of``, or ``max_days`` days where that is asked for.

    Needs nothing of ``orders`` but ``ordered_at``, and only its minimum.
    """
    first = F.min("ordered_at").cast("date")
    bounds = orders.agg(first.alias("first_day"))
    last = F.lit(as_of)
    if max_days is not None:
        last = F.least(last, F.date_add("first_day", max_days - 1))
    spine = bounds.select(
        F.explode(
            F.when(last >= F.col("first_day"), F.sequence(F.col("first_day"), last))
        ).alias("date")
    )
    return spine.select("date", *[c.alias(n) for n, c in calendar_parts(F.col("date")).items()])


def product_dim(products: DataFrame) -> DataFrame:
    edges, labels, otherwise = fixed.PRICE_BAND
    return products.select(
        F.col("product_id").alias("product_sk"),
        "product_id", "sku", F.col("name").alias("product_name"),
        "category", "subcategory", "brand",
        "base_price", "current_price", "final_price", "price_vs_base",
        band(F.col("base_price"), edges, labels, otherwise).alias("price_band"),
        "is_active", "discount_active", "discount_pct", "is_low_stock",
        "rating", "review_count", "silver_processed_date",
    )


def _not_suspended(df: DataFrame) -> DataFrame:
    return df.where(F.col("account_status") != fixed.SUSPENDED)


def seller_dim(sellers: DataFrame) -> DataFrame:
    edges, labels, otherwise = fixed.FULFILLMENT_BAND
    return _not_suspended(sellers).select(
        F.col("seller_id").alias("seller_sk"),
        "seller_id", "seller_name", "email", "country", "city",
        "category_specialisation", "commission_rate", "joined_at",
        "seller_rating", "total_reviews", "is_verified", "account_status",
        "total_products_listed", "fulfillment_score", "seller_tier", "account_age_days",
        band(F.col("fulfillment_score"), edges, labels, otherwise, ">=").alias("fulfillment_band"),
        "silver_processed_date",
    )


def user_dim(users: DataFrame) -> DataFrame:
    age = band(F.col("account_age_days"), *fixed.ACCOUNT_AGE_SEGMENT)
    spend = band(F.col("lifetime_spend_usd"), *fixed.SPEND_SEGMENT)
    return _not_suspended(users).select(
        F.col("user_id").alias("user_sk"),
        "user_id", "first_name", "last_name", "email_domain", "is_valid_email",
        "gender", "country", "city", "preferred_category", "marketing_opt_in",
        "account_status", "customer_tier", "lifetime_spend_usd", "is_verified",
        "session_count", "account_age_days",
        age.alias("account_age_segment"),
        spend.alias("spend_segment"),
        "silver_processed_date",
    )


# --- facts -------------------------------------------------------------------


@dataclass(frozen=True)
class Dimensions:
    users: DataFrame
    dates: DataFrame
    currencies: DataFrame
    sellers: DataFrame
    products: DataFrame


def category_representatives(products: DataFrame) -> DataFrame:
    """The product with the smallest key of each category.

    An aggregation, so that each task sends one row per category and the join
    sees at runtime how few there are.
    """
    smallest = F.min(F.struct("product_sk", "price_band")).alias("first")
    return products.where("product_sk IS NOT NULL").groupBy("category").agg(smallest).select(
        "category", "first.product_sk", "first.price_band"
    )


def fact_orders(orders: DataFrame, dims: Dimensions) -> DataFrame:
    """Every order once, with its dimension keys (-1 / USD when unknown) and USD amounts.

    Currencies are a fixed list and broadcast. The joins with dates, categories,
    users and sellers are left to the optimizer and its runtime sizes; where it
    shuffles, it does so on the natural key, which keeps NULL and unknown keys
    apart instead of piling them up on one substitute value.
    """
    placed = orders.withColumns(
        {
            "_day": business_date(F.col("ordered_at")),
            "ordered_at": round_to_millis(F.col("ordered_at")),
            "estimated_delivery_at": round_to_millis(F.col("estimated_delivery_at")),
        }
    )
    days = dims.dates.select(
        F.col("date").alias("_day"),
        "date_sk",
        F.col("year").alias("order_year"),
        F.col("month").alias("order_month"),
        F.col("quarter").alias("order_quarter"),
        "is_weekend",
    )
    currencies = dims.currencies.select(
        F.col("code").alias("currency"), "currency_sk", "usd_exchange_rate"
    )
    representatives = category_representatives(dims.products).select(
        F.col("category").alias("top_category"),
        F.col("category").alias("product_category"),
        "product_sk",
        F.col("price_band").alias("product_price_band"),
    )
    sellers = dims.sellers.select(
        F.col("seller_id").alias("top_seller_id"),
        F.col("seller_sk").alias("top_seller_sk"),
        F.col("seller_name").alias("top_seller_name"),
        F.col("category_specialisation").alias("seller_category"),
        "seller_tier", "fulfillment_band", "commission_rate",
    )
    users = dims.users.select(
        "user_id", "user_sk", "customer_tier",
        F.col("country").alias("user_country"), "spend_segment",
    )

    # The joins that may shuffle come first, while the rows are narrow; the
    # map-side lookups then widen them within the last stage.
    joined = left_lookup(placed, users, "user_id")
    joined = left_lookup(joined, sellers, "top_seller_id")
    joined = left_lookup(joined, representatives, "top_category")
    joined = left_lookup(joined, F.broadcast(currencies), "currency")
    joined = left_lookup(joined, days, "_day")

    def known(key: str, unknown: object) -> Column:
        return F.coalesce(F.col(key), F.lit(unknown)).alias(key)

    rate = F.coalesce("usd_exchange_rate", F.lit(fixed.DEFAULT_RATE))
    return joined.select(
        "order_id",
        known("product_sk", fixed.UNKNOWN_KEY),
        known("user_sk", fixed.UNKNOWN_KEY),
        known("date_sk", fixed.UNKNOWN_KEY),
        known("currency_sk", fixed.DEFAULT_CURRENCY),
        known("top_seller_sk", fixed.UNKNOWN_KEY),
        "order_status", "channel", "payment_method", "currency",
        "ordered_at", "estimated_delivery_at",
        "gross_total", "discount_total", "net_total", "shipping_cost", "tax_amount", "order_total",
        to_base_currency(F.col("order_total"), rate).alias("order_total_usd"),
        to_base_currency(F.col("net_total"), rate).alias("net_total_usd"),
        "item_count", "total_quantity", "top_category", "top_seller_id", "products_json",
        "is_gift", "promo_code_used", "has_discount", "order_value_band", "days_to_delivery",
        "product_category", "product_price_band",
        "customer_tier", "user_country", "spend_segment",
        "top_seller_name", "seller_category", "seller_tier", "fulfillment_band", "commission_rate",
        "order_year", "order_month", "order_quarter", "is_weekend",
        "silver_processed_date",
    )


# The twelve grouping columns of the daily fact. They travel as two structs: the
# code generated for twelve separate nullable keys gets too big to be compiled.
_DAY_KEYS = ["date_sk", "order_date", "order_year", "order_month", "order_quarter", "is_weekend"]
_GROUP_KEYS = [
    "category", "channel", "customer_tier", "user_country", "seller_tier", "seller_category",
]


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per day, category, channel, tier, country and seller group.

    Cancelled and refunded orders (and those without a status) are left out, so
    the two columns counting them are there but always 0.
    """
    sold = fact.where(~F.col("order_status").isin(fixed.STATUSES_WITHOUT_REVENUE)).withColumns(
        {
            "order_date": business_date(F.col("ordered_at")),
            "category": F.col("product_category"),
            "commission_usd": F.col("order_total_usd") * F.col("commission_rate"),
        }
    )
    counted = {
        "discounted_orders": F.col("has_discount"),
        **{
            f"{label}_value_orders": F.col("order_value_band") == label
            for label in (*fixed.ORDER_VALUE_BAND[1], fixed.ORDER_VALUE_BAND[2])
        },
        "gift_orders": F.col("is_gift"),
        "promo_orders": F.col("promo_code_used"),
        **{
            f"{status}_orders": F.col("order_status") == status
            for status in ("delivered", "cancelled", "returned", "refunded")
        },
    }
    orders, total = F.count("order_id"), exact_sum(F.col("order_total_usd"))
    priced = F.count("order_total_usd").cast("double")
    keyed = sold.withColumns({"_day": F.struct(*_DAY_KEYS), "_group": F.struct(*_GROUP_KEYS)})
    totals = keyed.groupBy("_day", "_group").agg(
        orders.alias("total_orders"),
        F.countDistinct("user_sk").alias("unique_customers"),
        F.countDistinct("top_seller_sk").alias("unique_sellers"),
        F.sum("item_count").alias("total_items"),
        F.sum("total_quantity").alias("total_units"),
        total.alias("revenue_usd"),
        exact_sum(F.col("net_total_usd")).alias("net_revenue_usd"),
        ratio(total, priced, 2).alias("avg_order_value_usd"),
        F.max("order_total_usd").alias("max_order_value_usd"),
        round_half_up(decimal_sum(F.col("commission_usd")), 2).alias("total_commission_usd"),
        share_pct(F.count_if("has_discount"), orders).alias("discount_rate_pct"),
        *[F.count_if(test).alias(name) for name, test in counted.items()],
    )
    measures = [c for c in totals.columns if not c.startswith("_")]
    return totals.select("_day.*", "_group.*", *measures)


# --- table tests ---------------------------------------------------------------

# The columns that must be filled, and the ones that must be unique.
TABLE_TESTS = {
    "dim_date": Gate([quality.not_null("date_sk")], unique=["date_sk"], null_key_is_duplicate=False),
    "dim_product": Gate([quality.not_null("product_sk")], unique=["product_sk"], null_key_is_duplicate=False),
    "dim_user": Gate([quality.not_null("user_sk")], unique=["user_sk"], null_key_is_duplicate=False),
    "dim_currency": Gate([quality.not_null("currency_sk")], unique=["currency_sk"], null_key_is_duplicate=False),
    "fact_orders": Gate(
        [quality.not_null("order_id"), quality.not_null("order_total_usd")],
        unique=["order_id"],
        null_key_is_duplicate=False,
    ),
    "fact_daily_sales": Gate([quality.not_null("revenue_usd")]),
}
