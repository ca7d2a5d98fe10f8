"""Report queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.functions.money import exact_sum, ratio, share_pct


def _revenue_by(daily: DataFrame, *keys: str) -> DataFrame:
    return daily.groupBy(*keys).agg(exact_sum(F.col("revenue_usd")).alias("revenue_usd"))


def daily_revenue(daily: DataFrame) -> DataFrame:
    return _revenue_by(daily, "order_date").orderBy("order_date")


def revenue_by_category(daily: DataFrame) -> DataFrame:
    return _revenue_by(daily, "category")


def revenue_by_channel(daily: DataFrame) -> DataFrame:
    return _revenue_by(daily, "channel")


def revenue_by_country(daily: DataFrame) -> DataFrame:
    return _revenue_by(daily, "user_country")


def orders_by_tier(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_tier").agg(F.count("order_id").alias("orders"))


def spend_segments(users: DataFrame) -> DataFrame:
    """Users per spend segment and their share; the window only sees the few segment rows."""
    counts = users.groupBy("spend_segment").agg(F.count(F.lit(1)).alias("users"))
    total = F.sum("users").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "spend_segment", "users", share_pct(F.col("users"), total, 2).alias("share_pct")
    )


def top_sellers(fact: DataFrame, k: int = 10) -> DataFrame:
    sold = fact.where(F.col("top_seller_name").isNotNull())
    revenue = sold.groupBy("top_seller_sk", "top_seller_name").agg(
        exact_sum(F.col("order_total_usd")).alias("revenue_usd")
    )
    return revenue.orderBy(F.desc("revenue_usd"), "top_seller_sk").limit(k)


def tier_commission(sellers: DataFrame) -> DataFrame:
    rate = F.sum(F.col("commission_rate").cast("decimal(18,6)")).cast("double")
    return sellers.groupBy("seller_tier").agg(
        F.count(F.lit(1)).alias("sellers"),
        ratio(rate, F.count("commission_rate").cast("double"), 6).alias("avg_commission_rate"),
    )


def status_breakdown(fact: DataFrame) -> DataFrame:
    """From the order fact: the daily fact no longer has cancelled and refunded orders."""
    return fact.groupBy("order_status").agg(F.count("order_id").alias("orders"))


def discount_trend(daily: DataFrame) -> DataFrame:
    """Discounted share of each day's orders, from counts instead of averaged percentages."""
    discounted, orders = F.sum("discounted_orders"), F.sum("total_orders")
    return daily.groupBy("order_date").agg(
        discounted.alias("discounted_orders"),
        orders.alias("total_orders"),
        share_pct(discounted, orders).alias("discount_rate_pct"),
    ).orderBy("order_date")


def weekend_volume(daily: DataFrame) -> DataFrame:
    return daily.groupBy("is_weekend").agg(F.sum("total_orders").alias("total_orders"))


def commission_by_category(daily: DataFrame) -> DataFrame:
    return daily.groupBy("seller_category").agg(
        exact_sum(F.col("total_commission_usd")).alias("total_commission_usd")
    )
