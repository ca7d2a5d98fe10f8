"""The registered queries: every operator and model over the sample tables.

Each entry takes (spark, folder) and returns one DataFrame computed from whole
tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.functions.bands import band, blank_to_null
from shopstrata.functions.money import exact_sum, round_half_up
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
from shopstrata.operators import lines as line_ops
from shopstrata.operators import merge, quality
from shopstrata.operators.dedup import first_per_group, latest_per_key
from shopstrata.operators.joins import decode
from shopstrata.operators.lineage import Run, stamp
from shopstrata.plans import gold, reports, silver
from shopstrata.schemas import BRONZE
from shopstrata.sources import payloads, sample_tables, tables
from shopstrata.sources.literals import literal_table
from shopstrata.sources.sample_tables import SampleTables
from shopstrata.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run(datetime(2024, 1, 31, 2, 0), date(2024, 1, 31), "run-1")

# Sample part types shown as retail categories; STANDARD has no counterpart.
RETAIL_CATEGORY = [
    ("ECONOMY", "Groceries"), ("LARGE", "Home"), ("MEDIUM", "Electronics"),
    ("PROMO", "Clothing"), ("SMALL", "Books"),
]

_QUERIES: dict[str, Callable[[SampleTables], DataFrame]] = {}


def _register(build: Callable[[SampleTables], DataFrame]) -> Callable[[SampleTables], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    def bind(build: Callable[[SampleTables], DataFrame]) -> Query:
        return lambda spark, folder: build(SampleTables(spark, folder))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- scans and landing ---------------------------------------------------------


@_register
def scan_partition(t: SampleTables) -> DataFrame:
    """The orders of one day, through the day scan's filter."""
    dated = t.read("orders").withColumn("ingestion_date", F.to_date("o_orderdate"))
    return tables.rows_of_day(dated, date(1998, 3, 14))


@_register
def fx_flatten(t: SampleTables) -> DataFrame:
    documents = sample_tables.rate_documents(t)
    return payloads.flatten_rates(documents, payloads.target_currencies(t.spark))


@_register
def weather_flatten(t: SampleTables) -> DataFrame:
    documents = sample_tables.weather_documents(t)
    return payloads.flatten_weather(
        documents, payloads.cities(t.spark), payloads.weather_codes(t.spark)
    ).select(
        "document_id", "city", "country", "lat", "lon", "observation_time", "temperature_c",
        "humidity_pct", "weather_code", "weather_description", "is_day", "timezone",
    )


@_register
def code_lookup(t: SampleTables) -> DataFrame:
    observed = sample_tables.weather(t).drop("weather_description")
    named = decode(
        observed, payloads.weather_codes(t.spark), "weather_code",
        "weather_description", fixed.UNKNOWN_WEATHER,
    )
    return named.groupBy("weather_code", "weather_description").agg(
        F.count(F.lit(1)).alias("observations")
    )


def _retail_category(df: DataFrame, column: str) -> DataFrame:
    names = literal_table(df.sparkSession, f"{column}, retail_category", RETAIL_CATEGORY)
    return decode(df, names, column, "retail_category", "Other")


@_register
def commission_lookup(t: SampleTables) -> DataFrame:
    rates = literal_table(t.spark, "retail_category, list_rate", fixed.COMMISSION_RATES.items())
    sellers = sample_tables.sellers(t).select("seller_id", "category_specialisation", "run_id")
    named = _retail_category(sellers, "category_specialisation")
    return named.join(F.broadcast(rates), "retail_category", "left").select(
        "seller_id", "run_id", "retail_category",
        F.coalesce("list_rate", F.lit(0.10)).alias("commission_rate"),
    )


@_register
def route_counts(t: SampleTables) -> DataFrame:
    routed = landing.with_dataset(sample_tables.feed_lines(t))
    return landing.route_outcomes(routed, BRONZE)


@_register
def typed_decode(t: SampleTables) -> DataFrame:
    routed = landing.with_dataset(sample_tables.feed_lines(t))
    return landing.accepted(routed, "bronze_orders", BRONZE["bronze_orders"]).select(
        "order_id", "user_id", "ordered_at", "estimated_delivery_at", "order_total",
        "run_id", "ingested_at", "ingestion_date",
    )


@_register
def ingestion_stamp(t: SampleTables) -> DataFrame:
    rows = t.read("supplier").select(F.col("s_suppkey").alias("seller_id"))
    return stamp(rows, "bronze_sellers", "catalogue", "run-1", datetime(2024, 1, 31, 2, 0))


# --- dedup, upsert, append -------------------------------------------------------


@_register
def dedup_latest(t: SampleTables) -> DataFrame:
    return latest_per_key(t.read("events"), ["user_id"], ["ts"], ["event_id"])


@_register
def first_per_category(t: SampleTables) -> DataFrame:
    return first_per_group(
        t.read("part"), ["p_type"], ["p_partkey"], ["p_type", "p_partkey", "p_brand"]
    )


def _latest_order_per_customer(t: SampleTables, open_orders: bool) -> DataFrame:
    is_open = F.col("o_orderstatus") == "P"
    orders = t.read("orders").where(is_open if open_orders else ~is_open)
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])


@_register
def upsert_scd1(t: SampleTables) -> DataFrame:
    """Customers' last settled order, updated by their last open one."""
    return merge.upsert(
        _latest_order_per_customer(t, False), _latest_order_per_customer(t, True), ["o_custkey"]
    )


@_register
def upsert_newer_only(t: SampleTables) -> DataFrame:
    """The same, unless the open order is the older one."""
    return merge.upsert(
        _latest_order_per_customer(t, False),
        _latest_order_per_customer(t, True),
        ["o_custkey"],
        newer_by="o_orderdate",
    )


@_register
def append_new(t: SampleTables) -> DataFrame:
    """Orders without any finished line yet."""
    finished = t.read("lineitem").where("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return merge.append_new(t.read("orders"), finished, ["o_orderkey"])


@_register
def append_new_composite(t: SampleTables) -> DataFrame:
    """Weather rows not written by the runs of the first half of the month."""
    feed = sample_tables.weather(t)
    written = silver.weather(feed.where("ingestion_date < date '2024-01-16'"), RUN).select(
        "city", "observation_time", F.col("last_run_id").alias("run_id")
    )
    return merge.append_new(feed, written, ["city", "observation_time", "run_id"]).select(
        "city", "observation_time", "run_id", "temperature_c", "ingestion_date"
    )


# --- quality ---------------------------------------------------------------------


@_register
def dq_orders(t: SampleTables) -> DataFrame:
    return quality.check(sample_tables.orders(t), silver.ORDERS.gate)


@_register
def dq_ranges(t: SampleTables) -> DataFrame:
    sellers = quality.check(sample_tables.sellers(t), silver.SELLERS.gate, "bronze_sellers")
    weather = quality.check(sample_tables.weather(t), silver.WEATHER.gate, "bronze_weather")
    rates = quality.check(sample_tables.fx_rates(t), silver.FX_RATES.gate, "bronze_fx_rates")
    return sellers.unionByName(weather).unionByName(rates)


@_register
def dq_required(t: SampleTables) -> DataFrame:
    """Part types that must occur, but do not."""
    expected = literal_table(
        t.spark, "p_type", [(c,) for c in sample_tables.CATEGORIES + ["LUXURY", "REFURBISHED"]]
    )
    return quality.missing_values(t.read("part"), "p_type", expected)


@_register
def dq_unique(t: SampleTables) -> DataFrame:
    """Line numbers that an order uses more than once."""
    return merge.duplicate_keys(t.read("lineitem"), ["l_orderkey", "l_linenumber"])


@_register
def dq_gold(t: SampleTables) -> DataFrame:
    """The table tests on all models."""
    models = {
        "dim_date": dim_date(t),
        "dim_product": dim_product(t),
        "dim_user": dim_user(t),
        "dim_currency": dim_currency(t),
        "fact_orders": fact_orders(t),
        "fact_daily_sales": fact_daily_sales(t),
    }
    checks = [quality.check(df, gold.TABLE_TESTS[name], name) for name, df in models.items()]
    report = checks[0]
    for more in checks[1:]:
        report = report.unionByName(more)
    return report


# --- expressions -------------------------------------------------------------------


@_register
def name_and_email(t: SampleTables) -> DataFrame:
    people = sample_tables.users(t).withColumn("_name", plain_name(F.col("name")))
    parts = {**name_parts(F.col("_name")), **email_parts(F.col("email"))}
    return people.select("user_id", "run_id", "name", *[c.alias(n) for n, c in parts.items()])


@_register
def contact_clean(t: SampleTables) -> DataFrame:
    people = sample_tables.users(t).select("user_id", "run_id", "phone")
    bare = people.withColumn("_bare", without_extension(F.col("phone")))
    parts = phone_parts(F.col("_bare"))
    return bare.select(
        "user_id", "run_id", F.col("_bare").alias("phone_without_extension"),
        *[c.alias(n) for n, c in parts.items()],
    )


@_register
def bands(t: SampleTables) -> DataFrame:
    """Customers per spend segment, age segment and balance text."""
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    banded = t.read("customer").select(
        band(balance, *fixed.SPEND_SEGMENT).alias("spend_segment"),
        band(F.when(k % 7 != 0, k % 1500), *fixed.ACCOUNT_AGE_SEGMENT).alias("age_segment"),
        (balance > 0).alias("in_credit"),
        blank_to_null(F.when(k % 4 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment"))).alias("segment"),
    )
    return banded.groupBy("spend_segment", "age_segment", "in_credit", "segment").agg(
        F.count(F.lit(1)).alias("customers")
    )


@_register
def date_parts(t: SampleTables) -> DataFrame:
    orders = t.read("orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("date"),
        days_between(F.lit(RUN.as_of), F.col("o_orderdate")).alias("age_days"),
    )
    return orders.select("*", *[c.alias(n) for n, c in calendar_parts(F.col("date")).items()])


@_register
def millis_rounding(t: SampleTables) -> DataFrame:
    ts = F.col("ts")
    return t.read("events").select(
        "event_id", round_to_millis(ts).alias("ts_millis"), business_date(ts).alias("business_date")
    )


@_register
def utc_text(t: SampleTables) -> DataFrame:
    """Timestamps written with different offsets, and some that are none."""
    e, ts = F.col("event_id"), F.col("ts")
    offset = F.element_at(
        F.array(F.lit("+05:30"), F.lit("Z"), F.lit("-08:00"), F.lit("")), (e % 4).cast("int") + 1
    )
    text = F.when(e % 50 == 0, F.lit("not a time")).otherwise(
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)
    )
    return t.read("events").select("event_id", utc_from_text(text).alias("utc"))


# --- order lines ---------------------------------------------------------------------


@_register
def order_rollup(t: SampleTables) -> DataFrame:
    return line_ops.order_rollup(sample_tables.lines(t))


@_register
def top_seller_per_order(t: SampleTables) -> DataFrame:
    lines = sample_tables.lines(t)
    return line_ops.top_by(lines, ["order_id"], "net_cents", "seller_id", "top_seller_id")


@_register
def top_category_per_order(t: SampleTables) -> DataFrame:
    totals = line_ops.category_totals(sample_tables.lines(t))
    return line_ops.top_by(totals, ["order_id"], "quantity", "category", "top_category")


@_register
def json_items_roundtrip(t: SampleTables) -> DataFrame:
    """Every line as a JSON array of items of at most ten units, parsed back, priced and summed per order and place."""
    item = t.read("lineitem")
    units = F.col("l_quantity").cast("int")

    def packed(at: Column) -> Column:
        return F.struct(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            round_half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
            F.least(F.lit(10), units - at * 10).alias("quantity"),
            (F.col("l_discount") * 100).cast("decimal(5,1)").alias("discount_pct"),
        )

    document = F.to_json(F.transform(F.sequence(F.lit(0), ((units - 1) / 10).cast("int")), packed))
    documents = item.select(
        F.col("l_orderkey").cast("string").alias("order_id"), document.alias("products_json")
    )
    parsed = line_ops.line_items(documents)
    priced = parsed.withColumns(
        line_ops.line_amounts(F.col("unit_price"), F.col("quantity"), F.col("discount_pct"))
    )
    return priced.groupBy("order_id", "position").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("quantity").alias("quantity"),
        exact_sum(F.col("line_gross_total")).alias("gross_total"),
        exact_sum(F.col("line_net_total")).alias("net_total"),
    )


@_register
def reconcile_orders(t: SampleTables) -> DataFrame:
    return line_ops.reconcile(sample_tables.orders(t))


@_register
def price_stock_flags(t: SampleTables) -> DataFrame:
    rows = [(c, low, high) for c, (low, high) in fixed.STOCK_RANGES.items()]
    ranges = literal_table(t.spark, "retail_category, least, most", rows)
    products = sample_tables.products(t).select(
        "product_id", "run_id", "category", "current_price", "discount_pct", "stock_quantity"
    )
    ranged = _retail_category(products, "category").join(F.broadcast(ranges), "retail_category", "left")
    price = line_ops.line_amounts(F.col("current_price"), F.lit(1), F.col("discount_pct"))
    low = line_ops.low_stock(
        F.col("stock_quantity"), F.col("least"), F.col("most"), fixed.LOW_STOCK_SHARE
    )
    return ranged.select(
        "product_id", "run_id", "retail_category",
        price["final_unit_price"].alias("final_price"), low.alias("is_low_stock"),
    )


# --- clean tables ----------------------------------------------------------------------


@_register
def silver_products(t: SampleTables) -> DataFrame:
    return silver.products(sample_tables.products(t), RUN)


@_register
def silver_users(t: SampleTables) -> DataFrame:
    return silver.users(sample_tables.users(t), RUN)


@_register
def silver_orders(t: SampleTables) -> DataFrame:
    return silver.orders(sample_tables.orders(t), RUN)


@_register
def silver_sellers(t: SampleTables) -> DataFrame:
    return silver.sellers(sample_tables.sellers(t), RUN)


@_register
def silver_fx_rates(t: SampleTables) -> DataFrame:
    return silver.fx_rates(sample_tables.fx_rates(t), RUN)


@_register
def silver_weather(t: SampleTables) -> DataFrame:
    return silver.weather(sample_tables.weather(t), RUN)


# --- star schema -------------------------------------------------------------------------


@_register
def dim_currency(t: SampleTables) -> DataFrame:
    return gold.currency_dim(silver_fx_rates(t))


@_register
def dim_date(t: SampleTables) -> DataFrame:
    return gold.date_dim(silver_orders(t).select("ordered_at"), RUN.as_of)


@_register
def dim_product(t: SampleTables) -> DataFrame:
    return gold.product_dim(silver_products(t))


@_register
def dim_seller(t: SampleTables) -> DataFrame:
    return gold.seller_dim(silver_sellers(t))


@_register
def dim_user(t: SampleTables) -> DataFrame:
    return gold.user_dim(silver_users(t))


@_register
def fact_orders(t: SampleTables) -> DataFrame:
    dims = gold.Dimensions(dim_user(t), dim_date(t), dim_currency(t), dim_seller(t), dim_product(t))
    feed = sample_tables.orders(t, dealt_by_id=True)
    return gold.fact_orders(silver.orders(feed, RUN), dims)


@_register
def fact_daily_sales(t: SampleTables) -> DataFrame:
    return gold.daily_sales(fact_orders(t))


# --- reports -----------------------------------------------------------------------------

_REPORTS: dict[str, tuple[Callable, Callable]] = {
    "report_daily_revenue": (reports.daily_revenue, fact_daily_sales),
    "report_revenue_by_category": (reports.revenue_by_category, fact_daily_sales),
    "report_revenue_by_channel": (reports.revenue_by_channel, fact_daily_sales),
    "report_revenue_by_country": (reports.revenue_by_country, fact_daily_sales),
    "report_orders_by_tier": (reports.orders_by_tier, fact_orders),
    "report_spend_segments": (reports.spend_segments, dim_user),
    "report_top_sellers": (reports.top_sellers, fact_orders),
    "report_tier_commission": (reports.tier_commission, dim_seller),
    "report_status_breakdown": (reports.status_breakdown, fact_orders),
    "report_discount_trend": (reports.discount_trend, fact_daily_sales),
    "report_weekend_volume": (reports.weekend_volume, fact_daily_sales),
    "report_commission_by_category": (reports.commission_by_category, fact_daily_sales),
}

for _name, (_report, _source) in _REPORTS.items():
    _QUERIES[_name] = lambda t, report=_report, source=_source: report(source(t))
