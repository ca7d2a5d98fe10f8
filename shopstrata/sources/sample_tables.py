"""The retail feeds, derived from a TPC-H-like set of Parquet tables.

Used by the registered queries and the benchmark: whole tables in, whole feeds
out. Formulas are integer arithmetic on keys, so that any SQL engine can repeat
them. Lookups by key carry no broadcast hint: the optimizer broadcasts them
while they are small and shuffles them when they are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopstrata import fixed_values as fixed
from shopstrata.functions.money import cents, from_cents, round_half_up
from shopstrata.operators.lines import order_rollup
from shopstrata.sources.literals import literal_array
from shopstrata.sources.payloads import cities

AS_OF = "2024-01-31"
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
WEATHER_CODE_CYCLE = [0, 3, 45, 61, 7, 95]  # 7 is not a known code
QUOTED_CODES = fixed.TARGET_CURRENCIES + ["XAU", "TRY", "SEK"]  # the last three are not kept


class SampleTables:
    """Readers for one folder of tables."""

    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """The whole table. Its file footer is looked at once per process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)


def _pick(key: Column, values: Sequence[str], every: int = 1) -> Column:
    """values[(key / every) mod n]; the list becomes a constant array."""
    index = F.floor(key / every) if every > 1 else key
    return F.element_at(literal_array(values), (index % len(values)).cast("int") + 1)


def _padded(number: Column, width: int) -> Column:
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _lineage(dataset: str, run_id: Column, at: Column) -> list[Column]:
    return [
        F.lit(dataset).alias("dataset"),
        F.lit("sample").alias("source"),
        run_id.alias("run_id"),
        at.alias("ingested_at"),
        F.to_date(at).alias("ingestion_date"),
    ]


def _run(key: Column) -> Column:
    return F.concat(F.lit("r"), (key % 3).cast("string"))


def _snapshots(df: DataFrame, key: str, count: int) -> DataFrame:
    """Each row once per snapshot 0..count-1, as a feed that repeats its catalogue does.

    The narrow rows are dealt out by their key first: a file of a few MB is read by one task, but its
    rows times the snapshots are hundreds of MB where a task sorts them.
    """
    return df.repartition(key).withColumn("snapshot", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def _snapshot_time(minutes: int) -> Column:
    start = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(mins=F.col("snapshot") * minutes)


def lines(tables: SampleTables) -> DataFrame:
    """Order lines with the category of their part and amounts in cents."""
    gross = cents(F.col("l_extendedprice"))
    kept_pct = 100 - cents(F.col("l_discount"))
    item = tables.read("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        gross.alias("gross_cents"),
        # Half up, in integers.
        F.floor((gross * kept_pct + 50) / 100).alias("net_cents"),
        F.col("l_shipdate").alias("shipped_at"),
    )
    part = tables.read("part").select("p_partkey", F.col("p_type").alias("category"))
    return item.join(part, item["l_partkey"] == part["p_partkey"], "inner").drop(
        "l_partkey", "p_partkey"
    )


def _category_item() -> Column:
    """JSON record of one (order, category); there are only a handful of categories."""
    return F.collect_list(
        F.struct(
            "category",
            "quantity",
            from_cents(F.col("gross_cents")).alias("line_gross_total"),
            from_cents(F.col("net_cents")).alias("line_net_total"),
        )
    )


def _ordered_at() -> Column:
    k = F.col("o_orderkey")
    seconds = (k * 7919 % 86400) + (k % 10000).cast("decimal(18,6)") / 10000
    return F.col("o_orderdate") + F.make_dt_interval(secs=seconds)


def order_times(tables: SampleTables) -> DataFrame:
    """Only the order times of bronze_orders, without touching the lines."""
    return tables.read("orders").select(_ordered_at().alias("ordered_at"))


def orders(tables: SampleTables, dealt_by_id: bool = False) -> DataFrame:
    """bronze_orders: order headers with the roll-up of their lines.

    With ``dealt_by_id`` lines and headers meet on the feed's text id instead of the number it is made of. The
    rows are the same, and where that join shuffles, a dedup by the id need not shuffle the wide rows again.
    """
    k = F.col("o_orderkey")
    items, headers, on = lines(tables), tables.read("orders"), "o_orderkey"
    if dealt_by_id:
        items = items.withColumn("order_id", F.col("order_id").cast("string"))
        headers, on = headers.withColumn("order_id", k.cast("string")), "order_id"
    rollup = order_rollup(
        items,
        carry={
            "last_shipped_at": (F.max("shipped_at"), F.max("last_shipped_at")),
            "products_json": (None, F.to_json(F.sort_array(_category_item()))),
        },
    ).withColumnRenamed("order_id", on)
    net = F.coalesce("net_total", F.lit(0.0))
    rate = (50 + k % 131) / F.lit(1000.0)
    joined = headers.join(rollup, on, "left")
    return joined.select(
        F.col(on).cast("string").alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        _pick(k, fixed.ORDER_STATUSES).alias("order_status"),
        _pick(k, fixed.ORDER_CHANNELS, 8).alias("channel"),
        _pick(k, fixed.PAYMENT_METHODS).alias("payment_method"),
        _pick(k, fixed.ORDER_CURRENCIES, 32).alias("currency"),
        _ordered_at().alias("ordered_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("last_shipped_at")).alias("estimated_delivery_at"),
        F.coalesce("gross_total", F.lit(0.0)).alias("gross_total"),
        F.coalesce("discount_total", F.lit(0.0)).alias("discount_total"),
        net.alias("net_total"),
        ((k % 1000) / F.lit(100.0)).alias("shipping_cost"),
        rate.alias("tax_rate"),
        round_half_up(net * rate, 2).alias("tax_amount"),
        round_half_up(F.col("o_totalprice") / 100, 2).alias("order_total"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"),
        "top_category",
        "top_seller_id",
        "products_json",
        (k % 14 == 0).alias("is_gift"),
        (k % 6 == 0).alias("promo_code_used"),
        *_lineage("bronze_orders", _run(k), F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")),
    )


def users(tables: SampleTables) -> DataFrame:
    """bronze_users: two daily snapshots of the customer list."""
    nation = tables.read("nation").select("n_nationkey", "n_name")
    customer = tables.read("customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    k, s = F.col("c_custkey"), F.col("snapshot")
    segment, place = F.lower("c_mktsegment"), F.translate(F.lower("n_name"), "_", "-")
    digits = _padded(k, 7)
    phone = (
        F.when(k % 4 == 0, F.concat(F.lit("+1-555-"), digits, F.lit("x"), (k % 1000).cast("string")))
        .when(k % 4 == 1, F.concat(F.lit("001-555-"), digits))
        .when(k % 4 == 2, F.concat(F.lit("(555)"), digits, F.lit(" ext. "), (k % 100).cast("string")))
        .otherwise(F.concat(F.lit("+44"), digits))
    )
    email = F.when(k % 10 == 0, F.concat(segment, k.cast("string"))).otherwise(
        F.concat(segment, k.cast("string"), F.lit("@"), place, F.lit(".com"))
    )
    midnight = F.lit(AS_OF).cast("timestamp_ntz")
    return _snapshots(customer, "c_custkey", 2).select(
        k.cast("int").alias("user_id"),
        F.concat(
            _pick(k, ["Dr. ", "Mrs. ", "", "Sir "]),
            F.col("c_mktsegment"), F.lit(" "), F.col("n_name"),
            _pick(k, ["", " Jr.", " PhD"]),
        ).alias("name"),
        email.alias("email"),
        phone.alias("phone"),
        _pick(k, fixed.GENDERS).alias("gender"),
        F.concat_ws(
            "-", (1960 + k % 44).cast("string"), _padded(1 + k % 12, 2), _padded(1 + k % 28, 2)
        ).alias("date_of_birth"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), (k % 97).cast("string")).alias("city"),
        F.concat((1 + k % 999).cast("string"), F.lit(" Main Street")).alias("address_line"),
        _padded(k % 100000, 5).alias("postal_code"),
        (midnight - F.make_dt_interval(days=(k % 1500).cast("int"))).alias("created_at"),
        _pick(k, CATEGORIES).alias("preferred_category"),
        (k % 3 != 0).alias("marketing_opt_in"),
        F.when(k % 20 == 0, F.lit(fixed.SUSPENDED))
        .when(k % 20 == 1, F.lit("inactive"))
        .otherwise(F.lit("active"))
        .alias("account_status"),
        _pick(k, fixed.CUSTOMER_TIERS).alias("customer_tier"),
        (midnight - F.make_dt_interval(days=(k % 90).cast("int"))).alias("last_login_at"),
        (k % 500 + s).cast("int").alias("session_count"),
        F.col("c_acctbal").alias("lifetime_spend_usd"),
        ((k + s) % 13).cast("int").alias("cart_item_count"),
        (k % 31).cast("int").alias("wishlist_item_count"),
        (k % 10 != 0).alias("is_verified"),
        *_lineage("bronze_users", F.concat(F.lit("u"), s.cast("string")), _snapshot_time(1440)),
    )


def sellers(tables: SampleTables) -> DataFrame:
    """bronze_sellers: two daily snapshots of the supplier list."""
    nation = tables.read("nation").select("n_nationkey", "n_name")
    supplier = tables.read("supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    k, s = F.col("s_suppkey"), F.col("snapshot")
    joined = F.lit(AS_OF).cast("date") - (90 + k % 1700).cast("int")
    return _snapshots(supplier, "s_suppkey", 2).select(
        k.cast("int").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.concat(F.lit("shop"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), (k % 97).cast("string")).alias("city"),
        _pick(k, CATEGORIES).alias("category_specialisation"),
        ((5 + k % 9) / F.lit(100.0)).alias("commission_rate"),
        F.concat(joined.cast("string"), F.lit("T00:00:00+00:00")).alias("joined_at"),
        ((30 + k % 21) / F.lit(10.0)).alias("seller_rating"),
        (10 + k % 5000 + s).cast("int").alias("total_reviews"),
        (k % 7 != 0).alias("is_verified"),
        F.when(k % 20 == 0, F.lit(fixed.SUSPENDED))
        .when(k % 20 == 3, F.lit("under_review"))
        .otherwise(F.lit("active"))
        .alias("account_status"),
        (5 + k % 496).cast("int").alias("total_products_listed"),
        ((600 + k * 7 % 401) / F.lit(10.0)).alias("fulfillment_score"),
        *_lineage("bronze_sellers", F.concat(F.lit("s"), s.cast("string")), _snapshot_time(1440)),
    )


def products(tables: SampleTables) -> DataFrame:
    """bronze_products: four quarter-hour snapshots of the part list."""
    k, s = F.col("p_partkey"), F.col("snapshot")
    base = (k * 37 % 60000) / F.lit(100.0)
    current = round_half_up(base * (90 + (k + s) % 21) / 100, 2)
    pct = F.when(k % 5 == 0, (5 + k % 36).cast("double")).otherwise(F.lit(0.0))
    return _snapshots(tables.read("part"), "p_partkey", 4).select(
        k.cast("int").alias("product_id"),
        (k % 1000).cast("int").alias("seller_id"),
        F.concat(F.lit("SKU-"), _padded(k, 5)).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", F.col("p_type"), F.lit("line"), (k % 8).cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        base.alias("base_price"),
        ((1 + k % 200) / F.lit(10.0)).alias("weight_kg"),
        (k % 20 != 0).alias("is_active"),
        current.alias("current_price"),
        (k % 5 == 0).alias("discount_active"),
        pct.alias("discount_pct"),
        round_half_up(current * (1 - pct / 100), 2).alias("final_price"),
        F.col("p_size").cast("int").alias("stock_quantity"),
        (F.col("p_size") < 5).alias("is_low_stock"),
        ((25 + k % 26) / F.lit(10.0)).alias("rating"),
        (k % 5001).cast("int").alias("review_count"),
        ((k + s) % 121).cast("int").alias("orders_last_15min"),
        *_lineage("bronze_products", F.concat(F.lit("p"), s.cast("string")), _snapshot_time(15)),
    )


def fx_rates(tables: SampleTables) -> DataFrame:
    """bronze_fx_rates: every event is one quote of a currency at its time."""
    e, ts = F.col("event_id"), F.col("ts")
    code = _pick(F.col("user_id"), fixed.TARGET_CURRENCIES)
    return tables.read("events").select(
        F.lit(fixed.BASE_CURRENCY).alias("base_currency"),
        code.alias("target_currency"),
        ((50 + (e * 7 + F.col("user_id")) % 100).cast("double") / 50).alias("exchange_rate"),
        F.date_format(ts, "yyyy-MM-dd HH:mm").alias("rate_date_utc"),
        e.cast("bigint").alias("rate_unix"),
        F.date_format(ts + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm").alias("next_update_utc"),
        F.concat_ws("/", F.lit(fixed.BASE_CURRENCY), code).alias("pair"),
        *_lineage("bronze_fx_rates", _run(e), ts),
    )


def weather(tables: SampleTables) -> DataFrame:
    """bronze_weather: every event is one observation of a city."""
    e, value = F.col("event_id"), F.col("value")
    events = tables.read("events").withColumn(
        "position", (F.col("user_id") % len(fixed.CITIES)).cast("int")
    )
    located = events.join(F.broadcast(cities(tables.spark)), "position", "left")
    return located.select(
        "city", "country", "lat", "lon",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("observation_time"),
        (value - 90).alias("temperature_c"),
        (value - 91).alias("feels_like_c"),
        (e % 105).cast("double").alias("humidity_pct"),
        ((e % 40) / F.lit(10.0)).alias("precipitation_mm"),
        ((e % 30) / F.lit(10.0)).alias("rain_mm"),
        _pick(e, WEATHER_CODE_CYCLE).alias("weather_code"),
        F.concat(F.lit("sky "), (e % 6).cast("string")).alias("weather_description"),
        (e % 90).cast("double").alias("wind_speed_kmh"),
        (e % 360).cast("double").alias("wind_direction_deg"),
        (980 + e % 60).cast("double").alias("surface_pressure_hpa"),
        (e % 101).cast("double").alias("cloud_cover_pct"),
        (e * 10 % 24000).cast("double").alias("visibility_m"),
        (e % 2 == 0).alias("is_day"),
        F.lit("UTC").alias("timezone"),
        *_lineage("bronze_weather", F.concat(F.lit("w"), e.cast("string")), F.col("ts")),
    )


def rate_documents(tables: SampleTables) -> DataFrame:
    """One rates document per event, quoting four currencies; some failed, some null rates."""
    e, u = F.col("event_id"), F.col("user_id")
    codes = literal_array(QUOTED_CODES)
    rates = F.map_from_entries(
        F.transform(
            F.sequence(F.lit(0), F.lit(3)),
            lambda i: F.struct(
                F.element_at(codes, ((u + i) % len(QUOTED_CODES)).cast("int") + 1),
                F.when((e + i) % 11 != 0, (1 + (e + i) % 400).cast("double") / 100),
            ),
        )
    )
    payload = F.to_json(
        F.struct(
            F.when(e % 50 == 0, F.lit("error")).otherwise(F.lit("success")).alias("result"),
            rates.alias("conversion_rates"),
            F.date_format("ts", "yyyy-MM-dd").alias("time_last_update_utc"),
            e.alias("time_last_update_unix"),
            F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd").alias("time_next_update_utc"),
        ),
        {"ignoreNullFields": "false"},
    )
    return tables.read("events").select(e.alias("document_id"), payload.alias("payload"))


def weather_documents(tables: SampleTables) -> DataFrame:
    """One weather answer per event for 1 to 12 places, with absent and null fields."""
    e, v = F.col("event_id"), F.col("value")

    def place(i: Column) -> Column:
        n = e + i
        code = _pick(n, WEATHER_CODE_CYCLE).cast("string")
        fields = F.concat_ws(
            ",",
            F.concat(F.lit('"time":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.lit('"')),
            F.concat(F.lit('"temperature_2m":'), (v + i).cast("decimal(12,2)").cast("string")),
            F.concat(F.lit('"relative_humidity_2m":'), (n % 100).cast("string")),
            F.when(n % 4 == 1, F.lit('"weather_code":null')).when(
                n % 4 != 0, F.concat(F.lit('"weather_code":'), code)
            ),
            F.when(n % 5 == 1, F.lit('"is_day":null')).when(
                n % 5 != 0, F.concat(F.lit('"is_day":'), (n % 2).cast("string"))
            ),
        )
        zone = F.when(n % 3 == 0, F.lit("")).otherwise(F.lit(',"timezone":"Asia/Tokyo"'))
        return F.concat(F.lit('{"current":{'), fields, F.lit("}"), zone, F.lit("}"))

    places = F.transform(F.sequence(F.lit(0), (e % 12).cast("int")), place)
    text = F.array_join(places, ",")
    payload = F.when(e % 12 == 0, text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return tables.read("events").select(e.alias("document_id"), payload.alias("payload"))


FEED_OF_EVENT = {
    "click": "bronze_orders",
    "view": "bronze_products",
    "purchase": "bronze_fx_rates",
    "signup": "bronze_users",
}


def feed_lines(tables: SampleTables) -> DataFrame:
    """Newline-JSON records of several datasets mixed; one kind is unknown, some are cut off."""
    e = F.col("event_id")
    dataset = F.lit("bronze_returns")
    for event_type, name in FEED_OF_EVENT.items():
        dataset = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(dataset)
    local = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    line = F.to_json(
        F.struct(
            dataset.alias("dataset"),
            e.cast("string").alias("order_id"),
            F.col("user_id").alias("user_id"),
            F.col("user_id").alias("product_id"),
            F.concat(F.lit("USD/"), e.cast("string")).alias("pair"),
            F.col("value").alias("exchange_rate"),
            F.col("value").alias("order_total"),
            local.alias("ordered_at"),
            F.lit("sample").alias("source"),
            _run(e).alias("run_id"),
            local.alias("ingested_at"),
            F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
        )
    )
    cut = F.when(e % 37 == 0, F.expr("left(_line, length(_line) - 5)")).otherwise(F.col("_line"))
    return tables.read("events").withColumn("_line", line).select(cut.alias("value"))
