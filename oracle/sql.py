"""One SQL text per registered query, over the same tables.

The texts are put together from named views. ``_compose`` adds the views a text
mentions (and the ones those mention) as common table expressions.
"""

from __future__ import annotations

import re

from shopstrata import fixed_values as fixed
from shopstrata.sources.sample_tables import CATEGORIES, QUOTED_CODES, WEATHER_CODE_CYCLE


def _r(expression: str, digits: int) -> str:
    """Half-up rounding of a DOUBLE (rounding one directly differs between engines on ties)."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def _exact(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _nth(values, key: str, every: int = 1) -> str:
    index = f"({key}) // {every}" if every > 1 else f"({key})"
    return f"{_list(values)}[1 + ({index}) % {len(values)}]"


def _values(rows, columns: str, name: str) -> str:
    def literal(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v!r}e0" if isinstance(v, float) else repr(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS {name}({columns})"


def _band(value: str, bands, op: str = "<") -> str:
    edges, labels, otherwise = bands
    cases = " ".join(f"WHEN {value} {op} {e} THEN '{n}'" for e, n in zip(edges, labels))
    return f"CASE {cases} ELSE '{otherwise}' END"


def _lineage(dataset: str, run_id: str, at: str) -> str:
    return (
        f"'{dataset}' AS dataset, 'sample' AS source, {run_id} AS run_id,"
        f" {at} AS ingested_at, CAST({at} AS DATE) AS ingestion_date"
    )


_CLEAN = (
    "run_id AS last_run_id, 'run-1' AS run_id, TIMESTAMP '2024-01-31 02:00:00' AS run_timestamp,"
    " ingestion_date AS silver_processed_date"
)
_FEED_COLUMNS = "dataset, source, run_id, ingested_at, ingestion_date"
_AS_OF = "DATE '2024-01-31'"
_MILLIS = "date_trunc('millisecond', {0} + INTERVAL 500 MICROSECOND)"
_PAD7 = "lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(7, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')"
_REPLACE = "regexp_replace({0}, '{1}', '', 'g')"


def _strip(text: str, pattern: str) -> str:
    return _REPLACE.format(text, pattern)


VIEWS = {
    "retail": _values(
        [("ECONOMY", "Groceries"), ("LARGE", "Home"), ("MEDIUM", "Electronics"),
         ("PROMO", "Clothing"), ("SMALL", "Books")],
        "part_type, retail_category", "r",
    ),
    "commission": _values(fixed.COMMISSION_RATES.items(), "retail_category, list_rate", "c"),
    "stock_range": _values(
        [(c, lo, hi) for c, (lo, hi) in fixed.STOCK_RANGES.items()],
        "retail_category, least, most", "s",
    ),
    "wmo": _values(fixed.WEATHER_CODES, "code, description", "w"),
    "place": _values([(i, *c) for i, c in enumerate(fixed.CITIES)], "position, city, country, lat, lon", "p"),
    "lines": f"""
        SELECT l_orderkey AS order_id, p_type AS category, l_suppkey AS seller_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
               CAST(round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6)), 2) AS DECIMAL(18,2)) AS net,
               l_shipdate AS shipped_at
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "line_categories": """
        SELECT order_id, category, sum(quantity) AS quantity, sum(gross) AS gross, sum(net) AS net
        FROM lines GROUP BY order_id, category""",
    "best_seller": """
        SELECT order_id, seller_id FROM lines
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY net DESC, seller_id) = 1""",
    "best_category": """
        SELECT order_id, category FROM line_categories
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY quantity DESC, category) = 1""",
    "line_totals": f"""
        SELECT order_id, CAST(count(*) AS INTEGER) AS item_count,
               CAST(sum(quantity) AS INTEGER) AS total_quantity,
               {_exact('gross')} AS gross_total, {_exact('net')} AS net_total,
               CAST(sum(gross) - sum(net) AS DOUBLE) AS discount_total,
               max(shipped_at) AS last_shipped_at
        FROM lines GROUP BY order_id""",
    "order_texts": """
        SELECT order_id, '[' || string_agg('{"category":"' || category || '","quantity":' || quantity
               || ',"line_gross_total":' || CAST(gross AS DOUBLE) || ',"line_net_total":' || CAST(net AS DOUBLE) || '}', ',' ORDER BY category)
               || ']' AS products_json
        FROM line_categories GROUP BY order_id""",
    "rollup_of_lines": """
        SELECT order_id, item_count, total_quantity, gross_total, discount_total, net_total,
               CAST(seller_id AS INTEGER) AS top_seller_id, category AS top_category
        FROM line_totals JOIN best_seller USING (order_id) JOIN best_category USING (order_id)""",
    "feed_orders": f"""
        SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS user_id,
               {_nth(fixed.ORDER_STATUSES, 'k')} AS order_status,
               {_nth(fixed.ORDER_CHANNELS, 'k', 8)} AS channel,
               {_nth(fixed.PAYMENT_METHODS, 'k')} AS payment_method,
               {_nth(fixed.ORDER_CURRENCIES, 'k', 32)} AS currency,
               o_orderdate + to_microseconds((k * 7919 % 86400) * 1000000 + (k % 10000) * 100) AS ordered_at,
               CASE WHEN o_orderstatus <> 'P' THEN last_shipped_at END AS estimated_delivery_at,
               coalesce(gross_total, 0) AS gross_total, coalesce(discount_total, 0) AS discount_total,
               coalesce(net_total, 0) AS net_total, (k % 1000) / 100e0 AS shipping_cost,
               (50 + k % 131) / 1000e0 AS tax_rate,
               {_r('coalesce(net_total, 0) * ((50 + k % 131) / 1000e0)', 2)} AS tax_amount,
               {_r('o_totalprice / 100', 2)} AS order_total,
               coalesce(item_count, 0) AS item_count, coalesce(total_quantity, 0) AS total_quantity,
               top_category, top_seller_id, products_json,
               k % 14 = 0 AS is_gift, k % 6 = 0 AS promo_code_used,
               {_lineage('bronze_orders', "'r' || (k % 3)", "o_orderdate + INTERVAL 1 DAY")}
        FROM (SELECT *, o_orderkey AS k FROM orders) AS o
        LEFT JOIN rollup_of_lines AS r ON r.order_id = k
        LEFT JOIN (SELECT order_id, last_shipped_at FROM line_totals) AS t ON t.order_id = k
        LEFT JOIN order_texts AS x ON x.order_id = k""",
    "feed_users": f"""
        SELECT CAST(k AS INTEGER) AS user_id,
               {_nth(['Dr. ', 'Mrs. ', '', 'Sir '], 'k')} || c_mktsegment || ' ' || n_name
                   || {_nth(['', ' Jr.', ' PhD'], 'k')} AS name,
               CASE WHEN k % 10 = 0 THEN lower(c_mktsegment) || k
                    ELSE lower(c_mktsegment) || k || '@' || replace(lower(n_name), '_', '-') || '.com' END AS email,
               CASE k % 4 WHEN 0 THEN '+1-555-' || {_PAD7} || 'x' || (k % 1000)
                    WHEN 1 THEN '001-555-' || {_PAD7}
                    WHEN 2 THEN '(555)' || {_PAD7} || ' ext. ' || (k % 100)
                    ELSE '+44' || {_PAD7} END AS phone,
               {_nth(fixed.GENDERS, 'k')} AS gender,
               (1960 + k % 44) || '-' || lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0') || '-'
                   || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') AS date_of_birth,
               n_name AS country, 'City ' || (k % 97) AS city,
               (1 + k % 999) || ' Main Street' AS address_line,
               lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS postal_code,
               TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST(k % 1500 AS INTEGER)) AS created_at,
               {_nth(CATEGORIES, 'k')} AS preferred_category, k % 3 <> 0 AS marketing_opt_in,
               CASE k % 20 WHEN 0 THEN 'suspended' WHEN 1 THEN 'inactive' ELSE 'active' END AS account_status,
               {_nth(fixed.CUSTOMER_TIERS, 'k')} AS customer_tier,
               TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST(k % 90 AS INTEGER)) AS last_login_at,
               CAST(k % 500 + s AS INTEGER) AS session_count, c_acctbal AS lifetime_spend_usd,
               CAST((k + s) % 13 AS INTEGER) AS cart_item_count,
               CAST(k % 31 AS INTEGER) AS wishlist_item_count, k % 10 <> 0 AS is_verified,
               {_lineage('bronze_users', "'u' || s", "TIMESTAMP '2024-01-30 00:00:00' + to_days(CAST(s AS INTEGER))")}
        FROM (SELECT *, c_custkey AS k, unnest(range(2)) AS s FROM customer) AS c
        LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "feed_sellers": f"""
        SELECT CAST(k AS INTEGER) AS seller_id, s_name AS seller_name,
               'shop' || k || '@example.com' AS email, n_name AS country, 'City ' || (k % 97) AS city,
               {_nth(CATEGORIES, 'k')} AS category_specialisation, (5 + k % 9) / 100e0 AS commission_rate,
               strftime({_AS_OF} - CAST(90 + k % 1700 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00' AS joined_at,
               (30 + k % 21) / 10e0 AS seller_rating, CAST(10 + k % 5000 + s AS INTEGER) AS total_reviews,
               k % 7 <> 0 AS is_verified,
               CASE k % 20 WHEN 0 THEN 'suspended' WHEN 3 THEN 'under_review' ELSE 'active' END AS account_status,
               CAST(5 + k % 496 AS INTEGER) AS total_products_listed,
               (600 + k * 7 % 401) / 10e0 AS fulfillment_score,
               {_lineage('bronze_sellers', "'s' || s", "TIMESTAMP '2024-01-30 00:00:00' + to_days(CAST(s AS INTEGER))")}
        FROM (SELECT *, s_suppkey AS k, unnest(range(2)) AS s FROM supplier) AS c
        LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "part_prices": f"""
        SELECT *, {_r('base_price * (90 + (k + s) % 21) / 100', 2)} AS current_price
        FROM (SELECT *, p_partkey AS k, unnest(range(4)) AS s, (p_partkey * 37 % 60000) / 100e0 AS base_price,
                     CASE WHEN p_partkey % 5 = 0 THEN CAST(5 + p_partkey % 36 AS DOUBLE) ELSE 0e0 END AS discount_pct
              FROM part) AS p""",
    "feed_products": f"""
        SELECT CAST(k AS INTEGER) AS product_id, CAST(k % 1000 AS INTEGER) AS seller_id,
               'SKU-' || lpad(CAST(k AS VARCHAR), CAST(greatest(5, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS sku,
               p_name AS name, p_type AS category, p_type || ' line ' || (k % 8) AS subcategory, p_brand AS brand,
               base_price, (1 + k % 200) / 10e0 AS weight_kg, k % 20 <> 0 AS is_active, current_price,
               k % 5 = 0 AS discount_active, discount_pct,
               {_r('current_price * (1 - discount_pct / 100)', 2)} AS final_price,
               CAST(p_size AS INTEGER) AS stock_quantity, p_size < 5 AS is_low_stock,
               (25 + k % 26) / 10e0 AS rating, CAST(k % 5001 AS INTEGER) AS review_count,
               CAST((k + s) % 121 AS INTEGER) AS orders_last_15min,
               {_lineage('bronze_products', "'p' || s", "TIMESTAMP '2024-01-30 00:00:00' + to_minutes(15 * s)")}
        FROM part_prices""",
    "feed_fx": f"""
        SELECT 'USD' AS base_currency, {_nth(fixed.TARGET_CURRENCIES, 'user_id')} AS target_currency,
               CAST(50 + (event_id * 7 + user_id) % 100 AS DOUBLE) / 50 AS exchange_rate,
               strftime(ts, '%Y-%m-%d %H:%M') AS rate_date_utc, event_id AS rate_unix,
               strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d %H:%M') AS next_update_utc,
               'USD/' || {_nth(fixed.TARGET_CURRENCIES, 'user_id')} AS pair,
               {_lineage('bronze_fx_rates', "'r' || (event_id % 3)", "ts")}
        FROM events""",
    "feed_weather": f"""
        SELECT city, country, lat, lon, strftime(ts, '%Y-%m-%dT%H:%M') AS observation_time,
               value - 90 AS temperature_c, value - 91 AS feels_like_c,
               CAST(e % 105 AS DOUBLE) AS humidity_pct, (e % 40) / 10e0 AS precipitation_mm,
               (e % 30) / 10e0 AS rain_mm, {_nth(WEATHER_CODE_CYCLE, 'e')} AS weather_code,
               'sky ' || (e % 6) AS weather_description, CAST(e % 90 AS DOUBLE) AS wind_speed_kmh,
               CAST(e % 360 AS DOUBLE) AS wind_direction_deg, CAST(980 + e % 60 AS DOUBLE) AS surface_pressure_hpa,
               CAST(e % 101 AS DOUBLE) AS cloud_cover_pct, CAST(e * 10 % 24000 AS DOUBLE) AS visibility_m,
               e % 2 = 0 AS is_day, 'UTC' AS timezone,
               {_lineage('bronze_weather', "'w' || e", "ts")}
        FROM (SELECT *, event_id AS e FROM events) AS v LEFT JOIN place ON position = user_id % 10""",
    "names": f"""
        SELECT * REPLACE (trim({_strip('trim(' + _strip('phone', fixed.X_EXTENSION) + ')', fixed.WORD_EXTENSION)}) AS phone),
               {_strip(_strip('trim(name)', fixed.HONORIFIC_PREFIX), fixed.NAME_SUFFIX)} AS clean_name
        FROM feed_users""",
    "clean_products": f"""
        SELECT * EXCLUDE ({_FEED_COLUMNS}, orders_last_15min),
               CASE WHEN base_price <> 0 THEN {_r('current_price / base_price', 4)} END AS price_vs_base,
               ingested_at AS last_updated_at, {_CLEAN}
        FROM feed_products
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingested_at DESC) = 1""",
    "clean_users": f"""
        SELECT * EXCLUDE ({_FEED_COLUMNS}, name, clean_name, email, phone),
               split_part(clean_name, ' ', 1) AS first_name,
               CASE WHEN contains(clean_name, ' ') THEN substr(clean_name, strpos(clean_name, ' ') + 1) END AS last_name,
               regexp_matches(email, '{fixed.EMAIL}') AS is_valid_email,
               CASE WHEN contains(email, '@') THEN lower(split_part(email, '@', 2)) END AS email_domain,
               '+' || nullif(regexp_extract(phone, '{fixed.COUNTRY_PREFIX}', 1), '') AS phone_country_code,
               regexp_matches(phone, '{fixed.COUNTRY_PREFIX}') AS has_country_code,
               {_strip(_strip('phone', fixed.PHONE_PREFIXES), fixed.EXTENSION_OR_PUNCTUATION)} AS phone_number_clean,
               CAST({_AS_OF} - CAST(created_at AS DATE) AS INTEGER) AS account_age_days,
               ingested_at AS last_updated_at, {_CLEAN}
        FROM names
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingested_at DESC) = 1""",
    "clean_sellers": f"""
        SELECT * EXCLUDE ({_FEED_COLUMNS}),
               {_band('seller_rating', fixed.SELLER_TIER, '>=')} AS seller_tier,
               CAST({_AS_OF} - CAST(left(joined_at, 10) AS DATE) AS INTEGER) AS account_age_days,
               ingested_at AS last_updated_at, {_CLEAN}
        FROM feed_sellers
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY ingested_at DESC) = 1""",
    "clean_orders": f"""
        SELECT * EXCLUDE ({_FEED_COLUMNS}),
               discount_total > 0 AS has_discount,
               {_band('order_total', fixed.ORDER_VALUE_BAND)} AS order_value_band,
               CAST(CAST(estimated_delivery_at AS DATE) - CAST(ordered_at AS DATE) AS INTEGER) AS days_to_delivery,
               {_CLEAN}
        FROM feed_orders
        QUALIFY row_number() OVER (PARTITION BY ingestion_date, order_id ORDER BY ingested_at DESC) = 1""",
    "clean_fx": f"""
        SELECT * EXCLUDE ({_FEED_COLUMNS}), {_CLEAN}
        FROM feed_fx
        QUALIFY row_number() OVER (PARTITION BY ingestion_date, pair ORDER BY ingested_at DESC) = 1""",
    "clean_weather": f"SELECT * EXCLUDE ({_FEED_COLUMNS}), {_CLEAN} FROM feed_weather",
    "currency_meta": _values(fixed.CURRENCIES, "code, currency_name, region, symbol", "m"),
    "currency_dim": """
        SELECT m.code AS currency_sk, m.code, m.currency_name, m.region, m.symbol,
               CAST(coalesce(f.rate, 1) AS DOUBLE) AS usd_exchange_rate, f.rate_date
        FROM currency_meta AS m LEFT JOIN (
            SELECT target_currency, arg_max(exchange_rate, silver_processed_date) AS rate,
                   max(silver_processed_date) AS rate_date
            FROM clean_fx GROUP BY target_currency) AS f ON f.target_currency = m.code""",
    "days": f"""
        SELECT CAST(unnest(range(first_day, {_AS_OF} + 1, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT CAST(min(ordered_at) AS DATE) AS first_day FROM feed_orders) AS b""",
    "date_dim": """
        SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_sk, date, strftime(date, '%Y-%m-%d') AS date_str,
               CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, strftime(date, '%b') AS month_name,
               CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(day(date) AS INTEGER) AS day_of_month,
               CAST(isodow(date) AS INTEGER) AS day_of_week, strftime(date, '%A') AS day_name,
               isodow(date) IN (6, 7) AS is_weekend, month(date) IN (11, 12) AS is_holiday_season,
               'Q' || quarter(date) || ' ' || year(date) AS quarter_label,
               strftime(date, '%b %Y') AS month_label
        FROM days""",
    "product_dim": f"""
        SELECT product_id AS product_sk, product_id, sku, name AS product_name, category, subcategory, brand,
               base_price, current_price, final_price, price_vs_base,
               {_band('base_price', fixed.PRICE_BAND)} AS price_band, is_active, discount_active, discount_pct,
               is_low_stock, rating, review_count, silver_processed_date
        FROM clean_products""",
    "seller_dim": f"""
        SELECT seller_id AS seller_sk, * EXCLUDE (last_updated_at, last_run_id, run_id, run_timestamp),
               {_band('fulfillment_score', fixed.FULFILLMENT_BAND, '>=')} AS fulfillment_band
        FROM clean_sellers WHERE account_status <> 'suspended'""",
    "user_dim": f"""
        SELECT user_id AS user_sk, user_id, first_name, last_name, email_domain, is_valid_email, gender, country,
               city, preferred_category, marketing_opt_in, account_status, customer_tier, lifetime_spend_usd,
               is_verified, session_count, account_age_days,
               {_band('account_age_days', fixed.ACCOUNT_AGE_SEGMENT)} AS account_age_segment,
               {_band('lifetime_spend_usd', fixed.SPEND_SEGMENT)} AS spend_segment, silver_processed_date
        FROM clean_users WHERE account_status <> 'suspended'""",
    "representative": """
        SELECT category, product_sk, price_band FROM product_dim
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY product_sk) = 1""",
    "timed_orders": f"""
        SELECT * REPLACE ({_MILLIS.format('ordered_at')} AS ordered_at,
                          {_MILLIS.format('estimated_delivery_at')} AS estimated_delivery_at)
        FROM clean_orders""",
    "order_fact": f"""
        SELECT o.order_id, coalesce(p.product_sk, -1) AS product_sk, coalesce(u.user_sk, -1) AS user_sk,
               coalesce(d.date_sk, -1) AS date_sk, coalesce(c.currency_sk, 'USD') AS currency_sk,
               coalesce(s.seller_sk, -1) AS top_seller_sk, o.order_status, o.channel, o.payment_method, o.currency,
               o.ordered_at, o.estimated_delivery_at, o.gross_total, o.discount_total, o.net_total, o.shipping_cost,
               o.tax_amount, o.order_total,
               {_r('o.order_total / coalesce(c.usd_exchange_rate, 1)', 2)} AS order_total_usd,
               {_r('o.net_total / coalesce(c.usd_exchange_rate, 1)', 2)} AS net_total_usd,
               o.item_count, o.total_quantity, o.top_category, o.top_seller_id, o.products_json, o.is_gift,
               o.promo_code_used, o.has_discount, o.order_value_band, o.days_to_delivery,
               p.category AS product_category, p.price_band AS product_price_band, u.customer_tier,
               u.country AS user_country, u.spend_segment, s.seller_name AS top_seller_name,
               s.category_specialisation AS seller_category, s.seller_tier, s.fulfillment_band, s.commission_rate,
               d.year AS order_year, d.month AS order_month, d.quarter AS order_quarter, d.is_weekend,
               o.silver_processed_date
        FROM timed_orders AS o
        LEFT JOIN user_dim AS u USING (user_id)
        LEFT JOIN date_dim AS d ON d.date = CAST(o.ordered_at AS DATE)
        LEFT JOIN currency_dim AS c ON c.code = o.currency
        LEFT JOIN seller_dim AS s ON s.seller_id = o.top_seller_id
        LEFT JOIN representative AS p ON p.category = o.top_category""",
    "daily_fact": f"""
        SELECT date_sk, CAST(ordered_at AS DATE) AS order_date, order_year, order_month, order_quarter,
               product_category AS category, channel, customer_tier, user_country, seller_tier, seller_category,
               count(order_id) AS total_orders, count(DISTINCT user_sk) AS unique_customers,
               count(DISTINCT top_seller_sk) AS unique_sellers, CAST(sum(item_count) AS BIGINT) AS total_items,
               CAST(sum(total_quantity) AS BIGINT) AS total_units, {_exact('order_total_usd')} AS revenue_usd,
               {_exact('net_total_usd')} AS net_revenue_usd,
               {_r(_exact('order_total_usd') + ' / count(order_total_usd)', 2)} AS avg_order_value_usd,
               max(order_total_usd) AS max_order_value_usd,
               CAST(round(sum(CAST(order_total_usd * commission_rate AS DECIMAL(28,12))), 2) AS DOUBLE) AS total_commission_usd,
               count(*) FILTER (has_discount) AS discounted_orders,
               {_r('count(*) FILTER (has_discount) * 100e0 / count(order_id)', 1)} AS discount_rate_pct,
               count(*) FILTER (order_value_band = 'low') AS low_value_orders,
               count(*) FILTER (order_value_band = 'medium') AS medium_value_orders,
               count(*) FILTER (order_value_band = 'high') AS high_value_orders,
               count(*) FILTER (order_value_band = 'premium') AS premium_value_orders,
               count(*) FILTER (is_gift) AS gift_orders, count(*) FILTER (promo_code_used) AS promo_orders,
               count(*) FILTER (order_status = 'delivered') AS delivered_orders,
               count(*) FILTER (order_status = 'cancelled') AS cancelled_orders,
               count(*) FILTER (order_status = 'returned') AS returned_orders,
               count(*) FILTER (order_status = 'refunded') AS refunded_orders, is_weekend
        FROM order_fact WHERE order_status NOT IN ('cancelled', 'refunded') GROUP BY ALL""",
    "last_settled": """
        SELECT * FROM orders WHERE o_orderstatus <> 'P'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "last_open": """
        SELECT * FROM orders WHERE o_orderstatus = 'P'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "line_documents": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_quantity AS INTEGER) AS quantity,
               {_r('l_extendedprice / l_quantity', 2)} AS unit_price,
               CAST(CAST(l_discount * 100 AS DECIMAL(5,1)) AS DOUBLE) AS discount_pct
        FROM lineitem""",
    "fed_lines": """
        SELECT event_id AS e, user_id, ts, value,
               CASE event_type WHEN 'click' THEN 'bronze_orders' WHEN 'view' THEN 'bronze_products'
                    WHEN 'purchase' THEN 'bronze_fx_rates' WHEN 'signup' THEN 'bronze_users'
                    ELSE 'bronze_returns' END AS dataset
        FROM events""",
}


def _gold_test(table: str, view: str, key: str, rest: tuple[str, ...] = ()) -> list[str]:
    return [
        f"SELECT '{table}' AS \"table\", '{c}_not_null' AS rule, count(*) FILTER ({c} IS NULL) AS failed_rows FROM {view}"
        for c in (key, *rest)
    ] + [
        f"SELECT '{table}', '{key}_unique', count(*) FROM (SELECT {key} FROM {view} WHERE {key} IS NOT NULL"
        f" GROUP BY {key} HAVING count(*) > 1) AS repeated"
    ]


def _missing(column: str, values, view: str) -> str:
    return f"SELECT count(*) FROM (SELECT unnest({_list(values)}) EXCEPT SELECT {column} FROM {view}) AS missing"


def _range_rule(table: str, column: str, low, high) -> str:
    return (
        f"SELECT 'bronze_{table}', '{column}_in_range',"
        f" count(*) FILTER ({column} IS NULL OR {column} < {low} OR {column} > {high}) FROM feed_{table}"
    )


_DATE_OF_ORDER = VIEWS["date_dim"].replace("FROM days", "FROM (SELECT *, CAST(o_orderdate AS DATE) AS date FROM orders) AS o")

QUERIES = {
    "scan_partition": """
        SELECT *, CAST(o_orderdate AS DATE) AS ingestion_date FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-14'""",
    "fx_flatten": f"""
        SELECT event_id AS document_id, 'USD' AS base_currency, code AS target_currency,
               (1 + (event_id + i) % 400) / 100e0 AS exchange_rate, strftime(ts, '%Y-%m-%d') AS rate_date_utc,
               event_id AS rate_unix, strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS next_update_utc,
               'USD/' || code AS pair
        FROM (SELECT *, {_nth(QUOTED_CODES, 'user_id + i')} AS code
              FROM (SELECT *, unnest(range(4)) AS i FROM events) AS quotes) AS q
        WHERE event_id % 50 <> 0 AND (event_id + i) % 11 <> 0 AND code NOT IN ('XAU', 'TRY', 'SEK')""",
    "weather_flatten": f"""
        SELECT document_id, city, country, lat, lon, observation_time, temperature_c, humidity_pct, weather_code,
               coalesce(description, 'Unknown') AS weather_description, is_day, timezone
        FROM (SELECT event_id AS document_id, i, strftime(ts, '%Y-%m-%dT%H:%M') AS observation_time,
                     CAST(CAST(value + i AS DECIMAL(12,2)) AS DOUBLE) AS temperature_c,
                     CAST(n % 100 AS DOUBLE) AS humidity_pct,
                     CASE WHEN n % 4 = 1 THEN NULL WHEN n % 4 = 0 THEN -1
                          ELSE {_nth(WEATHER_CODE_CYCLE, 'n')} END AS weather_code,
                     CASE WHEN n % 5 = 1 THEN FALSE WHEN n % 5 = 0 THEN TRUE ELSE n % 2 <> 0 END AS is_day,
                     CASE WHEN n % 3 = 0 THEN 'UTC' ELSE 'Asia/Tokyo' END AS timezone
              FROM (SELECT *, event_id + i AS n
                    FROM (SELECT *, unnest(range(event_id % 12 + 1)) AS i FROM events) AS x) AS y) AS z
        JOIN place ON position = i
        LEFT JOIN wmo ON code = weather_code""",
    "code_lookup": """
        SELECT weather_code, coalesce(description, 'Unknown') AS weather_description, count(*) AS observations
        FROM feed_weather LEFT JOIN wmo ON code = weather_code GROUP BY 1, 2""",
    "commission_lookup": """
        SELECT seller_id, run_id, coalesce(retail_category, 'Other') AS retail_category,
               CAST(coalesce(list_rate, 0.10) AS DOUBLE) AS commission_rate
        FROM feed_sellers LEFT JOIN retail ON part_type = category_specialisation
        LEFT JOIN commission USING (retail_category)""",
    "route_counts": """
        SELECT CASE WHEN e % 37 <> 0 THEN dataset END AS dataset,
               CASE WHEN e % 37 = 0 THEN 'malformed' WHEN dataset = 'bronze_returns' THEN 'unknown dataset'
                    ELSE 'landed' END AS outcome, count(*) AS rows
        FROM fed_lines GROUP BY 1, 2""",
    "typed_decode": """
        SELECT CAST(e AS VARCHAR) AS order_id, CAST(user_id AS INTEGER) AS user_id,
               ts - INTERVAL 330 MINUTE AS ordered_at, CAST(NULL AS TIMESTAMP) AS estimated_delivery_at,
               value AS order_total, 'r' || (e % 3) AS run_id, ts - INTERVAL 330 MINUTE AS ingested_at,
               CAST(ts AS DATE) AS ingestion_date
        FROM fed_lines WHERE dataset = 'bronze_orders' AND e % 37 <> 0""",
    "ingestion_stamp": """
        SELECT s_suppkey AS seller_id, 'bronze_sellers' AS dataset, 'catalogue' AS source, 'run-1' AS run_id,
               TIMESTAMP '2024-01-31 02:00:00' AS ingested_at, DATE '2024-01-31' AS ingestion_date
        FROM supplier""",
    "dedup_latest": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""",
    "first_per_category": """
        SELECT p_type, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_type""",
    "upsert_scd1": """
        SELECT * FROM last_open
        UNION ALL
        SELECT * FROM last_settled WHERE o_custkey NOT IN (SELECT o_custkey FROM last_open)""",
    "upsert_newer_only": """
        SELECT * FROM (SELECT * FROM last_settled UNION ALL SELECT * FROM last_open) AS both_kinds
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus = 'P' DESC) = 1""",
    "append_new": """
        SELECT * FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""",
    "append_new_composite": """
        SELECT city, observation_time, run_id, temperature_c, ingestion_date
        FROM feed_weather WHERE ingestion_date >= DATE '2024-01-16'""",
    "dq_orders": f"""
        SELECT 'order_id_not_null' AS rule, count(*) FILTER (order_id IS NULL) AS failed_rows FROM feed_orders
        UNION ALL SELECT 'order_total_positive', count(*) FILTER (order_total <= 0) FROM feed_orders
        UNION ALL SELECT 'order_status_allowed',
            count(*) FILTER (NOT list_contains({_list(fixed.ORDER_STATUSES)}, order_status)) FROM feed_orders
        UNION ALL SELECT 'item_count_positive', count(*) FILTER (item_count <= 0) FROM feed_orders
        UNION ALL SELECT 'order_id_unique', count(*)
            FROM (SELECT order_id FROM feed_orders GROUP BY order_id HAVING count(*) > 1) AS repeated""",
    "dq_ranges": " UNION ALL ".join([
        "SELECT 'bronze_sellers' AS \"table\", 'seller_id_not_null' AS rule,"
        " count(*) FILTER (seller_id IS NULL) AS failed_rows FROM feed_sellers",
        _range_rule("sellers", "seller_rating", 1, 5),
        _range_rule("sellers", "fulfillment_score", 0, 100),
        "SELECT 'bronze_sellers', 'min_row_count', greatest(90 - count(*), 0) FROM feed_sellers",
        "SELECT 'bronze_weather', 'city_not_null', count(*) FILTER (city IS NULL) FROM feed_weather",
        _range_rule("weather", "temperature_c", -90, 60),
        _range_rule("weather", "humidity_pct", 0, 100),
        f"SELECT 'bronze_weather', 'city_required_values', ({_missing('city', [c[0] for c in fixed.CITIES], 'feed_weather')})",
        "SELECT 'bronze_fx_rates', 'exchange_rate_positive',"
        " count(*) FILTER (exchange_rate IS NULL OR exchange_rate <= 0) FROM feed_fx",
        "SELECT 'bronze_fx_rates', 'base_currency_allowed', count(*) FILTER (base_currency <> 'USD') FROM feed_fx",
        "SELECT 'bronze_fx_rates', 'min_row_count', greatest(20 - count(*), 0) FROM feed_fx",
        f"SELECT 'bronze_fx_rates', 'target_currency_required_values',"
        f" ({_missing('target_currency', fixed.REQUIRED_CURRENCIES, 'feed_fx')})",
    ]),
    "dq_required": f"""
        SELECT p_type FROM (SELECT unnest({_list(CATEGORIES + ['LUXURY', 'REFURBISHED'])}) AS p_type) AS wanted
        WHERE p_type NOT IN (SELECT p_type FROM part)""",
    "dq_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_gold": " UNION ALL ".join(
        _gold_test("dim_date", "date_dim", "date_sk")
        + _gold_test("dim_product", "product_dim", "product_sk")
        + _gold_test("dim_user", "user_dim", "user_sk")
        + _gold_test("dim_currency", "currency_dim", "currency_sk")
        + _gold_test("fact_orders", "order_fact", "order_id", ("order_total_usd",))
        + ["SELECT 'fact_daily_sales', 'revenue_usd_not_null', count(*) FILTER (revenue_usd IS NULL) FROM daily_fact"]
    ),
    "name_and_email": f"""
        SELECT user_id, run_id, name, split_part(clean_name, ' ', 1) AS first_name,
               CASE WHEN contains(clean_name, ' ') THEN substr(clean_name, strpos(clean_name, ' ') + 1) END AS last_name,
               regexp_matches(email, '{fixed.EMAIL}') AS is_valid_email,
               CASE WHEN contains(email, '@') THEN lower(split_part(email, '@', 2)) END AS email_domain
        FROM names""",
    "contact_clean": f"""
        SELECT user_id, run_id, bare AS phone_without_extension,
               '+' || nullif(regexp_extract(bare, '{fixed.COUNTRY_PREFIX}', 1), '') AS phone_country_code,
               regexp_matches(bare, '{fixed.COUNTRY_PREFIX}') AS has_country_code,
               {_strip(_strip('bare', fixed.PHONE_PREFIXES), fixed.EXTENSION_OR_PUNCTUATION)} AS phone_number_clean
        FROM (SELECT user_id, run_id,
                     trim({_strip('trim(' + _strip('phone', fixed.X_EXTENSION) + ')', fixed.WORD_EXTENSION)}) AS bare
              FROM feed_users) AS u""",
    "bands": f"""
        SELECT {_band('c_acctbal', fixed.SPEND_SEGMENT)} AS spend_segment,
               {_band('(CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 1500 END)', fixed.ACCOUNT_AGE_SEGMENT)} AS age_segment,
               c_acctbal > 0 AS in_credit, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment,
               count(*) AS customers
        FROM customer GROUP BY ALL""",
    "date_parts": _DATE_OF_ORDER.replace(
        "SELECT CAST(strftime", f"SELECT o_orderkey, CAST({_AS_OF} - date AS INTEGER) AS age_days, CAST(strftime", 1
    ),
    "millis_rounding": f"""
        SELECT event_id, {_MILLIS.format('ts')} AS ts_millis, CAST({_MILLIS.format('ts')} AS DATE) AS business_date
        FROM events""",
    "utc_text": """
        SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL
                              WHEN event_id % 4 = 0 THEN ts - INTERVAL 330 MINUTE
                              WHEN event_id % 4 = 2 THEN ts + INTERVAL 8 HOUR ELSE ts END AS utc
        FROM events""",
    "order_rollup": "SELECT * FROM rollup_of_lines",
    "top_seller_per_order": "SELECT order_id, seller_id AS top_seller_id FROM best_seller",
    "top_category_per_order": "SELECT order_id, category AS top_category FROM best_category",
    "json_items_roundtrip": f"""
        SELECT order_id, position, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS quantity,
               {_exact(_r('unit_price * quantity', 2))} AS gross_total,
               {_exact(_r(_r('unit_price * (1 - discount_pct / 100)', 2) + ' * quantity', 2))} AS net_total
        FROM (SELECT order_id, unit_price, discount_pct, CAST(place AS INTEGER) AS position,
                     least(10, CAST(quantity AS INTEGER) - 10 * place) AS quantity
              FROM (SELECT *, unnest(range(0, CAST(ceil(quantity / 10.0) AS BIGINT))) AS place FROM line_documents))
        GROUP BY order_id, position""",
    "reconcile_orders": f"""
        SELECT order_id,
               abs(CAST(discount_total AS DECIMAL(28,8)) - (CAST(gross_total AS DECIMAL(28,8))
                   - CAST(net_total AS DECIMAL(28,8)))) > 0.01 AS discount_off,
               abs(CAST(tax_amount AS DECIMAL(28,8)) - CAST({_r('net_total * tax_rate', 2)} AS DECIMAL(28,8))) > 0.01 AS tax_off,
               abs(CAST(order_total AS DECIMAL(28,8)) - (CAST(net_total AS DECIMAL(28,8))
                   + CAST(shipping_cost AS DECIMAL(28,8)) + CAST(tax_amount AS DECIMAL(28,8)))) > 0.01 AS total_off
        FROM feed_orders""",
    "price_stock_flags": f"""
        SELECT product_id, run_id, coalesce(retail_category, 'Other') AS retail_category,
               {_r('current_price * (1 - discount_pct / 100)', 2)} AS final_price,
               stock_quantity < least + floor((most - least) * 0.1e0) AS is_low_stock
        FROM feed_products LEFT JOIN retail ON part_type = category LEFT JOIN stock_range USING (retail_category)""",
    "silver_products": "SELECT * FROM clean_products",
    "silver_users": "SELECT * FROM clean_users",
    "silver_orders": "SELECT * FROM clean_orders",
    "silver_sellers": "SELECT * FROM clean_sellers",
    "silver_fx_rates": "SELECT * FROM clean_fx",
    "silver_weather": "SELECT * FROM clean_weather",
    "dim_currency": "SELECT * FROM currency_dim",
    "dim_date": "SELECT * FROM date_dim",
    "dim_product": "SELECT * FROM product_dim",
    "dim_seller": "SELECT * FROM seller_dim",
    "dim_user": "SELECT * FROM user_dim",
    "fact_orders": "SELECT * FROM order_fact",
    "fact_daily_sales": "SELECT * FROM daily_fact",
    "report_daily_revenue": f"SELECT order_date, {_exact('revenue_usd')} AS revenue_usd FROM daily_fact GROUP BY 1 ORDER BY 1",
    "report_revenue_by_category": f"SELECT category, {_exact('revenue_usd')} AS revenue_usd FROM daily_fact GROUP BY 1",
    "report_revenue_by_channel": f"SELECT channel, {_exact('revenue_usd')} AS revenue_usd FROM daily_fact GROUP BY 1",
    "report_revenue_by_country": f"SELECT user_country, {_exact('revenue_usd')} AS revenue_usd FROM daily_fact GROUP BY 1",
    "report_orders_by_tier": "SELECT customer_tier, count(order_id) AS orders FROM order_fact GROUP BY 1",
    "report_spend_segments": f"""
        SELECT spend_segment, count(*) AS users,
               {_r('count(*) * 100e0 / (SELECT count(*) FROM user_dim)', 2)} AS share_pct
        FROM user_dim GROUP BY 1""",
    "report_top_sellers": f"""
        SELECT top_seller_sk, top_seller_name, {_exact('order_total_usd')} AS revenue_usd
        FROM order_fact WHERE top_seller_name IS NOT NULL GROUP BY 1, 2 ORDER BY revenue_usd DESC, top_seller_sk LIMIT 10""",
    "report_tier_commission": f"""
        SELECT seller_tier, count(*) AS sellers,
               {_r('CAST(sum(CAST(commission_rate AS DECIMAL(18,6))) AS DOUBLE) / count(commission_rate)', 6)} AS avg_commission_rate
        FROM seller_dim GROUP BY 1""",
    "report_status_breakdown": "SELECT order_status, count(order_id) AS orders FROM order_fact GROUP BY 1",
    "report_discount_trend": f"""
        SELECT order_date, CAST(sum(discounted_orders) AS BIGINT) AS discounted_orders,
               CAST(sum(total_orders) AS BIGINT) AS total_orders,
               {_r('sum(discounted_orders) * 100e0 / sum(total_orders)', 1)} AS discount_rate_pct
        FROM daily_fact GROUP BY 1 ORDER BY 1""",
    "report_weekend_volume": "SELECT is_weekend, CAST(sum(total_orders) AS BIGINT) AS total_orders FROM daily_fact GROUP BY 1",
    "report_commission_by_category": f"""
        SELECT seller_category, {_exact('total_commission_usd')} AS total_commission_usd FROM daily_fact GROUP BY 1""",
}


def _compose(text: str) -> str:
    """Put the views that ``text`` needs in front of it, in dependency order."""
    ordered: list[str] = []

    def need(fragment: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN)\s+(\w+)", fragment):
            if word in VIEWS and word not in ordered:
                need(VIEWS[word])
                ordered.append(word)

    need(text)
    if not ordered:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + text


def all_oracles() -> dict[str, str]:
    return {name: _compose(text) for name, text in QUERIES.items()}
