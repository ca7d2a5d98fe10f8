"""Raw service answers -> feed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.functions.json_text import with_parsed
from shopstrata.operators.joins import allowed_only, decode
from shopstrata.sources.literals import literal_table

_RATES = (
    "result STRING, conversion_rates MAP<STRING, DOUBLE>, time_last_update_utc STRING,"
    " time_next_update_utc STRING, time_last_update_unix BIGINT"
)

MALFORMED = "malformed"
FAILED = "failed answer"

# feed column -> field of the "current" object
_CURRENT_DOUBLES = {
    "temperature_c": "temperature_2m",
    "feels_like_c": "apparent_temperature",
    "humidity_pct": "relative_humidity_2m",
    "precipitation_mm": "precipitation",
    "rain_mm": "rain",
    "wind_speed_kmh": "wind_speed_10m",
    "wind_direction_deg": "wind_direction_10m",
    "surface_pressure_hpa": "surface_pressure",
    "cloud_cover_pct": "cloud_cover",
    "visibility_m": "visibility",
}


def target_currencies(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "target_currency", [(c,) for c in fixed.TARGET_CURRENCIES])


def cities(spark: SparkSession) -> DataFrame:
    rows = [(i, *city) for i, city in enumerate(fixed.CITIES)]
    return literal_table(spark, "position, city, country, lat, lon", rows)


def weather_codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "weather_code, weather_description", fixed.WEATHER_CODES)


def flatten_rates(
    documents: DataFrame, allow: DataFrame, payload: str = "payload"
) -> DataFrame:
    """One row per allow-listed currency of each successful rates document.

    Other columns of ``documents`` are kept.
    """
    carried = [c for c in documents.columns if c != payload]
    parsed = with_parsed(documents, "_doc", F.from_json(payload, _RATES)).where(
        F.col("_doc.result") == "success"
    )
    rates = parsed.select(
        *carried,
        "_doc",
        F.explode("_doc.conversion_rates").alias("target_currency", "exchange_rate"),
    ).where(F.col("exchange_rate").isNotNull())
    base = F.lit(fixed.BASE_CURRENCY)
    return allowed_only(rates, allow, "target_currency").select(
        *carried,
        base.alias("base_currency"),
        "target_currency",
        "exchange_rate",
        F.col("_doc.time_last_update_utc").alias("rate_date_utc"),
        F.col("_doc.time_last_update_unix").alias("rate_unix"),
        F.col("_doc.time_next_update_utc").alias("next_update_utc"),
        F.concat_ws("/", base, F.col("target_currency")).alias("pair"),
    )


def refused_rates(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """The rates documents that give no rows because they failed or cannot be read, with a ``reason``."""
    document = F.from_json(payload, _RATES)
    result = document["result"]
    reason = F.when(result.isNull(), F.lit(MALFORMED)).when(result != "success", F.lit(FAILED))
    reason = reason.when(document["conversion_rates"].isNull(), F.lit(MALFORMED))
    return documents.withColumn("reason", reason).where("reason IS NOT NULL")


_WEATHER = (
    "ARRAY<STRUCT<current: STRUCT<time: STRING, "
    + ", ".join(f"{field}: DOUBLE" for field in _CURRENT_DOUBLES.values())
    # Read as VARIANT, an absent field is NULL while a JSON null is a value.
    + ", weather_code: VARIANT, is_day: VARIANT>, timezone: VARIANT, error: BOOLEAN>>"
)


def _unless_absent(field: Column, default: object, given: Column) -> Column:
    return F.when(field.isNull(), F.lit(default)).otherwise(given)


def flatten_weather(
    documents: DataFrame,
    city_list: DataFrame,
    codes: DataFrame,
    payload: str = "payload",
) -> DataFrame:
    """One row per city of each weather answer; the n-th object belongs to the n-th city.

    A lone object counts as a list of one. Absent fields get their defaults;
    a field that is there but null stays null (``is_day`` then means night).
    An error object gives no row; see ``refused_weather``.
    """
    carried = [c for c in documents.columns if c != payload]
    answers = F.posexplode(F.from_json(payload, _WEATHER))
    each = documents.select(*carried, answers.alias("position", "_answer")).where(
        ~F.coalesce(F.col("_answer.error"), F.lit(False))
    )
    current, zone = F.col("_answer.current"), F.col("_answer.timezone")
    code, day = current["weather_code"], current["is_day"]
    lit_day = F.coalesce(F.try_variant_get(day, "$", "int") != 0, F.lit(False))
    rows = each.select(
        *carried,
        "position",
        current["time"].alias("observation_time"),
        *[current[field].alias(name) for name, field in _CURRENT_DOUBLES.items()],
        _unless_absent(
            code, fixed.MISSING_WEATHER_CODE, F.try_variant_get(code, "$", "int")
        ).alias("weather_code"),
        _unless_absent(day, True, lit_day).alias("is_day"),
        _unless_absent(zone, "UTC", F.try_variant_get(zone, "$", "string")).alias("timezone"),
    )
    placed = rows.join(F.broadcast(city_list), "position", "inner").drop("position")
    return decode(placed, codes, "weather_code", "weather_description", fixed.UNKNOWN_WEATHER)


def refused_weather(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """The weather answers that cannot be read, or hold an error object, with a ``reason``."""
    answers = F.from_json(payload, _WEATHER)
    empty = answers.isNull() | (F.size(answers) == 0)
    reason = F.when(empty, F.lit(MALFORMED)).when(
        F.exists(answers, lambda a: F.coalesce(a["error"], F.lit(False))), F.lit(FAILED)
    )
    return documents.withColumn("reason", reason).where("reason IS NOT NULL")
