"""Batch runs: one day of a feed into its clean table, and the full star schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata import fixed_values as fixed
from shopstrata.operators import merge, quality
from shopstrata.operators.lineage import Run
from shopstrata.plans import gold
from shopstrata.plans.silver import CLEAN_TABLES, CleanTable
from shopstrata.sources import tables as catalog


@dataclass(frozen=True)
class Outcome:
    table: str
    day: date
    rows_read: int
    written: bool  # False for an empty day, and where every row had been appended before


def run_partition(
    spark: SparkSession,
    clean: CleanTable | str,
    day: date,
    run: Run,
    bronze_db: str,
    silver_db: str,
    bronze_table: str | None = None,
    silver_table: str | None = None,
    newer_by: str | None = None,
) -> Outcome:
    """Gate, clean and write one day. Two passes over the day: measure, then write.

    No rows: nothing happens. A broken rule: QualityError, nothing is written.
    A repeat of a day appends only what is not there yet. Keyed tables take the last
    writer's row; with ``newer_by``, a column of theirs, the repeat of an old day leaves newer rows alone.
    """
    clean = CLEAN_TABLES[clean] if isinstance(clean, str) else clean
    source = f"{bronze_db}.{bronze_table or clean.feed}"
    target = f"{silver_db}.{silver_table or clean.table}"

    feed = catalog.scan_partition(spark, source, day)
    measured = quality.measure(feed, clean.gate).first()
    rows = measured[quality.ROW_COUNT]
    if rows == 0:
        return Outcome(target, day, 0, False)
    quality.require([{"rule": n, "failed_rows": measured[n]} for n in clean.gate.names()])

    if clean.upserts:
        cleaned = clean.transform(feed, run)
        catalog.upsert_table(spark, target, cleaned, clean.keys, newer_by, source_is_unique=True)
        written = True
    else:
        cleaned = clean.transform(_not_yet_written(spark, feed, clean, target, day), run)
        written = catalog.append_table(cleaned, target) > 0
    return Outcome(target, day, rows, written)


def _not_yet_written(
    spark: SparkSession, feed: DataFrame, clean: CleanTable, target: str, day: date
) -> DataFrame:
    columns = [ours for _, ours in clean.guard]
    existing = catalog.scan_existing(spark, target, day, columns, "silver_processed_date")
    if existing is None:
        return feed
    renamed = existing.select(*[F.col(ours).alias(theirs) for theirs, ours in clean.guard])
    return merge.append_new(feed, renamed, [theirs for theirs, _ in clean.guard])


def run_gold(
    spark: SparkSession,
    silver_db: str,
    gold_db: str,
    as_of: date,
    max_days: int | None = None,
) -> None:
    """Rebuild the star schema from the clean tables and test it.

    Each model is written once and read back by the ones after it, so nothing is
    computed twice and a lost executor only repeats part of one model.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold_db}")

    def silver(name: str) -> DataFrame:
        return spark.read.table(f"{silver_db}.{name}")

    def save(df: DataFrame, name: str, order_by: tuple[str, ...] = ()) -> DataFrame:
        table = f"{gold_db}.{name}"
        catalog.overwrite_table(df, table, order_by)
        return spark.read.table(table)

    dims = gold.Dimensions(
        users=save(gold.user_dim(silver("silver_users")), "dim_user"),
        dates=save(
            gold.date_dim(silver("silver_orders").select("ordered_at"), as_of, max_days),
            "dim_date",
            ("date",),
        ),
        currencies=save(gold.currency_dim(silver("silver_fx_rates")), "dim_currency"),
        sellers=save(gold.seller_dim(silver("silver_sellers")), "dim_seller"),
        products=save(gold.product_dim(silver("silver_products")), "dim_product"),
    )
    fact = save(gold.fact_orders(silver("silver_orders"), dims), "fact_orders")
    save(
        gold.daily_sales(fact),
        "fact_daily_sales",
        ("order_date", "category", "channel", "user_country"),
    )
    quality.require(gold_report(spark, gold_db))


def gold_report(spark: SparkSession, gold_db: str) -> DataFrame:
    """(table, rule, failed_rows) of all table tests."""
    reports = [
        quality.check(spark.read.table(f"{gold_db}.{name}"), gate, name)
        for name, gate in gold.TABLE_TESTS.items()
    ]
    report = reports[0]
    for more in reports[1:]:
        report = report.unionByName(more)
    return report
