"""Order lines: roll-ups, best seller and category per order, reconciliation.

Two aggregation steps, (order, category) and then order. Each is pre-aggregated
before its shuffle, so an order with a huge number of lines is reduced where
its lines are read instead of being gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.money import cents, exact, from_cents, round_half_up
from shopstrata.schemas import LINE_ITEM


def line_items(orders: DataFrame, column: str = "products_json") -> DataFrame:
    """One row per line item of the JSON text; unreadable text gives no lines."""
    schema = f"array<{LINE_ITEM.simpleString()}>"
    items = F.posexplode(F.from_json(column, schema))
    return orders.select("order_id", items.alias("position", "_item")).select(
        "order_id", "position", "_item.*"
    )


def line_amounts(unit_price: Column, quantity: Column, discount_pct: Column) -> dict[str, Column]:
    """Price arithmetic of a line: unit after discount, gross and net total."""
    final_unit = round_half_up(unit_price * (1 - discount_pct / 100), 2)
    return {
        "final_unit_price": final_unit,
        "line_gross_total": round_half_up(unit_price * quantity, 2),
        "line_net_total": round_half_up(final_unit * quantity, 2),
    }


def category_totals(lines: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Totals of each (order, category), with its best-selling line.

    Lines need order_id, category, seller_id, quantity, gross_cents and net_cents.
    ``carry`` adds aggregates of the caller's own.
    """
    # Highest net first, smallest seller on a tie.
    best = F.struct(F.col("net_cents").alias("net"), (-F.col("seller_id")).alias("low"))
    return lines.groupBy("order_id", "category").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("quantity").alias("quantity"),
        F.sum("gross_cents").alias("gross_cents"),
        F.sum("net_cents").alias("net_cents"),
        F.max(best).alias("top"),
        *[c.alias(n) for n, c in (carry or {}).items()],
    )


def order_rollup(
    lines: DataFrame, carry: dict[str, tuple[Column | None, Column]] | None = None
) -> DataFrame:
    """One row per order: counts, totals, best seller and best category.

    ``carry`` maps a name to its aggregate over lines (None if it needs none) and
    the aggregate over (order, category) rows that completes it.
    """
    carry = carry or {}
    over_lines = {n: first for n, (first, _) in carry.items() if first is not None}
    per_category = category_totals(lines, over_lines)
    # Largest quantity wins and the first name on a tie: min over (-quantity, name).
    ranked = F.struct((-F.col("quantity")).alias("less"), F.col("category").alias("category"))
    totals = per_category.groupBy("order_id").agg(
        F.sum("items").cast("int").alias("item_count"),
        F.sum("quantity").cast("int").alias("total_quantity"),
        F.sum("gross_cents").alias("_gross"),
        F.sum("net_cents").alias("_net"),
        F.max("top").alias("_top"),
        F.min(ranked).alias("_best"),
        *[second.alias(n) for n, (_, second) in carry.items()],
    )
    return totals.select(
        "order_id",
        "item_count",
        "total_quantity",
        from_cents(F.col("_gross")).alias("gross_total"),
        from_cents(F.col("_gross") - F.col("_net")).alias("discount_total"),
        from_cents(F.col("_net")).alias("net_total"),
        (-F.col("_top.low")).cast("int").alias("top_seller_id"),
        F.col("_best.category").alias("top_category"),
        *carry,
    )


def top_by(
    df: DataFrame, keys: Sequence[str], value: str, pick: str, name: str
) -> DataFrame:
    """``pick`` of the row with the largest ``value`` per key, smallest ``pick`` on a tie."""
    best = F.min(F.struct((-F.col(value)).alias("less"), F.col(pick).alias("pick")))
    return df.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col("_best.pick").alias(name)
    )


def reconcile(orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Recompute discount, tax and total of each order; flag the ones that are off by more than ``tolerance``.

    Amounts are compared as decimals, unrounded; only the recomputed tax is rounded, as it is when it is charged.
    """
    slack = exact(F.lit(tolerance))

    def off(stated: str, expected: Column) -> Column:
        return F.coalesce(F.abs(exact(F.col(stated)) - expected) > slack, F.lit(False))

    gross, net = exact(F.col("gross_total")), exact(F.col("net_total"))
    tax = exact(round_half_up(F.col("net_total") * F.col("tax_rate"), 2))
    return orders.select(
        "order_id",
        off("discount_total", gross - net).alias("discount_off"),
        off("tax_amount", tax).alias("tax_off"),
        off("order_total", net + exact(F.col("shipping_cost")) + exact(F.col("tax_amount"))).alias("total_off"),
    )


def low_stock(stock: Column, least: Column, most: Column, share: float) -> Column:
    """Stock under the lower ``share`` of its category's range."""
    return stock < least + F.floor((most - least) * F.lit(share))
