from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest

from shopstrata.schemas import BRONZE
from shopstrata.sources.tables import create_tables
from shopstrata.streaming import landing
from tests.conftest import rows

FX = {
    "dataset": "bronze_fx_rates", "base_currency": "USD", "target_currency": "EUR", "exchange_rate": 0.9,
    "pair": "USD/EUR", "source": "t", "run_id": "r1",
    "ingested_at": "2024-01-01T10:00:00+05:30", "ingestion_date": "2024-01-01",
}
ORDER = {
    "dataset": "bronze_orders", "order_id": "o1", "user_id": 7, "order_total": 12.5,
    "ordered_at": "2024-01-01T23:00:00-02:00", "estimated_delivery_at": None, "source": "t",
    "run_id": "r1", "ingested_at": "2024-01-01T10:00:00Z", "ingestion_date": "2024-01-01",
}
OTHER = {"dataset": "returns", "id": 1}
BAD_TIME = {**ORDER, "order_id": "o2", "ordered_at": "yesterday"}


@pytest.fixture
def target(spark, tmp_path):
    name = "l_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {name}b LOCATION '{tmp_path}/db'")
    create_tables(spark, name + "b", name + "s", root=str(tmp_path / "tables"))
    landing.create_rejects_table(spark, f"{name}b.rejects")
    tables = {d: f"{name}b.{d}" for d in BRONZE}
    (tmp_path / "in").mkdir()
    return tmp_path, tables, f"{name}b.rejects"


def drop_file(folder, name, *records):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / "in" / name).write_text("\n".join(lines) + "\n")


def run(spark, target):
    folder, tables, rejects = target
    stream = landing.read_lines(spark, str(folder / "in"), 1)
    query = landing.route(stream, tables, rejects, str(folder / "checkpoint"), available_now=True)
    assert query.awaitTermination(120)


def test_stream_routes_types_and_rejects(spark, target):
    folder, tables, rejects = target
    drop_file(folder, "a.json", FX, ORDER, ORDER, OTHER, '{"dataset":"bronze_orders","order_id"', BAD_TIME)
    run(spark, target)
    fx = spark.table(tables["bronze_fx_rates"])
    assert rows(fx.select("pair", "exchange_rate", "ingested_at", "ingestion_date", "rate_unix")) == [
        ("USD/EUR", 0.9, dt.datetime(2024, 1, 1, 4, 30), dt.date(2024, 1, 1), None)
    ]
    orders = spark.table(tables["bronze_orders"])
    # Append-only: two equal records stay two rows.
    assert rows(orders.select("order_id", "user_id", "ordered_at", "estimated_delivery_at")) == [
        ("o1", 7, dt.datetime(2024, 1, 2, 1, 0), None)
    ] * 2
    assert rows(spark.table(rejects).groupBy("dataset", "reason").count()) == sorted(
        [("returns", landing.UNKNOWN_DATASET, 1), (None, landing.MALFORMED, 1), ("bronze_orders", landing.MALFORMED, 1)],
        key=repr,
    )


def test_restart_adds_only_new_files(spark, target):
    folder, tables, rejects = target
    drop_file(folder, "a.json", FX, OTHER)
    run(spark, target)
    run(spark, target)
    assert spark.table(tables["bronze_fx_rates"]).count() == 1
    drop_file(folder, "b.json", FX, {**FX, "pair": "USD/GBP"})
    run(spark, target)
    assert spark.table(tables["bronze_fx_rates"]).count() == 3
    assert spark.table(rejects).count() == 1


def test_a_replayed_batch_replaces_itself(spark, target):
    _, tables, rejects = target
    batch = spark.createDataFrame([(json.dumps(r),) for r in (FX, ORDER, OTHER)], "value string")
    for _ in range(2):
        landing.land_batch(batch, "s-0", tables, rejects)
    landing.land_batch(batch, "s-1", tables, rejects)
    assert spark.table(tables["bronze_fx_rates"]).count() == 2
    assert spark.table(tables["bronze_orders"]).count() == 2
    assert spark.table(rejects).count() == 2


def test_batch_form_counts(spark):
    lines = [json.dumps(r) for r in (FX, ORDER, OTHER, BAD_TIME)] + ["{", "null", ""]
    routed = landing.with_dataset(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(landing.route_outcomes(routed, BRONZE)) == sorted(
        [("bronze_fx_rates", "landed", 1), ("bronze_orders", "landed", 1),
         ("bronze_orders", landing.MALFORMED, 1),
         ("returns", landing.UNKNOWN_DATASET, 1), (None, landing.MALFORMED, 3)],
        key=repr,
    )


def test_streams_do_not_share_batch_names():
    assert landing.stream_name("/a") != landing.stream_name("/b")
    assert landing.stream_name("/a") == landing.stream_name("/a")
