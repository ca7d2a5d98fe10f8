from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstrata.operators import lines as line_ops
from shopstrata.operators import merge, quality
from shopstrata.operators.dedup import first_per_group, latest_per_key
from shopstrata.operators.joins import allowed_only, decode
from shopstrata.operators.lineage import Run, clean_lineage, process_day, stamp
from shopstrata.operators.quality import Gate
from tests.conftest import rows

KV = "k int, v string, t int"


def test_latest_per_key_null_loses_and_ties_are_settled(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "z", 4), (2, "x", None), (2, "y", 1), (None, "n", 1)], KV
    )
    got = latest_per_key(df, ["k"], ["t"], ["v"])
    assert rows(got) == sorted([(1, "a", 5), (2, "y", 1), (None, "n", 1)], key=repr)


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 2), ("b", 9), (None, 1)], "c string, n int")
    assert rows(first_per_group(df, ["c"], ["n"])) == sorted([("a", 2), ("b", 9), (None, 1)], key=repr)


def test_upsert_replaces_adds_and_keeps(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "old", 1), (None, "old", 1)], KV)
    source = spark.createDataFrame([(2, "new", 2), (3, "new", 2), (None, "new", 2)], KV)
    got = merge.upsert(target, source, ["k"])
    assert rows(got) == sorted(
        [(1, "old", 1), (2, "new", 2), (3, "new", 2), (None, "old", 1), (None, "new", 2)], key=repr
    )


def test_upsert_matches_columns_by_name(spark):
    target = spark.createDataFrame([(1, "old", 1)], KV)
    source = spark.createDataFrame([(7, 1, "new")], "t int, k int, v string")
    assert rows(merge.upsert(target, source, ["k"])) == [(1, "new", 7)]


def test_upsert_newer_by_ignores_a_replayed_old_row(spark):
    target = spark.createDataFrame([(1, "now", 5), (2, "now", 5)], KV)
    source = spark.createDataFrame([(1, "past", 4), (2, "next", 6), (3, "add", 1)], KV)
    got = merge.upsert(target, source, ["k"], newer_by="t")
    assert rows(got) == [(1, "now", 5), (2, "next", 6), (3, "add", 1)]


def test_upsert_newer_by_with_missing_times_and_keys(spark):
    target = spark.createDataFrame([(1, "timeless", None), (2, "now", 5), (3, None, None), (None, "kept", 5)], KV)
    source = spark.createDataFrame([(1, "new", 1), (2, "timeless", None), (3, "new", None), (None, "added", 9)], KV)
    got = merge.upsert(target, source, ["k"], newer_by="t")
    assert rows(got) == sorted(
        [(1, "new", 1), (2, "now", 5), (3, "new", None), (None, "kept", 5), (None, "added", 9)], key=repr
    )


keyed = st.dictionaries(st.integers(0, 6), st.text("ab", max_size=2), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, target, source):
    def table(d):
        return spark.createDataFrame(list(d.items()), "k int, v string")

    once = merge.upsert(table(target), table(source), ["k"])
    assert dict(map(tuple, once.collect())) == {**target, **source}
    assert rows(merge.upsert(once, table(source), ["k"])) == rows(once)


def test_duplicate_source_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (None, "c", 1), (None, "d", 1)], KV)
    with pytest.raises(merge.DuplicateKeyError):
        merge.reject_duplicate_keys(df, ["k"])
    merge.reject_duplicate_keys(df.where("v <> 'b'"), ["k"])


def test_append_new(spark):
    source = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "c", 1)], KV)
    assert rows(merge.append_new(source, None, ["k"])) == rows(source)
    fresh = merge.append_new(source, source.where("k = 1"), ["k"])
    assert rows(fresh) == [(2, "b", 1), (None, "c", 1)]
    assert merge.append_new(source, source, ["k"]).collect() == [(None, "c", 1)]
    assert merge.append_new(source, source, ["k", "v"]).count() == 1


GATE = Gate(
    rules=[
        quality.not_null("id"),
        quality.positive("total"),
        quality.positive("rate", null_fails=True),
        quality.in_range("score", 0, 100),
        quality.allowed("status", ["ok", "done"]),
    ],
    min_rows=6,
    unique=["id"],
    required={"city": ["Rome", "Oslo"]},
)
SCHEMA = "id int, total double, rate double, score double, status string, city string"


def report_of(df, gate):
    return {r["rule"]: r["failed_rows"] for r in quality.check(df, gate).collect()}


def test_each_rule_counts_its_own_failures(spark):
    df = spark.createDataFrame(
        [
            (1, 1.0, 1.0, 0.0, "ok", "Rome"),
            (1, 0.0, None, 100.0, None, "Rome"),
            (None, None, 0.0, 100.1, "bad", None),
            (3, -1.0, 1.0, None, "done", "Paris"),
        ],
        SCHEMA,
    )
    assert report_of(df, GATE) == {
        "id_not_null": 1,
        "total_positive": 2,
        "rate_positive": 2,
        "score_in_range": 2,
        "status_allowed": 1,
        "min_row_count": 2,
        "id_unique": 1,
        "city_required_values": 1,
    }
    with pytest.raises(quality.QualityError, match="status_allowed: 1"):
        quality.require(quality.check(df, GATE))


def test_good_rows_pass(spark):
    df = spark.createDataFrame(
        [(i, None, 1.0, 50.0, None, "Rome" if i % 2 else "Oslo") for i in range(6)], SCHEMA
    )
    assert set(report_of(df, GATE).values()) == {0}
    quality.require(quality.check(df, GATE))


def test_gate_of_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    measured = quality.measure(df, GATE).first()
    assert measured["row_count"] == 0 and measured["id_not_null"] == 0
    assert measured["min_row_count"] == 6 and measured["city_required_values"] == 2


def test_null_keys_may_be_left_out_of_uniqueness(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert report_of(df, Gate(unique=["id"])) == {"id_unique": 1}
    assert report_of(df, Gate(unique=["id"], null_key_is_duplicate=False)) == {"id_unique": 0}


def test_missing_values(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    expected = spark.createDataFrame([("a",), ("b",)], "c string")
    assert rows(quality.missing_values(df, "c", expected)) == [("b",)]


def test_lineage_shift_reads_the_old_run_id(spark):
    df = spark.createDataFrame(
        [(1, "d", "s", "feed-run", dt.datetime(2024, 1, 2, 3), dt.date(2024, 1, 2))],
        "k int, dataset string, source string, run_id string, ingested_at timestamp_ntz, ingestion_date date",
    )
    run = Run(dt.datetime(2024, 1, 3, 2), dt.date(2024, 1, 3), "mine")
    got = clean_lineage(df, run, keep_updated_at=True).first().asDict()
    assert got == {
        "k": 1,
        "last_updated_at": dt.datetime(2024, 1, 2, 3),
        "last_run_id": "feed-run",
        "run_id": "mine",
        "run_timestamp": dt.datetime(2024, 1, 3, 2),
        "silver_processed_date": dt.date(2024, 1, 2),
    }
    assert "last_updated_at" not in clean_lineage(df, run, keep_updated_at=False).columns


def test_runs(spark):
    assert process_day(dt.datetime(2024, 3, 1, 2)) == dt.date(2024, 2, 29)
    run = Run.for_schedule(dt.datetime(2024, 3, 1, 2))
    assert run.as_of == dt.date(2024, 3, 1) and len(run.run_id) == 36
    stamped = stamp(spark.range(3), "bronze_orders", "test", "r", dt.datetime(2024, 1, 1, 23, 59))
    assert stamped.select("dataset", "run_id", "ingested_at", "ingestion_date").distinct().collect() == [
        ("bronze_orders", "r", dt.datetime(2024, 1, 1, 23, 59), dt.date(2024, 1, 1))
    ]


LINES = "order_id int, category string, seller_id int, quantity int, gross_cents long, net_cents long"


def test_rollup_ties(spark):
    df = spark.createDataFrame(
        [
            (1, "b", 9, 2, 1000, 900), (1, "a", 4, 2, 1000, 900), (1, "c", 1, 1, 500, 450),
            (2, "z", 7, 5, 100, 100),
        ],
        LINES,
    )
    got = line_ops.order_rollup(df).orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [
        (1, 3, 5, 25.0, 2.5, 22.5, 4, "a"),
        (2, 1, 5, 1.0, 0.0, 1.0, 7, "z"),
    ]
    assert rows(line_ops.top_by(df, ["order_id"], "net_cents", "seller_id", "s")) == [(1, 4), (2, 7)]


def test_rollup_of_one_huge_order(spark):
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, 0).otherwise(F.col("id")).alias("order_id"),
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("category"),
        (F.col("id") % 11).alias("seller_id"),
        F.lit(1).alias("quantity"),
        F.lit(100).cast("bigint").alias("gross_cents"),
        (F.col("id") % 97).alias("net_cents"),
    )
    hot = line_ops.order_rollup(df.repartition(8)).where("order_id = 0").first()
    assert hot["item_count"] == n // 3 and hot["gross_total"] == float(n // 3)
    best = max((i % 97, -(i % 11)) for i in range(n // 3))
    assert hot["top_seller_id"] == -best[1]


def test_line_items_and_amounts(spark):
    text = (
        '[{"product_id":1,"seller_id":2,"category":"c","unit_price":10.05,"quantity":3,"discount_pct":10.0},'
        '{"product_id":5,"unit_price":1.0,"quantity":1,"discount_pct":0}]'
    )
    df = spark.createDataFrame([("o", text), ("broken", "[{"), ("none", None)], "order_id string, products_json string")
    items = line_ops.line_items(df)
    priced = items.select(
        "order_id", "position", "product_id",
        *[c.alias(n) for n, c in line_ops.line_amounts(
            F.col("unit_price"), F.col("quantity"), F.col("discount_pct")).items()],
    )
    assert rows(priced) == [("o", 0, 1, 9.05, 30.15, 27.15), ("o", 1, 5, 1.0, 1.0, 1.0)]


def test_reconcile_flags_amounts_that_are_off(spark):
    df = spark.createDataFrame(
        [("good", 100.0, 10.0, 90.0, 5.0, 0.1, 9.0, 104.0), ("cent", 100.0, 10.01, 90.0, 5.0, 0.1, 9.01, 104.02),
         ("bad", 100.0, 12.0, 90.0, 5.0, 0.1, 9.5, 99.0), ("null", None, None, None, None, None, None, None),
         ("part", 10.014, 0.0, 10.0, 0.0, 0.1, 1.0, 11.0)],
        "order_id string, gross_total double, discount_total double, net_total double,"
        " shipping_cost double, tax_rate double, tax_amount double, order_total double",
    )
    assert rows(line_ops.reconcile(df)) == [
        ("bad", True, True, True), ("cent", False, False, False),
        ("good", False, False, False), ("null", False, False, False),
        ("part", True, False, False),
    ]


def test_low_stock(spark):
    df = spark.createDataFrame([(38,), (39,)], "s int")
    got = df.select(line_ops.low_stock(F.col("s"), F.lit(10), F.lit(300), 0.10).alias("low"))
    assert [r[0] for r in got.collect()] == [True, False]


def test_code_lookup_and_allow_list(spark):
    codes = spark.createDataFrame([(0, "clear"), (1, "mist")], "code int, label string")
    df = spark.createDataFrame([(0,), (7,), (None,)], "code int")
    assert rows(decode(df, codes, "code", "label", "?")) == sorted(
        [(0, "clear"), (7, "?"), (None, "?")], key=repr
    )
    assert rows(allowed_only(df, codes.select("code"), "code")) == [(0,)]
