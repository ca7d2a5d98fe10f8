"""Every registered query against its SQL counterpart, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from oracle.sql import all_oracles
from shopstrata.plans.catalogue import all_queries
from tests.compare import differences, open_oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = open_oracle(FOLDER)
    yield con
    con.close()


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_counterpart(spark, oracle, name):
    df = all_queries()[name](spark, FOLDER)
    assert differences(df, oracle, all_oracles()[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["order_date", "revenue_usd"] and df.count() > 0
