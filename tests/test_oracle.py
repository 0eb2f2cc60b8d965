"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import catalog
from check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(catalog.QUERIES[name](spark, FOLDER), con, catalog.ORACLE[name]) is None


def test_window_keeps_deliveries_without_registry_row(spark, tmp_path):
    spark.sql("""SELECT id AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 1d AS l_quantity, 1d AS l_extendedprice, 0d AS l_discount, 0d AS l_tax,
        'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ '1998-04-10 00:00:00' AS l_shipdate FROM range(96, 98)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("""SELECT id AS o_orderkey, 1L AS o_custkey, 'F' AS o_orderstatus, 1d AS o_totalprice, TIMESTAMP_NTZ '1998-04-01 00:00:00' AS o_orderdate,
        '5-LOW' AS o_orderpriority FROM range(96, 98)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = catalog.QUERIES["q14_open_date_window"](spark, str(tmp_path))  # the registry knows receipt 97 as P-97
    assert sorted(r["acuse_estatal"] for r in found.collect()) == ["96", "97"]
