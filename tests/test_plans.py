"""What the plans must and must not contain."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

import catalog
from catalog.base import Roles
from granero.operators import dedupe, filters, sorted_layout
from granero.plans import progress
from granero.sources import receipts
from granero.streaming import field_reports

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
# queries whose result is read back from files they write
WRITERS = ("s1_", "s2_", "s4_", "s7_", "s9_", "k1_", "k2_", "k3_", "k4_", "k5_", "k6_", "k9_", "r1_", "r2_", "b1_", "l1_null", "l2_", "deliveries_query_page", "load_order_lines", "v26_incremental", "j3_bucketed", "j6_bucketed",
           "a11_quantile_of_table", "a11_quantile_with")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(catalog.QUERIES) if not n.startswith(WRITERS)])
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "ExistingRDD"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark):
    orders = Roles(spark, FOLDER).raw("orders")
    text = plan(filters.filter_date_range(orders, "o_orderdate", "01/01/1998", "31/12/1998").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_grid_shuffles_movement_days_only(spark):
    text = plan(catalog.QUERIES["v3_progress_vs_target"](spark, FOLDER))
    after_expansion = text[: text.index("Generate explode(sequence")]
    assert "Exchange" not in after_expansion and "Join" not in after_expansion


def test_first_per_key_combines_before_the_shuffle(spark):
    text = plan(catalog.QUERIES["w3_first_per_key"](spark, FOLDER))
    assert "partial_min" in text and "Window" not in text


def test_a_long_list_leaves_the_facts_where_they_are(spark):
    text = plan(catalog.QUERIES["q4_long_list"](spark, FOLDER))
    deliveries = Roles(spark, FOLDER).raw("orders").selectExpr("cast(o_orderkey AS string) AS k")
    listed = plan(filters.filter_in_list(deliveries, "k", "\n".join(map(str, range(5000)))))
    assert "BroadcastHashJoin" in text and "Exchange hash" not in listed and "SortMergeJoin" not in listed


def test_tables_by_receipt_meet_without_a_shuffle(spark, tmp_path):
    roles = Roles(spark, FOLDER)
    registry, deliveries = (receipts.store_by_receipt(df, str(tmp_path / n), 4) for n, df in (("p", roles.registry()), ("d", roles.deliveries())))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (progress.unregistered_deliveries(deliveries, registry), progress.unique_registry(registry),
                   progress._delivery_list(deliveries, registry), dedupe.difference_report(deliveries, registry, "acuse_estatal", ["curp_renapo"])):
            text = plan(df)
            assert "Exchange" not in text and "Bucketed: true" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_by_receipt_are_merged_and_found_again(spark, frame, tmp_path):
    path, schema = str(tmp_path / "p"), "acuse_estatal string, v int"
    receipts.merge_by_receipt(frame([("a", 1), ("b", 1), ("c", 1)], schema), path, 3)
    receipts.merge_by_receipt(frame([("b", 2), ("d", 3), ("d", 2)], schema), path, 3)
    spark.sql(f"DROP TABLE {receipts._table_name(path)}")  # as in a later session
    again = receipts.read_by_receipt(spark, path)
    assert sorted(map(tuple, again.collect())) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)] and "Exchange" not in plan(again.groupBy("acuse_estatal").count())


def test_a_batch_of_reports_reads_its_own_days(spark, frame, tmp_path):
    path, day = str(tmp_path / "reportes"), dt.date(2025, 1, 1)
    stored = frame([(f"h{i}", day + dt.timedelta(days=i)) for i in range(30)], "hash_respuesta string, fecha_registro date")
    stored.write.partitionBy("fecha_registro").parquet(path)
    batch = frame([("h0", day), ("x", day), ("h29", day + dt.timedelta(days=29)), ("y", day + dt.timedelta(days=29))], "hash_respuesta string, fecha_registro date")
    near = spark.read.schema(stored.schema).parquet(path)
    found = field_reports.unseen_reports(batch, near, [r[0] for r in batch.select("fecha_registro").distinct().collect()])
    assert {r["hash_respuesta"] for r in found.collect()} == {"x", "y"}
    text = plan(found)
    assert "PartitionFilters: [" in text and "fecha_registro" in text[text.index("PartitionFilters: ["):] and " IN (" in text


def test_a_page_of_a_stored_order_reads_its_parts_and_sorts_no_table(spark, frame, tmp_path):
    path = str(tmp_path / "orden")
    rows = [(i, None if i % 7 == 0 else i * i % 100) for i in range(1, 1001)]
    sorted_layout.store_sorted(frame(rows, "id int, v int"), path, "-v", "id")
    expect = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    parts = spark.read.parquet(f"{path}/partes").count()
    for number in (1, 2, 17, 40, 99):
        page = sorted_layout.sorted_page(spark, path, number, 25)
        start = (min(number, 40) - 1) * 25
        assert [tuple(r) for r in page.collect()] == expect[start:start + 25]
        text = plan(page)
        assert "PartitionFilters: [" in text and "_parte#" in text[text.index("PartitionFilters: ["):]
    sizes = [(7, 300, 0), (8, 300, 300), (9, 400, 600)]
    assert parts >= 1 and sorted_layout.places_of_page(sizes, 4, 100) == [(8, 0, 100)]
    assert sorted_layout.places_of_page(sizes, 2, 250) == [(7, 250, 300), (8, 0, 200)]
    assert sorted_layout.places_of_page(sizes, 99, 300) == [(9, 300, 400)] and sorted_layout.places_of_page([], 1, 10) == []
    sorted_layout.store_sorted(frame([], "id int, v int"), str(tmp_path / "nada"), "id")
    assert sorted_layout.sorted_page(spark, str(tmp_path / "nada"), 3, 10).collect() == []
