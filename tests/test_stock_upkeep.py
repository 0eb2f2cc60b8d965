"""Daily stock kept up by change sets against stock computed anew from all movements."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granero.plans import stock_upkeep
from granero.plans.inventory import FLOWS, daily_stock
from granero.plans.stock_upkeep import build_stock, changed_rows, flow_changes, stock_on, stored_stock, touched_days, update_stock
from granero.sources.sinks import replace_partitions

START, END = dt.date(2025, 1, 10), dt.date(2025, 4, 20)
FLOW = "folio long, id_ceda_agricultura string, fecha date, " + ", ".join(f"{c} decimal(10,3)" for c in FLOWS)
CENTRE = "id_ceda_agricultura string, coordinacion_estatal string, estado string, zona_operativa string, nombre_cedas string"


def movement(rng, folio):
    day = START + dt.timedelta(days=rng.randrange(-40, 140)) if rng.random() < 0.95 else None
    centre = rng.choice(["A", "B", "C", "D", "NUEVA", "FUERA", None])
    return (folio, centre, day, *[Decimal(rng.randrange(1000)) / 8 if rng.random() < 0.6 else None for _ in FLOWS])


def corrected(rng, rows):
    out = {r[0]: r for r in rows}
    for folio in rng.sample(sorted(out), 12):
        if rng.random() < 0.4:
            del out[folio]
        else:
            out[folio] = movement(rng, folio)
    for _ in range(8):
        folio = max(out) + 1
        out[folio] = movement(rng, folio)
    return list(out.values())


@pytest.fixture
def centres(frame):
    return lambda ids, name="x": frame([(i, "U", "E", None, f"{i} {name}") for i in ids], CENTRE)


def as_rows(df):
    names = sorted(set(df.columns) - {"zona_operativa"})  # NULL in all rows
    return sorted(tuple(r[c] for c in names) for r in df.select(names).collect())


def test_change_sets_give_what_the_whole_history_gives(spark, frame, centres, tmp_path):
    rng, path = random.Random(1), str(tmp_path / "existencias")
    rows = [movement(rng, i) for i in range(120)]
    flows = frame(rows, FLOW)
    listed, end = ["A", "B", "C", "D"], END - dt.timedelta(days=45)
    build_stock(flows, centres(listed), path, START, end, buckets=3)
    assert as_rows(stored_stock(spark, path)) == as_rows(daily_stock(flows, centres(listed), START, end))
    for step, (ids, name, until) in enumerate([
            (listed, "x", None), (["A", "B", "D", "NUEVA"], "x", END), (["A", "B", "D", "NUEVA"], "y", None)]):
        newer = corrected(rng, rows)
        after = frame(newer, FLOW)
        changes = flow_changes(*changed_rows(flows, after))
        end = max(end, until or end)
        written = update_stock(spark, path, f"c{step}", changes, centres(ids, name), after, until)
        assert written and update_stock(spark, path, f"c{step}", changes, centres(ids, name), after, until) == []
        assert as_rows(stored_stock(spark, path)) == as_rows(daily_stock(after, centres(ids, name), START, end))
        rows, flows = newer, after
    whole = daily_stock(flows, centres(ids, name), START, end)
    assert as_rows(stock_on(spark, path, dt.date(2025, 3, 3))) == as_rows(whole.filter("fecha = DATE '2025-03-03'").drop(*FLOWS))
    months = {r["fecha"] for r in spark.read.parquet(f"{path}/cierres").select("fecha").distinct().collect()}
    assert months == {dt.date(2025, 1, 31), dt.date(2025, 2, 28), dt.date(2025, 3, 31), END}


def test_nothing_changes_without_changes(spark, frame, centres, tmp_path):
    path, flows = str(tmp_path / "existencias"), frame([(1, "A", START, None, None, None, None)], FLOW)
    build_stock(flows, centres(["A"]), path, START, END, buckets=2)
    before = as_rows(stored_stock(spark, path))
    assert update_stock(spark, path, "nada", flow_changes(*changed_rows(flows, flows)), centres(["A"])) == []
    assert as_rows(stored_stock(spark, path)) == before
    with pytest.raises(ValueError):
        update_stock(spark, path, "tarde", flows.limit(0), centres(["A"]), end=END + dt.timedelta(days=1))


def test_a_broken_run_is_taken_up(spark, frame, centres, tmp_path, monkeypatch):
    rng, path = random.Random(2), str(tmp_path / "existencias")
    rows = [movement(rng, i) for i in range(60)]
    newer = corrected(rng, rows)
    build_stock(frame(rows, FLOW), centres("ABCD"), path, START, END, buckets=2)
    changes = flow_changes(*changed_rows(frame(rows, FLOW), frame(newer, FLOW)))
    whole, real = as_rows(daily_stock(frame(newer, FLOW), centres("ABCD"), START, END)), stock_upkeep.overwrite_table

    def broken(df, target, keys):
        real(df, target, keys)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(stock_upkeep, "overwrite_table", broken)
    with pytest.raises(RuntimeError):
        update_stock(spark, path, "c", changes, centres("ABCD"))
    monkeypatch.setattr(stock_upkeep, "overwrite_table", real)
    assert update_stock(spark, path, "c", changes, centres("ABCD"))
    assert as_rows(stored_stock(spark, path)) == whole


def test_only_touched_partitions_are_read(spark, frame, centres, tmp_path):
    path = str(tmp_path / "existencias")
    build_stock(frame([(1, "A", START, None, None, None, None)], FLOW), centres("ABCD"), path, START, END, buckets=2)
    days = touched_days(spark, path, {1: 202503})
    text = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "(cubeta#" in text and "(mes#" in text and "DataFilters: []" in text
    read = {r[0] for r in days.select(F.input_file_name()).distinct().collect()}
    assert read and all("cubeta=1" in f and ("mes=202503" in f or "mes=202504" in f) for f in read)


def test_changes_are_not_spread_over_the_calendar(spark, frame, centres, tmp_path, monkeypatch):
    path, real, seen = str(tmp_path / "existencias"), stock_upkeep._placed, []
    old, new = frame([(1, "A", START, Decimal(1), None, None, None)], FLOW), frame([(1, "A", START, Decimal(2), None, None, None)], FLOW)
    build_stock(old, centres("AB"), path, START, END, buckets=2)
    monkeypatch.setattr(stock_upkeep, "_placed", lambda days, buckets: seen.append(days) or real(days, buckets))
    assert update_stock(spark, path, "c", flow_changes(*changed_rows(old, new)), centres("AB"))
    written = [d._jdf.queryExecution().executedPlan().toString() for d in seen if set(stock_upkeep.STOCKS) <= set(d.columns)]
    assert written and not any("Generate explode(sequence(" in text for text in written)  # its size is taken for that of the changes, so it was broadcast


def test_a_centre_without_id_keeps_all_its_days(spark, frame, centres, tmp_path):
    path, flows = str(tmp_path / "existencias"), frame([(1, "A", START, Decimal(3), None, None, None)], FLOW).drop("folio")
    listed, before = centres(["A", None]), END - dt.timedelta(days=30)
    build_stock(flows, listed, path, START, before, buckets=2)
    for step, end in enumerate((END - dt.timedelta(days=10), END)):
        assert update_stock(spark, path, f"c{step}", flows.limit(0), listed, flows, end)
    seen = stored_stock(spark, path).groupBy("id_ceda_agricultura").agg(F.count("*"), F.max("fecha"), F.max("dap_ton_inventario_acumulado")).collect()
    days = (END - START).days + 1
    assert {tuple(r) for r in seen} == {("A", days, END, Decimal(3)), (None, days, END, Decimal(0))}


def test_moved_days_come_out_of_one_shuffle_and_sort_as_they_are_stored(spark, frame, centres):
    days = stock_upkeep._placed(daily_stock(frame([(1, "A", START, Decimal(3), None, None, None)], FLOW), centres("AB"), START, END), 2)
    changes = days.select("id_ceda_agricultura", "fecha", "mes", "cubeta", F.struct(F.col("fecha").alias("dia"), *FLOWS, *stock_upkeep.STOCKS).alias("_c"))
    names = days.select("id_ceda_agricultura", "fecha", "mes", "cubeta", F.struct("estado").alias("_n"))
    rows = stock_upkeep._moved(days.select("id_ceda_agricultura", "fecha", *FLOWS, *stock_upkeep.STOCKS, "mes", "cubeta"), changes, names)
    text = rows.sortWithinPartitions("mes", "cubeta")._jdf.queryExecution().executedPlan().toString()
    above = text[:text.index("REPARTITION_BY_NUM")]
    assert "Exchange" not in above[:above.rindex("Exchange")] and above.count("Sort [") == 1


def test_partitions_take_their_place_once(spark, tmp_path):
    fresh, path = str(tmp_path / "nuevos"), str(tmp_path / "tabla")
    for place, value in ((path, "old"), (fresh, "new")):
        spark.createDataFrame([(1, value), (2, value), (3, value)], "mes int, v string").write.partitionBy("mes").parquet(place)
    replace_partitions(spark, fresh, path, ["mes=1"])
    replace_partitions(spark, fresh, path, ["mes=1", "mes=2"])  # the first one is there already
    assert sorted((r["mes"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "new"), (2, "new"), (3, "old")]
