"""The batch as a graph: order, steps side by side, reruns, what a failure leaves behind."""

from __future__ import annotations

import datetime as dt
import threading
from graphlib import CycleError

import pytest

from granero.plans import batch, batch_graph
from granero.plans.batch import Step
from granero.plans.batch_graph import code_fingerprint, export_steps, in_order, read_manifest, run_graph, stored_fingerprint


def taken(name, log=None, *needs, export=False):
    def build(tables):
        if log is not None:
            log.append(name)
        return tables[needs[0]]
    return Step(name, needs, build, export)


def statuses(outcomes):
    return {o.name: o.status for o in outcomes}


def test_order_of_the_graph():
    steps = [taken("c", None, "b"), taken("d", None, "c", "a"), taken("b", None, "a"), taken("a", None, "x")]
    names = [s.name for s in in_order(steps)]
    assert all(names.index(n) < names.index(s.name) for s in steps for n in s.needs if n != "x")
    with pytest.raises(CycleError):
        in_order([taken("a", None, "b"), taken("b", None, "a")])


def test_independent_steps_run_side_by_side(spark, frame, tmp_path):
    both = threading.Barrier(2, timeout=60)  # passes only when two steps are being built at once

    def build(tables):
        both.wait()
        return tables["x"]

    steps = [Step("a", ("x",), build), Step("b", ("x",), build), taken("c", None, "a")]
    assert statuses(run_graph(spark, {"x": frame([(1,)], "id int")}, str(tmp_path), steps)) == {"a": "ok", "b": "ok", "c": "ok"}


def test_a_rerun_builds_what_failed_and_what_needs_it(spark, frame, tmp_path):
    out, log, fails = str(tmp_path), [], [True]

    def shaky(tables):
        log.append("b")
        if fails:
            raise RuntimeError("sin espacio")
        return tables["a"]

    steps = [taken("a", log, "x", export=True), Step("b", ("a",), shaky), taken("c", log, "b"), taken("d", log, "a")]
    run = dict(fingerprints={"x": "1"}, code="1")
    x = frame([(1,), (2,)], "id int")
    first = run_graph(spark, {"x": x}, out, steps, **run)
    assert statuses(first) == {"a": "ok", "b": "error", "c": "omitida", "d": "ok"} and "sin espacio" in {o.error for o in first}
    fails.clear()
    log.clear()
    assert statuses(run_graph(spark, {"x": x}, out, steps, **run)) == {"a": "vigente", "b": "ok", "c": "ok", "d": "vigente"}
    assert log == ["b", "c"]
    log.clear()
    assert set(statuses(run_graph(spark, {"x": x}, out, steps, **run)).values()) == {"vigente"} and not log
    assert {(r["paso"], r["filas"]) for r in read_manifest(spark, out).collect()} == {(n, 2) for n in "abcd"}
    for change in (dict(fingerprints={"x": "2"}, code="1"), dict(fingerprints={"x": "2"}, code="2"), dict(fingerprints={"x": "2"}, code="2", parameters="p")):
        assert set(statuses(run_graph(spark, {"x": x}, out, steps, **change)).values()) == {"ok"}
    assert set(statuses(run_graph(spark, {"x": x}, out, steps, code="2")).values()) == {"ok"}  # a source without fingerprint


def test_a_failure_keeps_the_last_good_table_apart(spark, frame, tmp_path):
    out, x = str(tmp_path), frame([(1,)], "id int")
    good = [taken("a", None, "x", export=True), taken("b", None, "a")]
    run_graph(spark, {"x": x}, out, good, code="1")
    broken = [Step("a", ("x",), lambda t: t["x"].selectExpr("raise_error('mal')"), True), good[1]]
    assert statuses(run_graph(spark, {"x": x}, out, broken, code="1")) == {"a": "error", "b": "omitida"}
    rows = {r["paso"]: r for r in read_manifest(spark, out).collect()}
    assert spark.read.parquet(rows["a"]["tabla_anterior"]).count() == spark.read.parquet(rows["b"]["tabla_anterior"]).count() == 1
    assert not (tmp_path / "a").exists() and not (tmp_path / "b").exists() and not (tmp_path / "csv" / "a").exists()
    assert set(statuses(run_graph(spark, {"x": x}, out, good, code="1")).values()) == {"ok"} and (tmp_path / "csv" / "a").exists()


def test_only_some_steps(spark, frame, tmp_path):
    out, log, x = str(tmp_path), [], frame([(1,)], "id int")
    steps = [taken("a", log, "x"), taken("b", log, "a"), taken("c", log, "x")]
    assert statuses(run_graph(spark, {"x": x}, out, steps, only=["a"], code="1")) == {"a": "ok", "b": "omitida", "c": "omitida"}
    assert statuses(run_graph(spark, {"x": x}, out, steps, only=["b"], code="2")) == {"a": "vigente", "b": "ok", "c": "omitida"}
    assert log == ["a", "b"]


def test_fingerprints(spark, frame, tmp_path):
    path = str(tmp_path / "tabla")
    frame([(1,)], "id int").write.parquet(path)
    before = stored_fingerprint(spark, path)
    assert before == stored_fingerprint(spark, path)
    frame([(1,), (2,)], "id int").write.mode("append").parquet(path)
    assert before != stored_fingerprint(spark, path) and code_fingerprint() == code_fingerprint()


def test_exports_and_loads_of_the_day():
    day = dt.date(2025, 1, 1)
    names = [s.name for s in export_steps(day, day)]
    daily = [s.name for s in batch.daily_steps(2025, day, day)]
    assert len(names) == len(set(names)) == 24 and all(s.export for s in export_steps(day, day)) and not set(names) & set(daily)
    loads = {s.name for s in batch.load_steps() if not s.name.endswith("_rechazos")}
    assert loads == {"centres", "order_lines", "order_summary", "freight", "transfers", "remnants", "incidents", "deliveries", "field_reports"}
    assert in_order([*batch.load_steps(), *batch.daily_steps(2025, day, day), *batch_graph.export_steps(day, day)])


def test_steps_a_table_is_built_from():
    steps = batch.daily_steps(1998, dt.date(1998, 1, 1), dt.date(1998, 1, 2))
    assert [s.name for s in batch.steps_for(steps, "padron")] == ["padron"]
    assert [s.name for s in batch.steps_for(steps, "avance_listado_estado")] == [
        "entregas", "padron", "avance_por_listado", "avance_listado_ceda", "avance_listado_estado"]
    assert [s.name for s in batch.steps_for(steps, *[s.name for s in steps])] == [s.name for s in steps]


def test_deliveries_are_reduced_once_for_all_exports(spark, monkeypatch):
    from catalog import files
    from granero.plans.driver_roles import Roles

    seen = {}
    monkeypatch.setattr(files.batch_graph, "run_graph", lambda spark, sources, *a, **k: seen.update(sources))
    monkeypatch.setattr(files.batch_graph, "read_manifest", lambda spark, out: spark.range(0).selectExpr("id AS paso", "id AS estado", "id AS filas"))
    files._graph(Roles(spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in seen["entregas"]._jdf.queryExecution().executedPlan().toString()
