from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal as D

import pytest

from granero.operators.daily import day_spans
from granero.plans import progress

REG = ("acuse_estatal string, id_ceda_agricultura string, estatus string, superficie bigint, dap_ton decimal(18,3), urea_ton decimal(18,3), "
       "primer_apellido string, segundo_apellido string, nombre string, fecha_de_publicacion date")
DEL = ("acuse_estatal string, cdf_entrega string, curp_renapo string, cultivo string, ton_dap_entregada decimal(18,3), "
       "ton_urea_entregada decimal(18,3), fecha_entrega date, superficie_apoyada int")
CEN = "id_ceda_agricultura string, coordinacion_estatal string, estado string, zona_operativa string, nombre_cedas string"


def reg(a, c, s, dap="1.000", urea="2.000", pub=dt.date(2025, 1, 1)):
    return (a, c, s, 2, D(dap) if dap else None, D(urea) if urea else None, "AP", None, "N", pub)


def dlv(a, c, day, dap="0.500", urea="0.250"):
    return (a, c, "X", "MAIZ", D(dap) if dap else None, D(urea) if urea else None, day, 1)


@pytest.fixture
def tables(frame):
    registry = frame([
        reg("1", "A", "Nuevo INGRESO 1"), reg("2", "A", "Nuevo INGRESO 1", urea=None), reg("2", "A", "Nuevo INGRESO 1", urea=None),
        reg("3", "A", None), reg("4", "B", "directo"), reg("5", "ZZ", "directo"), reg("6", "YY", "directo"), reg("7", "A", "directo", pub=None)], REG)
    deliveries = frame([
        dlv("1", "A", dt.date(2025, 1, 1)), dlv("2", "A", dt.date(2025, 1, 3), urea=None), dlv("3", "A", dt.date(2025, 5, 5)),
        dlv("4", "C", dt.date(2025, 2, 2)), dlv("99", "A", dt.date(2025, 2, 2)), dlv("5", "ZZ", dt.date(2025, 12, 31)),
        dlv("7", "A", dt.date(2024, 12, 31)), dlv("6", "B", None)], DEL)
    centres = frame([("A", "U", "EDO", "Z1", "Ceda A"), ("B", "U", "EDO", "Z1", "Ceda B"), ("B", "U", "EDO", "Z1", "Ceda B"),
                     ("C", "U", "OTRO", "Z2", "Ceda C")], CEN)
    return deliveries, registry, centres


def test_targets(tables):
    _, registry, centres = tables
    got = {(r.id_ceda_agricultura, r.estatus): r for r in progress.targets_by_centre(registry, centres).collect()}
    assert got["A", "Nuevo INGRESO 1"].meta_dh == 2  # the repeated receipt counts once
    assert got["A", "Nuevo INGRESO 1"].meta_dap_ton == D("2.000")
    assert got["A", "Nuevo INGRESO 1"].meta_total_ton == D("3.000")  # the row with a missing part is skipped
    assert got[None, "directo"].meta_dh == 2  # centres outside the network fall together
    assert got["A", None].incorporacion == "ACCESO DIRECTO"


def test_daily_grid(tables):
    deliveries, registry, centres = tables
    days = progress.daily_progress(deliveries, registry, centres, 2025)
    pairs = 6  # A x 3 statuses, B, ZZ, YY
    assert days.count() == pairs * 365
    assert days.groupBy("id_ceda_agricultura", "estatus", "fecha").count().filter("count > 1").count() == 0
    moved = {(r.id_ceda_agricultura, r.estatus, r.fecha): r.avance_dh for r in days.filter("avance_dh > 0").collect()}
    assert moved == {("A", "Nuevo INGRESO 1", dt.date(2025, 1, 1)): 1, ("A", "Nuevo INGRESO 1", dt.date(2025, 1, 3)): 1,
                     ("ZZ", "directo", dt.date(2025, 12, 31)): 1}
    # what the grid loses: a NULL status, and a centre the registry does not pair with the status
    lost = {(r.id_ceda_agricultura, r.estatus): r.avance_dh for r in progress.lost_progress(deliveries, registry, 2025).collect()}
    assert lost == {("A", None): 1, ("C", "directo"): 1}
    total = deliveries.join(progress.unique_registry(registry), "acuse_estatal").filter("year(fecha_entrega) = 2025").count()
    assert total == sum(moved.values()) + sum(lost.values())


def test_running_totals_and_percent(tables):
    deliveries, registry, centres = tables
    got = progress.progress_vs_target(deliveries, registry, centres, 2025)
    a = got.filter("id_ceda_agricultura = 'A' AND estatus = 'Nuevo INGRESO 1'").orderBy("fecha").collect()
    assert [r.avance_dh_acum for r in a[:4]] == [1, 1, 2, 2] and a[-1].avance_dh_acum == 2
    assert a[0].avance_pct_dh_acum == D("50.00") and a[-1].avance_pct_dh_acum == D("100.00")
    assert a[-1].avance_total_ton_acum == D("0.750") and a[-1].avance_pct_ton_acum == D("25.00")
    assert all(x.fecha < y.fecha for x, y in zip(a, a[1:]))
    outside = got.filter("id_ceda_agricultura = 'ZZ'").orderBy("fecha").collect()[-1]
    assert outside.meta_dh is None and outside.avance_pct_dh_acum == 0 and outside.avance_dh_acum == 1
    unnamed = got.filter("estatus IS NULL").first()
    assert unnamed.meta_dh is None and unnamed.avance_pct_dh_acum == 0


def test_lists(tables, frame):
    deliveries, registry, centres = tables
    centres = centres.distinct()
    rows = {r.acuse_estatal: r for r in progress.delivery_list(deliveries, registry.dropDuplicates(["acuse_estatal"]), centres).collect()}
    assert rows["2"].total_ton == D("0.500")  # a missing part counts 0 here
    assert rows["1"].dias_transcurridos_entrega == 1 and rows["6"].dias_transcurridos_entrega is None
    assert rows["99"].tipo_incorporacion == "ACCESO_DIRECTO" and rows["99"].listado is None
    by_centre = progress.list_progress_by_centre(deliveries, registry.dropDuplicates(["acuse_estatal"]), centres)
    a = by_centre.filter("id_ceda_agricultura = 'A'").first()
    assert (a.ni_apoyados, a.ad_apoyados) == (2, 3)
    by_state = progress.list_progress_by_state(by_centre)
    assert by_state.selectExpr("sum(ad_apoyados + ni_apoyados)").first()[0] == deliveries.count()


def test_late_deliveries_start_at_151_days(frame, tables):
    _, _, centres = tables
    registry = frame([reg("1", "A", "x"), reg("2", "A", "x")], REG)
    deliveries = frame([dlv("1", "A", dt.date(2025, 1, 1) + dt.timedelta(149)), dlv("2", "A", dt.date(2025, 1, 1) + dt.timedelta(150))], DEL)
    assert progress.list_progress_by_centre(deliveries, registry, centres.distinct()).first().mas_de_150_dias == 1


def test_daily_totals_are_sums_of_longs(frame):
    """Corrections below zero on the first day, facts before it, NULLs; amounts of 15 digits before the point stay exact."""
    day, big = dt.date(1998, 1, 1), D("900000000000000.123")
    facts = frame([("a", dt.date(1997, 5, 1), D("1.001"), 2), ("a", dt.date(1997, 6, 1), big, 1), ("a", day, D("-7.500"), -3),
                   ("a", dt.date(1998, 1, 3), None, 4), ("b", dt.date(1998, 1, 2), D("-0.001"), None), ("x", day, big, 1)],
                  "k string, fecha date, ton decimal(18,3), n long")
    spans = day_spans(facts, frame([("a", "A"), ("b", "B"), ("c", "C")], "k string, nombre string"), ["k"], ("ton", "n"), day,
                      dt.date(1998, 1, 3), totals=("ton", "n"))
    got = sorted((r["k"], r["nombre"], r["fecha"].day, r["hasta"].day, r["ton"], r["n"], r["ton_acum"], r["n_acum"]) for r in spans.collect())
    a = big + D("-6.499")
    assert got == [("a", "A", 1, 2, D("-7.500"), -3, a, 0), ("a", "A", 3, 3, 0, 4, a, 4), ("b", "B", 1, 1, 0, 0, 0, 0),
                   ("b", "B", 2, 3, D("-0.001"), 0, D("-0.001"), 0), ("c", "C", 1, 3, 0, 0, 0, 0)]
    assert spans.schema["ton_acum"].dataType == facts.schema["ton"].dataType
    # no sum over decimals beyond a long, which cost most of the grid's time
    assert re.search(r"sum\(_sum_ton#\d+L\)", spans._jdf.queryExecution().optimizedPlan().toString())


def test_spans_take_one_sort_and_no_aggregate(frame):
    """A key's rows are put in order once: the spine's, what came before the first day, the facts."""
    day = dt.date(1998, 1, 1)
    facts = frame([("a", day, D("1.000"))], "k string, fecha date, ton decimal(18,3)")
    spans = day_spans(facts, frame([("a", "A")], "k string, nombre string"), ["k"], ("ton",), day, dt.date(1998, 1, 3), totals=("ton",))
    text = spans._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == text.count("Window [") == 1 and "Aggregate" not in text


def test_totals_need_not_be_shown(frame):
    day = dt.date(1998, 1, 1)
    facts = frame([("a", dt.date(1997, 5, 1), D("1.000"), 5), ("a", day, D("2.000"), 7)], "k string, fecha date, ton decimal(18,3), n long")
    spans = day_spans(facts, frame([("a",)], "k string"), ["k"], ("ton",), day, dt.date(1998, 1, 3), totals=("n",))
    assert [r.asDict() for r in spans.collect()] == [{"k": "a", "fecha": day, "hasta": dt.date(1998, 1, 3), "ton": D("2.000"), "n_acum": 12}]
