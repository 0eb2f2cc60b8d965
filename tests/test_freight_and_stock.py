from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from granero.operators import filters
from granero.plans import freight, inventory, kpi

FRE = ("folio_del_flete string, estatus string, abreviacion_producto string, toneladas_iniciales decimal(10,3), toneladas_en_el_destino decimal(10,3), "
       "fecha_de_salida date, fecha_de_llegada timestamp_ntz, fecha_de_entrega timestamp_ntz, id_ceda_agricultura string, "
       "cdf_destino_original string, cdf_destino_final string")
MOV = ("cdf_origen string, id_ceda_agricultura string, estatus string, abreviacion_producto string, toneladas_iniciales decimal(10,3), "
       "toneladas_en_el_destino decimal(10,3), fecha_de_salida date, fecha_de_llegada date")
CEN = ("id_ceda_agricultura string, coordinacion_estatal string, estado string, zona_operativa string, nombre_cedas string, "
       "meta_derechohabientes int, meta_superficie_ha int, meta_total_ton decimal(18,3)")
T0 = dt.datetime(2025, 1, 10)


def fre(folio, status, product, sent, got, out=dt.date(2025, 1, 1), arrived=T0, delivered=T0, centre="A"):
    return (folio, status, product, D(sent), D(got) if got else None, out, arrived, delivered, centre, centre, centre)


@pytest.fixture
def centres(frame):
    return frame([("A", "U", "EDO", "Z", "Ceda A", 10, 10, D("100")), ("B", "U", "EDO", "Z", "Ceda B", 0, 0, None)], CEN)


def test_atypical_limits(frame, rows):
    df = frame([fre("a", "Entregado", "DAP", "10", "11"), fre("b", "Entregado", "DAP", "10", "11.001"), fre("c", "Entregado", "DAP", "20", "10"),
                fre("d", "Entregado", "DAP", "20.001", "10"), fre("e", "Autorizado", "DAP", "20", None)], FRE)
    assert [r.folio_del_flete for r in freight.atypical_tons(df).orderBy("folio_del_flete").collect()] == ["b", "d"]


def test_incoherent_dates(frame):
    df = frame([fre("a", "Entregado", "DAP", "1", "1", arrived=dt.datetime(2024, 12, 31)), fre("b", "Entregado", "DAP", "1", "1", delivered=dt.datetime(2024, 1, 1)),
                fre("c", "Entregado", "DAP", "1", "1"), fre("d", "Entregado", "DAP", "1", "1", arrived=None, delivered=dt.datetime(2025, 1, 1, 8)),
                fre("e", "Entregado", "DAP", "1", "1", out=None)], FRE)
    assert sorted(r[0] for r in freight.incoherent_dates(df).select("folio_del_flete").collect()) == ["a", "b"]


def test_transit(frame, centres):
    today = dt.date(2025, 1, 31)
    df = frame([fre("a", "AUTORIZADO", "DAP", "5", None), fre("b", "autorizado", "URE", "7", None, out=dt.date(2025, 1, 2)),
                fre("c", "Entregado", "DAP", "9", "9"), fre("d", None, "DAP", "9", None), fre("e", "Autorizado", "DAP", "1", None, out=None)], FRE)
    detail = {r.folio_del_flete: r for r in freight.transit_detail(df, centres, today).collect()}
    assert set(detail) == {"a", "b", "e"}
    assert detail["a"].demorado and not detail["b"].demorado and not detail["e"].demorado
    s = freight.transit_by_state(df, centres, today).first()
    assert (s.fletes_transito_dap, s.fletes_transito_urea, s.ton_transito_dap, s.total_ton_transito, s.max_dias_en_transito) == (2, 1, D("6"), D("13"), 30)
    empty = freight.transit_footer(freight.transit_by_state(df.filter("false"), centres, today)).first()
    assert empty.max_dias_en_transito == 0 and empty.total_fletes_transito == 0


def test_query_helpers(frame, rows):
    df = frame([fre("a", "Entregado", "DAP", "1", "1", delivered=None), fre("b", "Entregado", "DAP", "1", "1"),
                fre("c", "Entregado", "DAP", "1", "1", delivered=dt.datetime(2025, 1, 10, 23, 59))], FRE)
    assert filters.filter_date_range(df, "fecha_de_entrega", "10/01/2025", "2025-01-10").count() == 2
    assert filters.filter_date_range(df, "fecha_de_entrega", "mañana", None).count() == 3
    order = [r[0] for r in df.orderBy(*filters.order_sql_style("-fecha_de_entrega", "folio_del_flete")).select("folio_del_flete").collect()]
    assert order == ["a", "c", "b"]
    assert [r[0] for r in filters.page(df, 2, 2, "folio_del_flete").select("folio_del_flete").collect()] == ["c"]
    assert filters.clamp_page(9, 2, 3) == 2 and filters.clamp_page(0, 2, 0) == 1
    assert filters.filter_in_list(df, "folio_del_flete", " a \n\n b,c", commas=True).count() == 3
    assert filters.filter_in_list(df, "folio_del_flete", "\n").count() == 3
    assert filters.select_valid_columns(df, ["x"], ["estatus"]).columns == ["estatus"]
    assert freight.freight_query(freight.enriched_freight(df, frame([], CEN)), {"folios_multiline": "a,b"}).count() == 2
    assert freight.freight_summary(df.filter("false")).first().sum_toneladas_iniciales == 0


@pytest.fixture
def flows(frame):
    f = frame([fre("a", "Entregado", "DAP", "10", "9"), fre("b", "Autorizado", "DAP", "10", None), fre("c", "Entregado", "OTR", "5", "5")], FRE)
    none = frame([], MOV)
    moves = frame([("A", "B", "entregada", "DAP", D("12"), D("11"), dt.date(2025, 1, 12), dt.date(2025, 1, 14)),
                   ("A", "B", None, "URE", D("1"), D("1"), dt.date(2025, 1, 20), dt.date(2025, 1, 21))], MOV)
    losses = frame([("B", "DAP", D("1"), dt.date(2025, 1, 15))], "cdf_incidente string, clave_producto string, ton_incidencia decimal(10,3), fecha_incidente date")
    given = frame([("A", D("1"), None, dt.date(2025, 1, 11)), ("Q", D("1"), None, dt.date(2025, 1, 11))],
                  "cdf_entrega string, ton_dap_entregada decimal(10,3), ton_urea_entregada decimal(10,3), fecha_entrega date")
    refill = frame([("Z", "A", "Entregada", "DAP", D("6"), D("6"), dt.date(2025, 1, 1), dt.date(2025, 1, 25))], MOV)
    del none
    return inventory.stock_flows(f, moves, refill, losses, given)


def test_daily_stock(flows, centres):
    stock = inventory.daily_stock(flows, centres, dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    assert stock.count() == 2 * 31
    a = {r.fecha.day: r.dap_ton_inventario_acumulado for r in stock.filter("id_ceda_agricultura = 'A'").collect()}
    assert [a[d] for d in (9, 10, 11, 12, 24, 25, 31)] == [0, 9, 8, -4, -4, 2, 2]
    negative = inventory.negative_stock(stock).groupBy("id_ceda_agricultura").count().collect()
    assert {r[0]: r[1] for r in negative} == {"A": 20}  # DAP on 12-24, then urea from the 20th on
    now = {r.id_ceda_agricultura: r for r in inventory.current_stock(flows, centres).collect()}
    last = {r.id_ceda_agricultura: r for r in stock.filter("fecha = '2025-01-31'").collect()}
    for c in "AB":
        assert now[c].dap_ton_inventario_acumulado == last[c].dap_ton_inventario_acumulado
        assert now[c].urea_ton_inventario_acumulado == last[c].urea_ton_inventario_acumulado
    first = filters.since_first_movement(stock, "id_ceda_agricultura", "fecha", ["dap_ton_total_entrada"], dt.date(2025, 1, 30))
    assert {r[0]: r[1] for r in first.groupBy("id_ceda_agricultura").agg({"fecha": "min"}).collect()} == {"A": dt.date(2025, 1, 10), "B": dt.date(2025, 1, 14)}


def test_field_reports(flows, centres, frame):
    reports = frame([(1, dt.datetime(2025, 1, 11, 8), "A", 100, None, "rc"), (2, dt.datetime(2025, 1, 11, 9), "A", 320, 40, "rc"),
                     (3, dt.datetime(2025, 1, 31, 9), "B", 400, 0, "coz"), (4, None, "A", 1, 1, "rc")],
                    "id_reporte bigint, fecha_y_hora timestamp_ntz, id_ceda_agricultura string, bultos_dap int, bultos_urea int, quien_reporta string")
    day = {(r.id_ceda_agricultura, r.fecha.day): r for r in inventory.field_vs_system(flows, reports, centres).collect()}
    assert set(day) == {("A", 11), ("B", 31)}
    assert day["A", 11].dap_campo == D("8.000") and day["A", 11].dap_sigap == D("8.000") and day["A", 11].dap_campo_vs_sigap == 0
    stats = {r.id_ceda_agricultura: r for r in inventory.field_statistics(flows, reports, centres, dt.date(2025, 2, 1)).collect()}
    assert stats["A"].dias_atraso == 21 and not stats["A"].cumplimiento_status and stats["A"].clase_dap == "excedente_grave"
    assert stats["B"].dias_atraso == 0 and stats["B"].cumplimiento_status and stats["B"].clase_dap == "sin_diferencia"
    tally = inventory.gap_tallies(inventory.field_statistics(flows, reports, centres, dt.date(2025, 2, 1))).first()
    assert (tally.excedentes_graves, tally.sin_reporte) == (2, 1)


def test_supply_with_a_missing_part_is_missing(frame):
    cols = [*kpi.INFLOWS, *kpi.OUTFLOWS, "dap_dh", "urea_dh"]
    schema = "estado string, " + ", ".join(f"{c} decimal(18,3)" for c in cols) + ", dh_apoyados bigint, ha_apoyadas bigint"
    full, hole = [D(1)] * len(cols), [D(1)] * len(cols)
    hole[0] = None
    df = frame([("X", *full, 1, 1), ("X", *hole, 1, 1)], schema)
    assert kpi.progress_by_state(df).first().abasto == D("2")  # 6 in, 4 out, and nothing from the second row


def test_kpi_targets(frame, centres):
    schema = "estado string, derechohabientes int, superficie_ha int, total_ton decimal(18,3)"
    empty = frame([], FRE)
    given = frame([("A", D("90"), D("90"), dt.date(2025, 1, 1), 5)],
                  "cdf_entrega string, ton_dap_entregada decimal(18,3), ton_urea_entregada decimal(18,3), fecha_entrega date, superficie_apoyada int")
    losses = frame([], "cdf_incidente string, clave_producto string, ton_incidencia decimal(10,3), fecha_incidente date")
    progress = kpi.operating_progress(empty, frame([], MOV), frame([], MOV), losses, given, centres)
    official = kpi.national_kpi(progress, frame([("EDO", 0, None, D("100")), ("OTRO", 5, 5, D("5"))], schema)).first()
    assert (official.meta_total_ton, official.porc_entregado, official.pendiente_entregado, official.porc_dh, official.porc_ha) == (D(100), 100, 0, 0, 0)
    none = kpi.national_kpi(progress, frame([("OTRO", 5, 5, D("5"))], schema)).first()
    assert none.meta_total_ton == 0 and none.porc_entregado == 0
    one = kpi.national_kpi(progress, frame([("EDO", 1, 1, D("1"))], schema), id_ceda_agricultura="A").first()
    assert one.meta_total_ton == D(100)  # a chosen centre uses its own target
    table = kpi.state_progress_table(progress, frame([("EDO", 4, 4, D("360"))], schema)).collect()
    assert {(r.estado, r.nivel, r.porc_entregado) for r in table} == {("EDO", 0, 50), (None, 1, 50)}


def test_moves_are_not_interpreted_row_by_row(frame):
    moves = frame([(" Entregada", "A", "B", dt.date(2025, 1, 2), dt.date(2025, 1, 1), "DAP", D("3.000"), D("2.000")),
                   (None, "A", "B", None, dt.date(2025, 1, 1), "URE", D("1.000"), D("1.000"))],
                  "estatus string, id_ceda_agricultura string, cdf_origen string, fecha_de_llegada date, fecha_de_salida date, "
                  "abreviacion_producto string, toneladas_iniciales decimal(8,3), toneladas_en_el_destino decimal(8,3)")
    flows = inventory.move_flows(moves)
    assert sorted((tuple(r) for r in flows.collect()), key=str) == sorted([
        ("A", dt.date(2025, 1, 2), D("2.000"), None, None, None), ("B", dt.date(2025, 1, 1), None, None, D("3.000"), None),
        ("B", dt.date(2025, 1, 1), None, None, None, D("1.000"))], key=str)
    assert "lambda" not in flows._jdf.queryExecution().executedPlan().toString()


def test_reported_stock_is_summed_in_longs(flows, centres, frame):
    reports = frame([(1, dt.datetime(2025, 1, 2, 9), "A", 40, None, "x")],
                    "id_reporte long, fecha_y_hora timestamp_ntz, id_ceda_agricultura string, bultos_dap int, bultos_urea int, quien_reporta string")
    seen = inventory.field_vs_system(flows, reports, centres)
    assert seen.schema["dap_sigap"].dataType.simpleString() == "decimal(29,3)"
    assert "sum(dap#" in (text := seen._jdf.queryExecution().optimizedPlan().toString()) and "RangeFrame" not in text
