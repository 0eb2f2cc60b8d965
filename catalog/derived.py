"""Derived tables V1-V34, the directory and the KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import register
from granero.plans import deliveries as dl
from granero.plans import directory, freight, inventory, kpi, orders, progress, stock_upkeep
from granero.session import scratch_path
from granero.sources import receipts

YEAR = 1998
START, END = dt.date(1998, 1, 1), dt.date(1998, 12, 31)
ALL_START, ALL_END = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
TODAY = dt.date(2001, 12, 1)
REPORT_DAY = dt.date(1999, 6, 11)
NOW = dt.datetime(2025, 6, 30, 12, 0)

# ---- targets and progress ------------------------------------------------------------------------

UNIQ = """
u AS (SELECT *, CASE WHEN estatus ILIKE '%nuevo ingreso%' THEN 'NUEVO INGRESO' ELSE 'ACCESO DIRECTO' END AS incorporacion
      FROM registry),
rd AS (SELECT coordinacion_estatal AS unidad_operativa, estado, zona_operativa, id_ceda_agricultura, nombre_cedas
       FROM centres)"""
V1 = """
SELECT rd.unidad_operativa, rd.estado, rd.zona_operativa, rd.id_ceda_agricultura, rd.nombre_cedas, u.estatus,
  u.incorporacion, count(*) AS meta_dh, sum(superficie) AS meta_superficie, sum(dap_ton) AS meta_dap_ton,
  sum(urea_ton) AS meta_urea_ton, sum(dap_ton + urea_ton) AS meta_total_ton
FROM u LEFT JOIN rd ON rd.id_ceda_agricultura = u.id_ceda_agricultura GROUP BY ALL"""
V2 = f"""
SELECT rd.unidad_operativa, rd.estado, rd.zona_operativa, s.id_ceda_agricultura, rd.nombre_cedas, s.estatus,
  s.incorporacion, s.fecha, coalesce(avance_dh, 0) AS avance_dh, coalesce(avance_superficie, 0) AS avance_superficie,
  coalesce(avance_dap_ton, 0) AS avance_dap_ton, coalesce(avance_urea_ton, 0) AS avance_urea_ton,
  coalesce(avance_total_ton, 0) AS avance_total_ton
FROM (SELECT DISTINCT id_ceda_agricultura, estatus, incorporacion, CAST(f AS DATE) AS fecha FROM u,
      generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) g(f)) s
LEFT JOIN (SELECT d.cdf_entrega, u.estatus, u.incorporacion, fecha_entrega, count(*) AS avance_dh,
    sum(superficie_apoyada) AS avance_superficie, sum(ton_dap_entregada) AS avance_dap_ton,
    sum(ton_urea_entregada) AS avance_urea_ton, sum(ton_dap_entregada + ton_urea_entregada) AS avance_total_ton
  FROM deliveries d JOIN u ON u.acuse_estatal = d.acuse_estatal
  WHERE fecha_entrega BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL) a
  ON a.cdf_entrega = s.id_ceda_agricultura AND a.estatus = s.estatus AND a.incorporacion = s.incorporacion
  AND a.fecha_entrega = s.fecha
LEFT JOIN rd ON rd.id_ceda_agricultura = s.id_ceda_agricultura"""
TON5 = "avance_dap_ton avance_urea_ton avance_total_ton"
META3 = "meta_dap_ton meta_urea_ton meta_total_ton"


def _with(body: str, *ctes: str) -> str:
    return f"SELECT * FROM (WITH {', '.join(ctes)} {body}) AS w"


register("v1_targets_by_centre", lambda r: progress.targets_by_centre(r.registry(), r.centres()),
         "centres registry", _with(V1, UNIQ), dbl=META3, big="meta_dh meta_superficie")
register("v1_targets_by_publication", lambda r: progress.targets_by_centre(r.registry(), r.centres(), by_publication=True),
         "centres registry", _with(V1.replace("u.incorporacion, count", "u.incorporacion, u.fecha_de_publicacion, count"), UNIQ),
         dbl=META3, big="meta_dh meta_superficie")
register("v2_daily_progress", lambda r: progress.daily_progress(r.deliveries(), r.registry(), r.centres(), YEAR),
         "centres registry deliveries", _with(V2, UNIQ), dbl=TON5, big="avance_dh avance_superficie")
register("v2_lost_progress",
         lambda r: progress.lost_progress(r.deliveries(), r.registry(), YEAR),
         "registry deliveries", _with(f"""
SELECT d.cdf_entrega AS id_ceda_agricultura, u.estatus, u.incorporacion, fecha_entrega AS fecha, count(*) AS avance_dh,
  sum(superficie_apoyada) AS avance_superficie, sum(ton_dap_entregada) AS avance_dap_ton,
  sum(ton_urea_entregada) AS avance_urea_ton, sum(ton_dap_entregada + ton_urea_entregada) AS avance_total_ton
FROM deliveries d JOIN u ON u.acuse_estatal = d.acuse_estatal
WHERE fecha_entrega BETWEEN DATE '{START}' AND DATE '{END}' AND NOT EXISTS (SELECT 1 FROM u k WHERE
  k.id_ceda_agricultura = d.cdf_entrega AND k.estatus = u.estatus AND k.incorporacion = u.incorporacion)
GROUP BY ALL""", UNIQ.split("rd AS")[0].rstrip().rstrip(",")),
         dbl=TON5, big="avance_dh avance_superficie")

_P = "PARTITION BY a.id_ceda_agricultura, a.estatus ORDER BY a.fecha ROWS UNBOUNDED PRECEDING"
_ACC = ", ".join(f"sum(a.avance_{m}) OVER ({_P}) AS avance_{m}_acum"
                 for m in ("dh", "superficie", "dap_ton", "urea_ton", "total_ton"))
V3 = f"""
SELECT *, CASE WHEN meta_dh > 0 THEN CAST((20000 * CAST(avance_dh_acum AS HUGEINT) + meta_dh) // (2 * meta_dh) AS DOUBLE) / 100
    ELSE 0 END AS avance_pct_dh_acum,
  CASE WHEN meta_total_ton > 0 THEN CAST((20000 * CAST(avance_total_ton_acum * 1000 AS HUGEINT) + CAST(meta_total_ton * 1000 AS HUGEINT))
    // (2 * CAST(meta_total_ton * 1000 AS HUGEINT)) AS DOUBLE) / 100 ELSE 0 END AS avance_pct_ton_acum
FROM (SELECT a.*, meta_dh, meta_superficie, meta_dap_ton, meta_urea_ton, meta_total_ton, {_ACC}
  FROM v2 a LEFT JOIN v1 m ON m.id_ceda_agricultura = a.id_ceda_agricultura AND m.estatus = a.estatus) z"""
register("v3_progress_vs_target", lambda r: progress.progress_vs_target(r.deliveries(), r.registry(), r.centres(), YEAR),
         "centres registry deliveries", _with(V3, UNIQ, f"v1 AS ({V1})", f"v2 AS ({V2})"),
         dbl=f"{TON5} {META3} avance_dap_ton_acum avance_urea_ton_acum avance_total_ton_acum avance_pct_dh_acum avance_pct_ton_acum",
         big="avance_dh avance_superficie meta_dh meta_superficie avance_dh_acum avance_superficie_acum")
register("v32_target_and_progress",
         lambda r: progress.target_and_progress(r.deliveries(), r.registry(), r.centres(), YEAR),
         "centres registry deliveries", _with("""
SELECT m.*, coalesce(t.avance_dh, 0) AS avance_dh, coalesce(t.avance_superficie, 0) AS avance_superficie,
  coalesce(t.avance_dap_ton, 0) AS avance_dap_ton, coalesce(t.avance_urea_ton, 0) AS avance_urea_ton,
  coalesce(t.avance_total_ton, 0) AS avance_total_ton
FROM v1 m LEFT JOIN (SELECT id_ceda_agricultura, estatus, sum(avance_dh) AS avance_dh,
  sum(avance_superficie) AS avance_superficie, sum(avance_dap_ton) AS avance_dap_ton, sum(avance_urea_ton) AS avance_urea_ton,
  sum(avance_total_ton) AS avance_total_ton FROM v2 GROUP BY ALL) t
ON t.id_ceda_agricultura = m.id_ceda_agricultura AND t.estatus = m.estatus""", UNIQ, f"v1 AS ({V1})", f"v2 AS ({V2})"),
         dbl=f"{TON5} {META3}", big="avance_dh avance_superficie meta_dh meta_superficie")

V4 = """
SELECT c.coordinacion_estatal AS unidad_operativa, c.estado, c.zona_operativa, c.nombre_cedas AS nombre_ceda, e.*
FROM (SELECT d.acuse_estatal, d.curp_renapo AS curp, p.primer_apellido, p.segundo_apellido, p.nombre, d.cdf_entrega AS id_ceda_agricultura,
    p.fecha_de_publicacion AS fecha_publicacion, d.fecha_entrega, p.estatus AS listado,
    CASE WHEN lower(coalesce(p.estatus, '')) LIKE '%nuevo ingreso%' THEN 'NUEVO_INGRESO' ELSE 'ACCESO_DIRECTO' END AS tipo_incorporacion,
    d.cultivo, d.superficie_apoyada AS hectareas, d.ton_dap_entregada AS dap_ton, d.ton_urea_entregada AS urea_ton,
    coalesce(d.ton_dap_entregada, 0) + coalesce(d.ton_urea_entregada, 0) AS total_ton,
    date_diff('day', p.fecha_de_publicacion, d.fecha_entrega) + 1 AS dias_transcurridos_entrega
  FROM deliveries d LEFT JOIN registry p USING (acuse_estatal)) e LEFT JOIN centres c USING (id_ceda_agricultura)"""
_LIST = ", ".join(
    f"count(*) FILTER (tipo_incorporacion = '{c}') AS {p}_apoyados, " + ", ".join(
        f"coalesce(sum(CASE WHEN tipo_incorporacion = '{c}' THEN {m} END), 0) AS {p}_{m}"
        for m in ("hectareas", "dap_ton", "urea_ton", "total_ton"))
    for p, c in (("ad", "ACCESO_DIRECTO"), ("ni", "NUEVO_INGRESO")))
V5 = f"""
SELECT unidad_operativa, estado, zona_operativa, id_ceda_agricultura, nombre_ceda, {_LIST},
  sum(CASE WHEN dias_transcurridos_entrega > 150 THEN 1 ELSE 0 END) AS mas_de_150_dias
FROM v4 GROUP BY unidad_operativa, estado, zona_operativa, id_ceda_agricultura, nombre_ceda"""
LIST_DBL = " ".join(f"{p}_{m}" for p in ("ad", "ni") for m in ("dap_ton", "urea_ton", "total_ton"))
LIST_BIG = "ad_apoyados ni_apoyados ad_hectareas ni_hectareas mas_de_150_dias"
_V6COLS = ", ".join(f"sum({c}) AS {c}" for c in (LIST_DBL + " " + LIST_BIG).split())
register("v4_delivery_list", lambda r: progress.delivery_list(r.deliveries(), r.registry(), r.centres()),
         "centres registry deliveries", V4, dbl="dap_ton urea_ton total_ton", big="dias_transcurridos_entrega")
register("v5_list_progress_by_centre",
         lambda r: progress.list_progress_by_centre(r.deliveries(), r.registry(), r.centres()),
         "centres registry deliveries", _with(V5, f"v4 AS ({V4})"), dbl=LIST_DBL, big=LIST_BIG)
register("v6_list_progress_by_state", lambda r: progress.list_progress_by_state(
    progress.list_progress_by_centre(r.deliveries(), r.registry(), r.centres())),
         "centres registry deliveries",
         _with(f"SELECT unidad_operativa, estado, {_V6COLS} FROM v5 GROUP BY ALL", f"v4 AS ({V4})", f"v5 AS ({V5})"),
         dbl=LIST_DBL, big=LIST_BIG)


def _by_receipt(r):
    """Registry and deliveries as stored by receipt."""
    return tuple(receipts.store_by_receipt(df, scratch_path(r.spark, name), 8) for name, df in (("entregas", r.deliveries()), ("padron", r.registry())))


register("j3_bucketed_delivery_list", lambda r: progress.delivery_list(*_by_receipt(r), r.centres()),
         "centres registry deliveries", V4, dbl="dap_ton urea_ton total_ton", big="dias_transcurridos_entrega")
register("j6_bucketed_unregistered", lambda r: progress.unregistered_deliveries(*_by_receipt(r)), "registry deliveries", """SELECT d.* FROM deliveries d
WHERE NOT EXISTS (SELECT 1 FROM registry p WHERE p.acuse_estatal = d.acuse_estatal)""", dbl="ton_dap_entregada ton_urea_entregada", big="superficie_apoyada")
register("v8_unregistered_deliveries",
         lambda r: progress.unregistered_deliveries(r.deliveries(), r.registry()),
         "registry deliveries", """SELECT d.* FROM deliveries d WHERE NOT EXISTS
  (SELECT 1 FROM registry k WHERE k.acuse_estatal = d.acuse_estatal)""",
         dbl="ton_dap_entregada ton_urea_entregada")

# ---- freight -------------------------------------------------------------------------------------

ENRICHED = """
SELECT f.*, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.nombre_cedas
FROM freight f LEFT JOIN centres rd ON rd.id_ceda_agricultura = f.id_ceda_agricultura"""
REQUEST = {"unidad_operativa": "ASIA", "abreviacion_producto": "DAP", "estatus": "", "fecha_salida_ini": "01/03/1997",
           "fecha_salida_fin": "2000-06-30", "fecha_entrega_ini": "1997-03-05", "fecha_entrega_fin": "no es fecha"}
SEARCH = """unidad_operativa = 'ASIA' AND abreviacion_producto = 'DAP' AND fecha_de_salida >= DATE '1997-03-01'
  AND fecha_de_salida <= DATE '2000-06-30' AND CAST(fecha_de_entrega AS DATE) >= DATE '1997-03-05'"""
FT = "toneladas_iniciales toneladas_en_el_destino"
register("v7_enriched_freight", lambda r: freight.enriched_freight(r.freight(), r.centres()),
         "centres freight", ENRICHED, dbl=FT)
register("v10_freight_query", lambda r: freight.freight_query_rows(
    freight.enriched_freight(r.freight(), r.centres()), REQUEST, ["folio_del_flete", "estado", "toneladas_iniciales", "falta"]),
         "centres freight", f"SELECT folio_del_flete, estado, toneladas_iniciales FROM ({ENRICHED}) e WHERE {SEARCH}",
         dbl="toneladas_iniciales")
SUMMARY = """
SELECT count(*) AS total, coalesce(sum(toneladas_iniciales), 0) AS sum_toneladas_iniciales,
  coalesce(sum(toneladas_en_el_destino), 0) AS sum_toneladas_en_el_destino,
  count(*) FILTER (abreviacion_producto = 'DAP') AS dap_count, count(*) FILTER (abreviacion_producto = 'URE') AS urea_count,
  coalesce(sum(CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_iniciales END), 0) AS dap_toneladas_iniciales,
  coalesce(sum(CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino END), 0) AS dap_toneladas_en_el_destino,
  coalesce(sum(CASE WHEN abreviacion_producto = 'URE' THEN toneladas_iniciales END), 0) AS urea_toneladas_iniciales,
  coalesce(sum(CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino END), 0) AS urea_toneladas_en_el_destino"""
SUMMARY_DBL = ("sum_toneladas_iniciales sum_toneladas_en_el_destino dap_toneladas_iniciales dap_toneladas_en_el_destino "
               "urea_toneladas_iniciales urea_toneladas_en_el_destino")
register("v10_freight_summary", lambda r: freight.freight_summary(
    freight.freight_query(freight.enriched_freight(r.freight(), r.centres()), REQUEST)),
         "centres freight", f"{SUMMARY} FROM ({ENRICHED}) e WHERE {SEARCH}", dbl=SUMMARY_DBL)
register("a4_freight_summary_all", lambda r: freight.freight_summary(r.freight()), "freight",
         f"{SUMMARY} FROM freight", dbl=SUMMARY_DBL)


def _psum(product: str, tons: str, cond: str = "TRUE", col: str = "abreviacion_producto") -> str:
    return f"coalesce(sum(CASE WHEN {col} = '{product}' AND {cond} THEN {tons} END), 0)"


GOT, MOVING = "lower(estatus) = 'entregado'", "lower(estatus) = 'autorizado'"
register("v12_freight_by_centre", lambda r: freight.freight_by_centre(r.freight()), "freight", f"""
SELECT id_ceda_agricultura, count(*) FILTER (abreviacion_producto = 'DAP' AND {GOT}) AS dap_recibido_fletes,
  count(*) FILTER (abreviacion_producto = 'URE' AND {GOT}) AS urea_recibido_fletes,
  count(*) FILTER (abreviacion_producto = 'DAP' AND {MOVING}) AS dap_transito_fletes,
  count(*) FILTER (abreviacion_producto = 'URE' AND {MOVING}) AS urea_transito_fletes,
  {_psum('DAP', 'toneladas_en_el_destino', GOT)} AS dap_fletes_ton, {_psum('URE', 'toneladas_en_el_destino', GOT)} AS urea_fletes_ton,
  {_psum('DAP', 'toneladas_iniciales', MOVING)} AS dap_transito_ton, {_psum('URE', 'toneladas_iniciales', MOVING)} AS urea_transito_ton,
  CAST(max(CASE WHEN {GOT} THEN fecha_de_entrega END) AS DATE) AS ultimo_flete_recibido,
  max(fecha_de_salida) AS ultimo_flete_enviado,
  CAST(min(CASE WHEN {GOT} THEN fecha_de_entrega END) AS DATE) AS primer_flete_recibido
FROM freight WHERE id_ceda_agricultura IS NOT NULL GROUP BY id_ceda_agricultura""",
         dbl="dap_fletes_ton urea_fletes_ton dap_transito_ton urea_transito_ton")
SENT = f"""{_psum('DAP', 'toneladas_iniciales')} AS dap_ton_enviadas, {_psum('URE', 'toneladas_iniciales')} AS urea_ton_enviadas,
  {_psum('DAP', 'toneladas_iniciales')} + {_psum('URE', 'toneladas_iniciales')} AS total_ton_enviadas"""
SENT_DBL = "dap_ton_enviadas urea_ton_enviadas total_ton_enviadas"
register("v18_shipments_by_day", lambda r: freight.shipments_by_day(r.freight()), "freight",
         f"SELECT fecha_de_salida AS fecha, {SENT} FROM freight WHERE fecha_de_salida IS NOT NULL GROUP BY 1", dbl=SENT_DBL)
register("v18_shipments_by_day_state", lambda r: freight.shipments_by_day_state(r.freight(), r.centres()),
         "centres freight", f"""SELECT fecha_de_salida AS fecha, estado, {SENT} FROM freight f JOIN centres rd
  ON rd.id_ceda_agricultura = f.id_ceda_agricultura WHERE fecha_de_salida IS NOT NULL GROUP BY 1, 2""", dbl=SENT_DBL)
register("v18_freight_by_delivery_day", lambda r: freight.freight_by_delivery_day(r.freight()), "freight", f"""
SELECT id_ceda_agricultura, fecha_de_entrega, {_psum('DAP', 'toneladas_en_el_destino')} AS dap,
  {_psum('URE', 'toneladas_en_el_destino')} AS ure,
  {_psum('DAP', 'toneladas_en_el_destino')} + {_psum('URE', 'toneladas_en_el_destino')} AS total_general
FROM freight WHERE {GOT} AND fecha_de_entrega IS NOT NULL GROUP BY 1, 2""", dbl="dap ure total_general")
DETAIL = f"""
SELECT folio_del_flete, f.id_ceda_agricultura, abreviacion_producto, toneladas_iniciales, fecha_de_salida,
  DATE '{TODAY}' - fecha_de_salida AS dias_en_transito, coalesce(DATE '{TODAY}' - fecha_de_salida >= 30, FALSE) AS demorado,
  rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.nombre_cedas
FROM freight f LEFT JOIN centres rd ON rd.id_ceda_agricultura = f.id_ceda_agricultura WHERE {MOVING}"""
TRANSIT = """count(*) FILTER (abreviacion_producto = 'DAP') AS fletes_transito_dap,
  count(*) FILTER (abreviacion_producto = 'URE') AS fletes_transito_urea,
  coalesce(sum(toneladas_iniciales) FILTER (abreviacion_producto = 'DAP'), 0) AS ton_transito_dap,
  coalesce(sum(toneladas_iniciales) FILTER (abreviacion_producto = 'URE'), 0) AS ton_transito_urea,
  max(dias_en_transito) AS max_dias_en_transito,
  count(*) FILTER (abreviacion_producto IN ('DAP', 'URE')) AS total_fletes_transito,
  coalesce(sum(toneladas_iniciales) FILTER (abreviacion_producto IN ('DAP', 'URE')), 0) AS total_ton_transito"""
TR_DBL, TR_BIG = "ton_transito_dap ton_transito_urea total_ton_transito", "max_dias_en_transito"
register("v22_transit_detail", lambda r: freight.transit_detail(r.freight(), r.centres(), TODAY), "centres freight",
         DETAIL, dbl="toneladas_iniciales", big="dias_en_transito")
register("v22_transit_by_centre", lambda r: freight.transit_by_centre(r.freight(), r.centres(), TODAY), "centres freight",
         f"""SELECT id_ceda_agricultura, unidad_operativa, estado, zona_operativa, nombre_cedas, {TRANSIT}
FROM ({DETAIL}) d GROUP BY ALL""", dbl=TR_DBL, big=TR_BIG)
register("v22_transit_by_state", lambda r: freight.transit_by_state(r.freight(), r.centres(), TODAY), "centres freight",
         f"SELECT unidad_operativa, estado, {TRANSIT} FROM ({DETAIL}) d GROUP BY ALL", dbl=TR_DBL, big=TR_BIG)
register("a12_transit_footer", lambda r: freight.transit_footer(
    freight.transit_by_state(r.freight(), r.centres(), TODAY)), "centres freight",
         f"SELECT {TRANSIT} FROM ({DETAIL}) d", dbl=TR_DBL, big=TR_BIG)
register("v23_freight_by_origin", lambda r: freight.freight_by_origin(r.freight(with_origin=True), r.centres()),
         "centres freight_origin", f"""
SELECT f.id_ceda_agricultura, estado_procedencia, count(*) FILTER (abreviacion_producto = 'DAP') AS fletes_dap,
  count(*) FILTER (abreviacion_producto = 'URE') AS fletes_urea, {_psum('DAP', 'toneladas_iniciales')} AS dap_ton,
  {_psum('URE', 'toneladas_iniciales')} AS urea_ton, sum(toneladas_iniciales) AS toneladas_iniciales,
  coalesce(sum(toneladas_en_el_destino), 0) AS toneladas_en_el_destino, rd.coordinacion_estatal AS unidad_operativa, rd.estado,
  rd.zona_operativa, rd.nombre_cedas
FROM freight_origin f LEFT JOIN centres rd ON rd.id_ceda_agricultura = f.id_ceda_agricultura
GROUP BY f.id_ceda_agricultura, estado_procedencia, rd.coordinacion_estatal, rd.estado, rd.zona_operativa, rd.nombre_cedas""",
         dbl=f"dap_ton urea_ton {FT}")
register("v24_atypical_tons", lambda r: freight.atypical_tons(r.freight()), "freight", """
SELECT folio_del_flete, id_ceda_agricultura, abreviacion_producto, toneladas_iniciales, toneladas_en_el_destino,
  toneladas_iniciales - toneladas_en_el_destino AS diferencia_ton FROM freight
WHERE toneladas_iniciales - toneladas_en_el_destino > 10 OR toneladas_iniciales - toneladas_en_el_destino < -1""",
         dbl=f"{FT} diferencia_ton")
register("v25_incoherent_dates", lambda r: freight.incoherent_dates(r.freight()), "freight", """
SELECT folio_del_flete, id_ceda_agricultura, estatus, fecha_de_salida, fecha_de_llegada, fecha_de_entrega FROM freight
WHERE fecha_de_salida > CAST(fecha_de_llegada AS DATE) OR fecha_de_salida > CAST(fecha_de_entrega AS DATE)""")

# ---- deliveries ----------------------------------------------------------------------------------

DSUM = """count(*) AS derechohabientes_apoyados, coalesce(sum(ton_dap_entregada), 0) AS dap_ton_entregada,
  coalesce(sum(ton_urea_entregada), 0) AS urea_ton_entregada,
  coalesce(sum(ton_dap_entregada), 0) + coalesce(sum(ton_urea_entregada), 0) AS total_ton_entregada"""
D_DBL = "dap_ton_entregada urea_ton_entregada total_ton_entregada"
register("v11_deliveries_by_centre", lambda r: dl.deliveries_by_centre(r.deliveries()), "deliveries", """
SELECT *, CASE WHEN no_de_dias_realizando_entregas > 0 THEN CAST((200 * total_derechohabientes + no_de_dias_realizando_entregas)
    // (2 * no_de_dias_realizando_entregas) AS DOUBLE) / 100 END AS derechohabientes_atendidos_por_dia,
  dap_ultima_entrega + urea_ultima_entrega AS total_ton_ultima_entrega
FROM (SELECT cdf_entrega AS id_ceda_agricultura, count(*) AS total_derechohabientes, sum(ton_dap_entregada) AS dap_entregado_ton,
  sum(ton_urea_entregada) AS urea_entregado_ton, sum(superficie_apoyada) AS superficie_apoyada,
  sum(dap_remanente * 0.025) AS dap_rem_entregado_ton, sum(urea_remanente * 0.025) AS urea_rem_entregado_ton,
  sum(dap_anio_actual * 0.025) AS dap_entregado_anio_actual_ton, sum(urea_anio_actual * 0.025) AS urea_entregado_anio_actual_ton,
  max(fecha_entrega) AS ultima_entrega_realizada, min(fecha_entrega) AS primer_entrega_realizada,
  count(DISTINCT fecha_entrega) AS no_de_dias_realizando_entregas,
  coalesce(sum(ton_dap_entregada) FILTER (fecha_entrega = m), 0) AS dap_ultima_entrega,
  coalesce(sum(ton_urea_entregada) FILTER (fecha_entrega = m), 0) AS urea_ultima_entrega
  FROM (SELECT *, max(fecha_entrega) OVER (PARTITION BY cdf_entrega) AS m FROM deliveries) x GROUP BY 1) y""",
         dbl="dap_entregado_ton urea_entregado_ton dap_rem_entregado_ton urea_rem_entregado_ton dap_entregado_anio_actual_ton "
             "urea_entregado_anio_actual_ton dap_ultima_entrega urea_ultima_entrega total_ton_ultima_entrega",
         big="superficie_apoyada")
register("v16_progress_by_state", lambda r: dl.progress_by_state(r.deliveries(), r.centres()), "centres deliveries",
         f"""SELECT estado, {DSUM}, sum(superficie_apoyada) AS superficie_beneficiada FROM deliveries d JOIN centres rd
  ON rd.id_ceda_agricultura = d.cdf_entrega GROUP BY estado""", dbl=D_DBL, big="superficie_beneficiada")
CAL = f"(SELECT CAST(f AS DATE) AS fecha FROM generate_series(DATE '{ALL_START}', DATE '{ALL_END}', INTERVAL 1 DAY) g(f))"
DAILY = f"""
SELECT c.fecha, count(acuse_estatal) AS derechohabientes_apoyados, coalesce(sum(ton_dap_entregada), 0) AS dap_ton_entregada,
  coalesce(sum(ton_urea_entregada), 0) AS urea_ton_entregada,
  coalesce(sum(ton_dap_entregada), 0) + coalesce(sum(ton_urea_entregada), 0) AS total_ton_entregada
FROM {CAL} c LEFT JOIN deliveries d ON d.fecha_entrega = c.fecha GROUP BY c.fecha"""
register("v17_deliveries_by_day", lambda r: dl.deliveries_by_day(r.deliveries(), ALL_START, ALL_END), "deliveries", DAILY, dbl=D_DBL)
register("v17_deliveries_by_day_state", lambda r: dl.deliveries_by_day_state(r.deliveries(), r.centres()),
         "centres deliveries", f"""SELECT fecha_entrega AS fecha, estado, {DSUM} FROM deliveries d JOIN centres rd
  ON rd.id_ceda_agricultura = d.cdf_entrega WHERE fecha_entrega IS NOT NULL GROUP BY 1, 2""", dbl=D_DBL)
register("v17_deliveries_by_week", lambda r: dl.deliveries_by_week(r.deliveries()), "deliveries", f"""
SELECT anio, semana, fecha_inicio_semana, fecha_inicio_semana + 6 AS fecha_fin_semana,
  ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']
  [month(fecha_inicio_semana)] AS nombre_mes, derechohabientes_apoyados, {D_DBL.replace(' ', ', ')}
FROM (SELECT isoyear(fecha_entrega) AS anio, week(fecha_entrega) AS semana,
  CAST(date_trunc('week', fecha_entrega) AS DATE) AS fecha_inicio_semana, {DSUM}
  FROM deliveries WHERE fecha_entrega IS NOT NULL GROUP BY 1, 2, 3) w""", dbl=D_DBL)
register("v17_deliveries_by_state_and_sex", lambda r: dl.deliveries_by_state_and_sex(r.deliveries(), r.centres()),
         "centres deliveries", """
SELECT estado, count(*) FILTER (upper(curp_renapo)[11] = 'H') AS hombres, count(*) FILTER (upper(curp_renapo)[11] = 'M') AS mujeres,
  count(*) AS avance_total, coalesce(sum(ton_dap_entregada), 0) AS toneladas_dap, coalesce(sum(ton_urea_entregada), 0) AS toneladas_urea,
  coalesce(sum(ton_dap_entregada), 0) + coalesce(sum(ton_urea_entregada), 0) AS toneladas_totales
FROM deliveries d JOIN centres rd ON rd.id_ceda_agricultura = d.cdf_entrega GROUP BY estado""",
         dbl="toneladas_dap toneladas_urea toneladas_totales")
register("v20_deliveries_with_centre", lambda r: dl.deliveries_with_centre(r.deliveries(), r.centres()),
         "centres deliveries", """SELECT d.*, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.id_ceda_agricultura
FROM deliveries d LEFT JOIN centres rd ON rd.id_ceda_agricultura = d.cdf_entrega""", dbl="ton_dap_entregada ton_urea_entregada")
register("v21_beneficiary_report", lambda r: dl.beneficiary_report(r.deliveries(), r.registry()), "registry deliveries", """
SELECT d.acuse_estatal, d.curp_renapo AS curp_productor, p.curp_renapo AS curp_historica,
  p.nombre || ' ' || p.primer_apellido || CASE WHEN trim(coalesce(p.segundo_apellido, '')) = '' THEN '' ELSE ' ' || p.segundo_apellido END
  AS nombre_completo, estado_predio_capturada AS estado, municipio_predio_capturada AS municipio,
  ton_dap_entregada AS toneladas_dap_entregadas, ton_urea_entregada AS toneladas_urea_entregadas,
  fecha_entrega AS fecha_de_entrega, nombre_ddr, cdf_entrega AS clave_ceda_entrega, 'ENTREGADO' AS situacion
FROM deliveries d JOIN registry p ON p.acuse_estatal = d.acuse_estatal""",
         dbl="toneladas_dap_entregadas toneladas_urea_entregadas")
register("v21_freight_report", lambda r: dl.freight_report(r.freight(), r.centres()), "centres freight", """
SELECT folio_del_flete, estatus, abreviacion_producto AS producto, toneladas_iniciales AS toneladas, bultos_iniciales,
  estado_procedencia, fecha_de_salida, bultos_en_destino, toneladas_en_el_destino, rd.estado AS estado_destino, fecha_de_llegada,
  f.id_ceda_agricultura AS clave_ceda_destino
FROM freight f LEFT JOIN centres rd ON rd.id_ceda_agricultura = f.id_ceda_agricultura""", dbl="toneladas toneladas_en_el_destino")
register("v21_beneficiaries_by_municipality", lambda r: dl.beneficiaries_by_municipality(r.deliveries(), r.centres()),
         "centres deliveries", """SELECT estado, municipio_predio_capturada AS municipio, count(*) AS derechohabientes_apoyados
FROM deliveries d JOIN centres rd ON rd.id_ceda_agricultura = d.cdf_entrega GROUP BY 1, 2""")
register("v31_deliveries_by_state_centre_day", lambda r: dl.deliveries_by_state_centre_day(r.deliveries(), r.centres()),
         "centres deliveries", f"""SELECT estado, rd.id_ceda_agricultura, nombre_cedas, fecha_entrega AS fecha, {DSUM}
FROM deliveries d JOIN centres rd ON rd.id_ceda_agricultura = d.cdf_entrega WHERE fecha_entrega IS NOT NULL GROUP BY 1, 2, 3, 4""",
         dbl=D_DBL)

# ---- stock ---------------------------------------------------------------------------------------

FLOW_ROLES = "centres freight transfers remnants incidents deliveries flows"


def _flows(r):
    return inventory.stock_flows(r.freight(), r.transfers(), r.remnants(), r.incidents(), r.deliveries())


STOCK = f"""
SELECT id_ceda_agricultura, unidad_operativa, estado, zona_operativa, nombre_cedas, fecha, dap_ton_total_entrada,
  urea_ton_total_entrada, dap_ton_total_salida, urea_ton_total_salida,
  sum(dap_ton_total_entrada - dap_ton_total_salida) OVER w AS dap_ton_inventario_acumulado,
  sum(urea_ton_total_entrada - urea_ton_total_salida) OVER w AS urea_ton_inventario_acumulado
FROM (SELECT rd.id_ceda_agricultura, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.nombre_cedas,
  c.fecha, coalesce(e.de, 0) AS dap_ton_total_entrada, coalesce(e.ue, 0) AS urea_ton_total_entrada,
  coalesce(e.ds, 0) AS dap_ton_total_salida, coalesce(e.us, 0) AS urea_ton_total_salida
  FROM centres rd CROSS JOIN (SELECT CAST(f AS DATE) AS fecha FROM generate_series(DATE '{ALL_START}', DATE '{ALL_END}', INTERVAL 1 DAY) g(f)) c
  LEFT JOIN (SELECT id_ceda_agricultura, fecha, sum(de) AS de, sum(ue) AS ue, sum(ds) AS ds, sum(us) AS us FROM flows GROUP BY 1, 2) e
  ON e.id_ceda_agricultura = rd.id_ceda_agricultura AND e.fecha = c.fecha) g
WINDOW w AS (PARTITION BY id_ceda_agricultura ORDER BY fecha ROWS UNBOUNDED PRECEDING)"""
FLOW_DBL = "dap_ton_total_entrada urea_ton_total_entrada dap_ton_total_salida urea_ton_total_salida"
INV = "dap_ton_inventario_acumulado urea_ton_inventario_acumulado"
NEG = "dap_ton_inventario_acumulado < 0 OR urea_ton_inventario_acumulado < 0"
CURRENT = """
SELECT rd.id_ceda_agricultura, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.nombre_cedas,
  coalesce(sum(de), 0) AS dap_ton_total_entrada, coalesce(sum(ue), 0) AS urea_ton_total_entrada,
  coalesce(sum(ds), 0) AS dap_ton_total_salida, coalesce(sum(us), 0) AS urea_ton_total_salida,
  coalesce(sum(de), 0) - coalesce(sum(ds), 0) AS dap_ton_inventario_acumulado,
  coalesce(sum(ue), 0) - coalesce(sum(us), 0) AS urea_ton_inventario_acumulado
FROM centres rd LEFT JOIN (SELECT * FROM flows WHERE fecha IS NOT NULL) e ON e.id_ceda_agricultura = rd.id_ceda_agricultura
GROUP BY ALL"""
register("v26_daily_stock", lambda r: inventory.daily_stock(_flows(r), r.centres(), ALL_START, ALL_END), FLOW_ROLES, STOCK,
         dbl=f"{FLOW_DBL} {INV}")
register("v26_daily_stock_of_one_year", lambda r: inventory.daily_stock(_flows(r), r.centres(), START, END), FLOW_ROLES,
         f"SELECT * FROM ({STOCK}) s WHERE fecha BETWEEN DATE '{START}' AND DATE '{END}'", dbl=f"{FLOW_DBL} {INV}")


def _table(r, df):
    """Rows as a table of their own: the change sets and the stock read them many times, and working them out is dear."""
    path = scratch_path(r.spark, "movimientos")
    df.write.parquet(path)
    return r.spark.read.parquet(path)


def _kept_up(r):
    """Stock as it stood some time ago (other freight, other centres, two months fewer), brought up to date by two change
    sets, the first of them sent twice."""
    path, now, h = scratch_path(r.spark, "existencias"), _table(r, r.freight().select(
        "folio_del_flete", "estatus", "id_ceda_agricultura", "abreviacion_producto", "toneladas_en_el_destino", "fecha_de_entrega")), F.pmod(F.xxhash64("folio_del_flete"), F.lit(10))
    tons, arrived = F.col("toneladas_en_el_destino"), F.col("fecha_de_entrega")
    then = now.filter(h != 0).withColumns({
        "toneladas_en_el_destino": F.when(h == 1, tons / 2).otherwise(tons).cast(now.schema["toneladas_en_el_destino"].dataType),
        "fecha_de_entrega": F.when(h == 2, arrived - F.expr("INTERVAL '400' DAY")).otherwise(arrived)}).unionByName(
        now.filter(h == 3).withColumn("folio_del_flete", F.concat(F.lit("D-"), "folio_del_flete")))
    halfway = now.filter(h != 4).unionByName(then.filter(h == 4))
    moves = ("id_ceda_agricultura", "cdf_origen", "estatus", "abreviacion_producto", "toneladas_iniciales", "toneladas_en_el_destino", "fecha_de_salida", "fecha_de_llegada")
    others = [_table(r, df.select(*columns)) for df, columns in (
        (r.transfers(), moves), (r.remnants(), moves), (r.incidents(), ("cdf_incidente", "fecha_incidente", "clave_producto", "ton_incidencia")),
        (r.deliveries(), ("cdf_entrega", "fecha_entrega", "ton_dap_entregada", "ton_urea_entregada")))]
    centres = r.centres()
    known = centres.filter("cast(id_ceda_agricultura AS int) % 7 <> 0").withColumn(
        "nombre_cedas", F.when(F.expr("cast(id_ceda_agricultura AS int) % 11 = 0"), F.lit("NOMBRE ANTERIOR")).otherwise(F.col("nombre_cedas")))
    known = known.unionByName(known.filter("id_ceda_agricultura = '1'").withColumn("id_ceda_agricultura", F.lit("CERRADA")))
    stock_upkeep.build_stock(inventory.stock_flows(then, *others), known, path, ALL_START, ALL_END - dt.timedelta(days=62), buckets=8)
    for i, (old, new, listed, end) in enumerate([(then, halfway, known, None), (then, halfway, known, None), (halfway, now, centres, ALL_END)]):
        changes = stock_upkeep.flow_changes(*stock_upkeep.changed_rows(inventory.freight_flows(old), inventory.freight_flows(new)))
        stock_upkeep.update_stock(r.spark, path, f"cambio-{max(i, 1)}", changes, listed, inventory.stock_flows(new, *others), end)
    return stock_upkeep.stored_stock(r.spark, path)


register("v26_incremental_stock", _kept_up, FLOW_ROLES, STOCK, dbl=f"{FLOW_DBL} {INV}")
register("v27_negative_stock_by_day", lambda r: inventory.negative_stock(
    inventory.daily_stock(_flows(r), r.centres(), ALL_START, ALL_END)), FLOW_ROLES,
         f"SELECT * FROM ({STOCK}) s WHERE {NEG}", dbl=f"{FLOW_DBL} {INV}")
register("v27_negative_stock_now", lambda r: inventory.negative_stock(inventory.current_stock(_flows(r), r.centres())),
         FLOW_ROLES, f"SELECT * FROM ({CURRENT}) s WHERE {NEG}", dbl=f"{FLOW_DBL} {INV}")
REM_ROLES = "centres remnants flows"
REM_FLOWS = """flows AS (
SELECT id_ceda_agricultura, fecha_de_llegada AS fecha, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino END AS de,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino END AS ue, NULL AS ds, NULL AS us FROM remnants
  WHERE lower(trim(estatus)) = 'entregada'
UNION ALL SELECT cdf_origen, fecha_de_salida, NULL, NULL, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_iniciales END,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_iniciales END FROM remnants)"""


def _carry(r):
    return inventory.carry_over_flows(r.remnants())


register("v28_carry_over_daily", lambda r: inventory.daily_stock(_carry(r), r.centres(), ALL_START, ALL_END),
         "centres remnants", _with(STOCK, REM_FLOWS), dbl=f"{FLOW_DBL} {INV}")
register("v28_carry_over_now", lambda r: inventory.current_stock(_carry(r), r.centres()),
         "centres remnants", _with(CURRENT, REM_FLOWS), dbl=f"{FLOW_DBL} {INV}")
register("v28_carry_over_by_state", lambda r: inventory.stock_by_state(inventory.current_stock(_carry(r), r.centres())),
         "centres remnants", _with(f"""
SELECT unidad_operativa, estado, sum(dap_ton_inventario_acumulado) AS dap_ton_inventario_acumulado,
  sum(urea_ton_inventario_acumulado) AS urea_ton_inventario_acumulado,
  sum(dap_ton_inventario_acumulado + urea_ton_inventario_acumulado) AS total_inventario,
  count(*) FILTER (dap_ton_inventario_acumulado > 0 OR urea_ton_inventario_acumulado > 0) AS cedas_positivas,
  count(*) FILTER ({NEG}) AS cedas_negativas FROM ({CURRENT}) c GROUP BY 1, 2""", REM_FLOWS), dbl=f"{INV} total_inventario")
register("v28_centres_positive", lambda r: inventory.centres_with_stock(inventory.current_stock(_carry(r), r.centres())),
         "centres remnants", _with(f"SELECT * FROM ({CURRENT}) c WHERE {NEG.replace('<', '>')}", REM_FLOWS), dbl=f"{FLOW_DBL} {INV}")
register("v28_centres_negative", lambda r: inventory.centres_with_stock(
    inventory.current_stock(_carry(r), r.centres()), negative=True),
         "centres remnants", _with(f"SELECT * FROM ({CURRENT}) c WHERE {NEG}", REM_FLOWS), dbl=f"{FLOW_DBL} {INV}")
register("a12_stock_footer", lambda r: inventory.stock_footer(inventory.current_stock(_carry(r), r.centres())),
         "centres remnants", _with(f"""SELECT count(*) AS total_cedas, coalesce(sum(dap_ton_inventario_acumulado), 0)
  AS dap_ton_inventario_acumulado, coalesce(sum(urea_ton_inventario_acumulado), 0) AS urea_ton_inventario_acumulado,
  coalesce(sum(dap_ton_inventario_acumulado + urea_ton_inventario_acumulado), 0) AS total_ton FROM ({CURRENT}) c""", REM_FLOWS),
         dbl=f"{INV} total_ton")
register("v13_incident_totals", lambda r: inventory.incident_totals(r.incidents()), "incidents", f"""
SELECT cdf_incidente AS id_ceda_agricultura, {_psum('DAP', 'ton_incidencia', col='clave_producto')} AS dap_incidencias_ton,
  {_psum('URE', 'ton_incidencia', col='clave_producto')} AS urea_incidencias_ton FROM incidents GROUP BY 1""",
         dbl="dap_incidencias_ton urea_incidencias_ton")
register("v13_remnant_totals", lambda r: inventory.remnant_totals(r.remnants()), "remnants", f"""
SELECT id_ceda_agricultura, {_psum('DAP', 'toneladas_en_el_destino')} AS dap_remanente_ton,
  {_psum('URE', 'toneladas_en_el_destino')} AS urea_remanente_ton FROM remnants WHERE lower(trim(estatus)) = 'entregada' GROUP BY 1""",
         dbl="dap_remanente_ton urea_remanente_ton")
TRANSFER_NAMES = "dap_transferencia_entrada urea_transferencia_entrada dap_transferencia_salida urea_transferencia_salida"
register("v13_transfer_totals", lambda r: inventory.transfer_totals(r.transfers()), "transfers", f"""
SELECT coalesce(i.c, o.c) AS id_ceda_agricultura, coalesce(i.d, 0) AS dap_transferencia_entrada,
  coalesce(i.u, 0) AS urea_transferencia_entrada, coalesce(o.d, 0) AS dap_transferencia_salida,
  coalesce(o.u, 0) AS urea_transferencia_salida
FROM (SELECT id_ceda_agricultura AS c, {_psum('DAP', 'toneladas_en_el_destino')} AS d, {_psum('URE', 'toneladas_en_el_destino')} AS u
  FROM transfers WHERE lower(trim(estatus)) = 'entregada' GROUP BY 1) i
FULL JOIN (SELECT cdf_origen AS c, {_psum('DAP', 'toneladas_iniciales')} AS d, {_psum('URE', 'toneladas_iniciales')} AS u
  FROM transfers GROUP BY 1) o ON i.c = o.c""", dbl=TRANSFER_NAMES)

# ---- field reports -------------------------------------------------------------------------------

LAST = """
SELECT id_ceda_agricultura, fecha, CAST(bultos_dap * 0.025 AS DECIMAL(18,3)) AS dap_campo,
  CAST(bultos_urea * 0.025 AS DECIMAL(18,3)) AS urea_campo, quien_reporta
FROM (SELECT *, CAST(fecha_y_hora AS DATE) AS fecha, row_number() OVER (PARTITION BY id_ceda_agricultura, CAST(fecha_y_hora AS DATE)
  ORDER BY fecha_y_hora DESC, id_reporte DESC) AS rn FROM field_reports WHERE fecha_y_hora IS NOT NULL) x WHERE rn = 1"""
# stock as of a day, straight from its definition: all movements up to that day
FVS = f"""
SELECT rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, l.id_ceda_agricultura, rd.nombre_cedas, l.fecha,
  l.quien_reporta, l.dap_campo, l.urea_campo, coalesce(sum(d), 0) AS dap_sigap, coalesce(sum(u), 0) AS urea_sigap,
  coalesce(l.dap_campo, 0) - coalesce(sum(d), 0) AS dap_campo_vs_sigap, coalesce(l.urea_campo, 0) - coalesce(sum(u), 0) AS urea_campo_vs_sigap
FROM ({LAST}) l JOIN centres rd ON rd.id_ceda_agricultura = l.id_ceda_agricultura
LEFT JOIN (SELECT id_ceda_agricultura, fecha, coalesce(sum(de), 0) - coalesce(sum(ds), 0) AS d,
  coalesce(sum(ue), 0) - coalesce(sum(us), 0) AS u FROM flows WHERE fecha IS NOT NULL GROUP BY 1, 2) f
  ON f.id_ceda_agricultura = l.id_ceda_agricultura AND f.fecha <= l.fecha
GROUP BY rd.coordinacion_estatal, rd.estado, rd.zona_operativa, l.id_ceda_agricultura, rd.nombre_cedas, l.fecha, l.quien_reporta,
  l.dap_campo, l.urea_campo"""
FIELD_ROLES = "centres freight transfers remnants incidents deliveries flows field_reports"
FVS_DBL = "dap_campo urea_campo dap_sigap urea_sigap dap_campo_vs_sigap urea_campo_vs_sigap"
register("v29_field_vs_system", lambda r: inventory.field_vs_system(_flows(r), r.field_reports(), r.centres()), FIELD_ROLES, FVS,
         dbl=FVS_DBL)


def _gap_class(c: str) -> str:
    return (f"CASE WHEN coalesce({c}, 0) < -1 THEN 'faltante_grave' WHEN coalesce({c}, 0) < -0.01 THEN 'faltante_menor' "
            f"WHEN coalesce({c}, 0) > 1 THEN 'excedente_grave' WHEN coalesce({c}, 0) > 0.01 THEN 'excedente_menor' "
            "ELSE 'sin_diferencia' END")


_ATRASO = f"coalesce(DATE '{REPORT_DAY}' - fecha_ultimo_reporte, 999)"
STATS = f"""
SELECT s.*, {_gap_class('dap_campo_vs_sigap')} AS clase_dap, {_gap_class('urea_campo_vs_sigap')} AS clase_urea,
  {_ATRASO} <= 1 OR (abs(coalesce(dap_sigap, 0)) < 0.01 AND abs(coalesce(urea_sigap, 0)) < 0.01 AND abs(coalesce(inventario_dap_ultimo, 0)) < 0.01
  AND abs(coalesce(inventario_urea_ultimo, 0)) < 0.01) AS cumplimiento_status,
  CASE WHEN {_ATRASO} <= 1 THEN 0 ELSE {_ATRASO} END AS dias_atraso
FROM (SELECT unidad_operativa, estado, zona_operativa, c.id_ceda_agricultura, nombre_cedas, dap_ton_inventario_acumulado AS dap_sigap,
  urea_ton_inventario_acumulado AS urea_sigap, l.fecha AS fecha_ultimo_reporte, coalesce(l.dias, 0) AS dias_reportados,
  l.dap_campo AS inventario_dap_ultimo, l.urea_campo AS inventario_urea_ultimo,
  l.dap_campo - dap_ton_inventario_acumulado AS dap_campo_vs_sigap, l.urea_campo - urea_ton_inventario_acumulado AS urea_campo_vs_sigap
  FROM ({CURRENT.replace("WHERE fecha IS NOT NULL", f"WHERE fecha <= DATE '{REPORT_DAY}'")}) c LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY id_ceda_agricultura) AS dias,
    row_number() OVER (PARTITION BY id_ceda_agricultura ORDER BY fecha DESC) AS ultima FROM ({LAST}) y) l
  ON l.id_ceda_agricultura = c.id_ceda_agricultura AND l.ultima = 1) s"""
register("v29_field_statistics", lambda r: inventory.field_statistics(_flows(r), r.field_reports(), r.centres(), REPORT_DAY),
         FIELD_ROLES, STATS, dbl="dap_sigap urea_sigap inventario_dap_ultimo inventario_urea_ultimo dap_campo_vs_sigap urea_campo_vs_sigap",
         big="dias_reportados dias_atraso")
register("a13_gap_tallies", lambda r: inventory.gap_tallies(
    inventory.field_statistics(_flows(r), r.field_reports(), r.centres(), REPORT_DAY)), FIELD_ROLES,
         "SELECT " + ", ".join(f"count(*) FILTER (clase_dap = '{k}') + count(*) FILTER (clase_urea = '{k}') AS {n}" for k, n in (
             ("faltante_grave", "faltantes_graves"), ("faltante_menor", "faltantes_menores"),
             ("excedente_grave", "excedentes_graves"), ("excedente_menor", "excedentes_menores")))
         + f", count(*) FILTER (NOT cumplimiento_status) AS sin_reporte FROM ({STATS}) t")
register("v29_who_reports", lambda r: inventory.who_reports(r.field_reports(), r.centres()), "centres field_reports", """
SELECT f.id_ceda_agricultura, trim(quien_reporta) AS quien_reporta, count(*) AS reportes, count(DISTINCT CAST(fecha_y_hora AS DATE)) AS dias,
  max(fecha_y_hora) AS ultimo_reporte, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa
FROM field_reports f JOIN centres rd ON rd.id_ceda_agricultura = f.id_ceda_agricultura WHERE fecha_y_hora IS NOT NULL
GROUP BY f.id_ceda_agricultura, trim(quien_reporta), rd.coordinacion_estatal, rd.estado, rd.zona_operativa""")

# ---- orders and supply ---------------------------------------------------------------------------

register("v14_orders_by_centre", lambda r: orders.orders_by_centre(r.order_lines()), "order_lines", """
SELECT folio_cdf AS id_ceda_agricultura, coalesce(sum(dap), 0) AS dap_pedido_acumulado, coalesce(sum(urea), 0) AS urea_pedido_acumulado,
  max(fecha) AS ultimo_pedido_solicitado FROM order_lines WHERE estatus_pedido_detalle = 'Autorizado' GROUP BY 1""",
         dbl="dap_pedido_acumulado urea_pedido_acumulado")
O_DBL = "pedido_dap_ton pedido_urea_ton pedido_total_ton"
register("v14_orders_by_day", lambda r: orders.orders_by_day(r.order_lines(), ALL_START, ALL_END), "order_lines", f"""
SELECT c.fecha, coalesce(sum(dap), 0) AS pedido_dap_ton, coalesce(sum(urea), 0) AS pedido_urea_ton,
  coalesce(sum(dap), 0) + coalesce(sum(urea), 0) AS pedido_total_ton
FROM {CAL} c LEFT JOIN order_lines o ON o.fecha = c.fecha AND estatus_pedido_detalle = 'Autorizado' GROUP BY 1""", dbl=O_DBL)
REM_DAY = f"""SELECT fecha_de_llegada AS fecha, {_psum('DAP', 'toneladas_en_el_destino')} AS d,
  {_psum('URE', 'toneladas_en_el_destino')} AS u FROM remnants WHERE lower(trim(estatus)) = 'entregada' GROUP BY 1"""
ORD_REM = f"""
SELECT coalesce(o.fecha, m.fecha) AS fecha, coalesce(pd, 0) AS pedido_dap_ton, coalesce(pu, 0) AS pedido_urea_ton,
  coalesce(d, 0) AS remanente_dap_ton, coalesce(u, 0) AS remanente_urea_ton,
  coalesce(pd, 0) + coalesce(pu, 0) + coalesce(d, 0) + coalesce(u, 0) AS pedido_total_ton
FROM (SELECT fecha, sum(dap) AS pd, sum(urea) AS pu FROM order_lines WHERE estatus_pedido_detalle = 'Autorizado'
  AND fecha BETWEEN DATE '{ALL_START}' AND DATE '{ALL_END}' GROUP BY 1) o
FULL JOIN (SELECT * FROM ({REM_DAY}) z WHERE fecha BETWEEN DATE '{ALL_START}' AND DATE '{ALL_END}') m ON m.fecha = o.fecha"""
register("v14_orders_and_remnants_by_day", lambda r: orders.orders_and_remnants_by_day(r.order_lines(), r.remnants(), ALL_START, ALL_END),
         "order_lines remnants", ORD_REM, dbl=f"{O_DBL} remanente_dap_ton remanente_urea_ton")
register("v15_network_summary", lambda r: orders.network_summary(r.centres()), "centres", """
SELECT id_ceda_agricultura, estado, zona_operativa, nombre_cedas, bodega_concentradora, sum(meta_derechohabientes) AS suma_productores,
  sum(meta_superficie_ha) AS suma_ha, sum(meta_dap_ton) AS suma_dap_ton, sum(meta_urea_ton) AS suma_urea_ton,
  sum(tonelaje_alm_total) AS suma_tonelaje_almacenamiento, sum(altura_estiba_m) AS suma_altura_estiba_m,
  sum(capacidad_descarga) AS suma_capacidad_descarga FROM centres GROUP BY 1, 2, 3, 4, 5""",
         dbl="suma_dap_ton suma_urea_ton suma_tonelaje_almacenamiento suma_altura_estiba_m",
         big="suma_productores suma_ha suma_capacidad_descarga")
FR_DAY = f"""SELECT CAST(fecha_de_entrega AS DATE) AS fecha, {_psum('DAP', 'toneladas_en_el_destino')} AS d,
  {_psum('URE', 'toneladas_en_el_destino')} AS u FROM freight WHERE {GOT} AND fecha_de_entrega IS NOT NULL GROUP BY 1"""
TR_DAY = f"""SELECT fecha_de_salida AS fecha, {_psum('DAP', 'toneladas_iniciales')} AS d, {_psum('URE', 'toneladas_iniciales')} AS u
  FROM freight WHERE {MOVING} AND fecha_de_salida IS NOT NULL GROUP BY 1"""
S4 = "dap_fletes_ton urea_fletes_ton dap_remanentes_ton urea_remanentes_ton"


def _supply(transit: bool) -> str:
    cols = [("f.d", "dap_fletes_ton"), ("f.u", "urea_fletes_ton"), ("m.d", "dap_remanentes_ton"), ("m.u", "urea_remanentes_ton")]
    cols += [("t.d", "dap_transito_ton"), ("t.u", "urea_transito_ton")] if transit else []
    return (f"SELECT c.fecha, {', '.join(f'coalesce({a}, 0) AS {b}' for a, b in cols)}, "
            f"{' + '.join(f'coalesce({a}, 0)' for a, _ in cols)} AS total_recibido_ton FROM {CAL} c "
            f"LEFT JOIN ({FR_DAY}) f ON f.fecha = c.fecha LEFT JOIN ({REM_DAY}) m ON m.fecha = c.fecha"
            + (f" LEFT JOIN ({TR_DAY}) t ON t.fecha = c.fecha" if transit else ""))


register("v19_supply_by_day_with_transit", lambda r: orders.supply_by_day(r.freight(), r.remnants(), ALL_START, ALL_END), "freight remnants",
         _supply(True), dbl=f"{S4} dap_transito_ton urea_transito_ton total_recibido_ton")
register("v19_supply_by_day", lambda r: orders.supply_by_day(r.freight(), r.remnants(), ALL_START, ALL_END, with_transit=False),
         "freight remnants", _supply(False), dbl=f"{S4} total_recibido_ton")
BY_STATE = f"""
SELECT fecha, estado, sum(df) AS dap_fletes_ton, sum(uf) AS urea_fletes_ton, sum(dr) AS dap_remanentes_ton, sum(ur) AS urea_remanentes_ton,
  sum(df + uf + dr + ur) AS total_recibido_ton
FROM (SELECT CAST(fecha_de_entrega AS DATE) AS fecha, id_ceda_agricultura, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino ELSE 0 END AS df,
    CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino ELSE 0 END AS uf, 0 AS dr, 0 AS ur
    FROM freight WHERE {GOT} AND fecha_de_entrega IS NOT NULL
  UNION ALL SELECT fecha_de_llegada, id_ceda_agricultura, 0, 0, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino ELSE 0 END,
    CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino ELSE 0 END FROM remnants WHERE lower(trim(estatus)) = 'entregada') x
JOIN centres rd ON rd.id_ceda_agricultura = x.id_ceda_agricultura GROUP BY 1, 2"""
register("v19_supply_by_day_and_state", lambda r: orders.supply_by_day_and_state(r.freight(), r.remnants(), r.centres()),
         "centres freight remnants", BY_STATE, dbl=f"{S4} total_recibido_ton")
register("v16_supply_by_state", lambda r: orders.supply_by_state(r.freight(), r.remnants(), r.centres()), "centres freight remnants", f"""
SELECT estado, sum(dap_fletes_ton) AS dap_fletes_ton, sum(urea_fletes_ton) AS urea_fletes_ton, sum(dap_remanentes_ton) AS dap_remanentes_ton,
  sum(urea_remanentes_ton) AS urea_remanentes_ton, sum(dap_fletes_ton + urea_fletes_ton) AS total_fletes_ton,
  sum(dap_remanentes_ton + urea_remanentes_ton) AS total_remanente_ton, sum(total_recibido_ton) AS total_abasto_ton
FROM ({BY_STATE}) s GROUP BY 1""", dbl=f"{S4} total_fletes_ton total_remanente_ton total_abasto_ton")
register("v19_projection_by_day", lambda r: orders.projection_by_day(r.projection(), ALL_START, ALL_END), "projection", f"""
SELECT c.fecha, coalesce(sum(toneladas_programadas), 0) AS abasto_proy_ton FROM {CAL} c LEFT JOIN projection p ON p.fecha = c.fecha GROUP BY 1""",
         dbl="abasto_proy_ton")
ORD_DETAIL = """
SELECT id_pedido, fecha, dap, urea, estatus_suministro, estatus_pedido_detalle, rd.id_ceda_agricultura,
  rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.nombre_cedas
FROM order_lines o LEFT JOIN centres rd ON rd.id_ceda_agricultura = o.folio_cdf"""
register("v33_order_detail", lambda r: orders.order_detail(r.order_lines(), r.centres()), "centres order_lines", ORD_DETAIL, dbl="dap urea")
register("a12_order_footer", lambda r: orders.order_detail_footer(orders.order_detail(r.order_lines(), r.centres())),
         "centres order_lines", f"SELECT count(*) AS total, coalesce(sum(dap), 0) AS dap, coalesce(sum(urea), 0) AS urea FROM ({ORD_DETAIL}) d",
         dbl="dap urea")
register("v34_comments_by_centre", lambda r: orders.comments_by_centre(r.centres(), r.comments()), "centres comments", """
SELECT rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.id_ceda_agricultura, rd.nombre_cedas, c.fecha, c.id,
  c.comentario FROM centres rd LEFT JOIN comments c ON c.id_ceda_agricultura = rd.id_ceda_agricultura""")
register("orders_query", lambda r: orders.orders_query(orders.order_detail(r.order_lines(), r.centres()), {
    "unidad_operativa": "ASIA", "estado": "", "fecha_inicio": "1996-02-01", "fecha_fin": "15/09/1998"}), "centres order_lines",
         f"SELECT * FROM ({ORD_DETAIL}) o WHERE unidad_operativa = 'ASIA' AND fecha BETWEEN DATE '1996-02-01' AND DATE '1998-09-15'", dbl="dap urea")
register("comments_query", lambda r: orders.comments_query(orders.comments_by_centre(r.centres(), r.comments()), {
    "unidad_operativa": "EUROPE", "zona_operativa": "ZONA 1"}), "centres comments", """
SELECT rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa, rd.id_ceda_agricultura, rd.nombre_cedas, c.fecha, c.id,
  c.comentario FROM centres rd LEFT JOIN comments c ON c.id_ceda_agricultura = rd.id_ceda_agricultura
WHERE rd.coordinacion_estatal = 'EUROPE' AND rd.zona_operativa = 'ZONA 1'""")
register("j15_order_summary_by_centre", lambda r: orders.order_summary_by_centre(r.centres(), r.order_summary()), "centres order_summary", """
SELECT rd.id_ceda_agricultura, rd.estado, coalesce(dap_solicitado, 3) AS dap_solicitado, coalesce(urea_solicitada, 3) AS urea_solicitada,
  coalesce(dap_por_suministrar, 3) AS dap_por_suministrar
FROM centres rd LEFT JOIN order_summary s ON s.folio_cdf = rd.id_ceda_agricultura""",
         dbl="dap_solicitado urea_solicitada dap_por_suministrar")

# ---- KPIs ----------------------------------------------------------------------------------------

V30 = f"""
SELECT rd.id_ceda_agricultura, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.meta_derechohabientes, rd.meta_superficie_ha,
  rd.meta_total_ton, coalesce(f.d, 0) AS dap_flete, coalesce(f.u, 0) AS urea_flete, coalesce(ti.d, 0) AS dap_transfer,
  coalesce(ti.u, 0) AS urea_transfer, coalesce(tu.d, 0) AS dap_transf_out, coalesce(tu.u, 0) AS urea_transf_out,
  coalesce(ri.d, 0) AS dap_remanente, coalesce(ri.u, 0) AS urea_remanente, coalesce(ro.d, 0) AS dap_rem_out, coalesce(ro.u, 0) AS urea_rem_out,
  coalesce(i.d, 0) AS dap_incidente, coalesce(i.u, 0) AS urea_incidente, coalesce(h.d, 0) AS dap_dh, coalesce(h.u, 0) AS urea_dh,
  coalesce(h.n, 0) AS dh_apoyados, coalesce(h.s, 0) AS ha_apoyadas
FROM centres rd
LEFT JOIN (SELECT id_ceda_agricultura AS c, {_psum('DAP', 'toneladas_en_el_destino')} AS d, {_psum('URE', 'toneladas_en_el_destino')} AS u FROM freight WHERE {GOT} GROUP BY 1) f ON f.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT id_ceda_agricultura AS c, {_psum('DAP', 'toneladas_en_el_destino')} AS d, {_psum('URE', 'toneladas_en_el_destino')} AS u FROM transfers WHERE lower(trim(estatus)) = 'entregada' GROUP BY 1) ti ON ti.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT cdf_origen AS c, {_psum('DAP', 'toneladas_iniciales')} AS d, {_psum('URE', 'toneladas_iniciales')} AS u FROM transfers GROUP BY 1) tu ON tu.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT id_ceda_agricultura AS c, {_psum('DAP', 'toneladas_en_el_destino')} AS d, {_psum('URE', 'toneladas_en_el_destino')} AS u FROM remnants WHERE lower(trim(estatus)) = 'entregada' GROUP BY 1) ri ON ri.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT cdf_origen AS c, {_psum('DAP', 'toneladas_iniciales')} AS d, {_psum('URE', 'toneladas_iniciales')} AS u FROM remnants GROUP BY 1) ro ON ro.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT cdf_incidente AS c, {_psum('DAP', 'ton_incidencia', col='clave_producto')} AS d, {_psum('URE', 'ton_incidencia', col='clave_producto')} AS u FROM incidents GROUP BY 1) i ON i.c = rd.id_ceda_agricultura
LEFT JOIN (SELECT cdf_entrega AS c, sum(ton_dap_entregada) AS d, sum(ton_urea_entregada) AS u, count(*) AS n, sum(superficie_apoyada) AS s FROM deliveries GROUP BY 1) h ON h.c = rd.id_ceda_agricultura"""
KPI_ROLES = "centres freight transfers remnants incidents deliveries targets"
V30_DBL = ("meta_total_ton dap_flete urea_flete dap_transfer urea_transfer dap_transf_out urea_transf_out dap_remanente urea_remanente "
           "dap_rem_out urea_rem_out dap_incidente urea_incidente dap_dh urea_dh")


def _progress(r):
    return kpi.operating_progress(r.freight(), r.transfers(), r.remnants(), r.incidents(), r.deliveries(), r.centres())


SUPPLY_EXPR = ("dap_flete + urea_flete + dap_transfer + urea_transfer + dap_remanente + urea_remanente - dap_transf_out - urea_transf_out "
               "- dap_rem_out - urea_rem_out")
ACHIEVED = f"""sum({SUPPLY_EXPR}) AS abasto, sum(dap_dh + urea_dh) AS entregado, sum(dh_apoyados) AS dh_apoyados, sum(ha_apoyadas) AS ha_apoyadas"""
A6 = f"""
SELECT sum(t.total_ton) AS meta_total_ton, sum(a.abasto) AS abasto, sum(a.entregado) AS entregado, sum(a.dh_apoyados) AS dh_apoyados,
  sum(a.ha_apoyadas) AS ha_apoyadas, sum(t.derechohabientes) AS meta_dh, sum(t.superficie_ha) AS meta_ha
FROM (SELECT estado, {ACHIEVED} FROM (%s) v GROUP BY estado) a JOIN targets t ON t.estado = a.estado"""
A15 = f"""SELECT sum(meta_total_ton) AS meta_total_ton, {ACHIEVED}, sum(meta_derechohabientes) AS meta_dh, sum(meta_superficie_ha) AS meta_ha
FROM (%s) v"""
TOTALS = "meta_total_ton abasto entregado"
TOTALS_BIG = "dh_apoyados ha_apoyadas meta_dh meta_ha"


def _pct(v: str, m: str) -> str:
    return (f"CASE WHEN {m} IS NULL OR {m} = 0 THEN 0 ELSE least(CAST(floor(CAST(coalesce({v}, 0) * 100 AS DOUBLE) / CAST({m} AS DOUBLE)) AS BIGINT), 100) END")


def _cards(totals: str) -> str:
    pairs = (("abasto", "meta_total_ton", "abasto"), ("entregado", "meta_total_ton", "entregado"), ("dh_apoyados", "meta_dh", "dh"),
             ("ha_apoyadas", "meta_ha", "ha"))
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in f"{TOTALS} {TOTALS_BIG}".split())
    return (f"SELECT {zero}, " + ", ".join(f"{_pct(v, m)} AS porc_{n}" for v, m, n in pairs) + ", " + ", ".join(
        f"greatest(coalesce({m}, 0) - coalesce({v}, 0), 0) AS pendiente_{n}" for v, m, n in pairs) + f" FROM ({totals}) t")


CARD_DBL, CARD_BIG = f"{TOTALS} pendiente_abasto pendiente_entregado", f"{TOTALS_BIG} pendiente_dh pendiente_ha"
register("v30_operating_progress", _progress, KPI_ROLES, V30, dbl=V30_DBL, big="dh_apoyados ha_apoyadas")
register("a5_supply_by_state", lambda r: kpi.progress_by_state(_progress(r)), KPI_ROLES,
         f"SELECT estado, {ACHIEVED} FROM ({V30}) v GROUP BY estado", dbl="abasto entregado", big="dh_apoyados ha_apoyadas")
register("a6_national_totals_official", lambda r: kpi.national_totals(_progress(r), r.targets()), KPI_ROLES, A6 % V30, dbl=TOTALS,
         big=TOTALS_BIG)
register("a15_national_totals_operating", lambda r: kpi.national_totals(_progress(r)), KPI_ROLES, A15 % V30, dbl=TOTALS, big=TOTALS_BIG)
register("v9_kpi_official", lambda r: kpi.national_kpi(_progress(r), r.targets()), KPI_ROLES, _cards(A6 % V30), dbl=CARD_DBL, big=CARD_BIG)
register("v9_kpi_operating_unit", lambda r: kpi.national_kpi(_progress(r), None, unidad_operativa="EUROPE"), KPI_ROLES,
         _cards(A15 % f"SELECT * FROM ({V30}) e WHERE unidad_operativa = 'EUROPE'"), dbl=CARD_DBL, big=CARD_BIG)
register("a14_state_progress_table", lambda r: kpi.state_progress_table(_progress(r), r.targets()), KPI_ROLES, f"""
SELECT *, {_pct('abasto', 'total_ton')} AS porc_abasto, {_pct('entregado', 'total_ton')} AS porc_entregado,
  {_pct('dh_apoyados', 'derechohabientes')} AS porc_dh, greatest(total_ton - entregado, 0) AS pendiente_entregado
FROM (SELECT estado, nivel, sum(abasto) AS abasto, sum(entregado) AS entregado, sum(dh_apoyados) AS dh_apoyados, sum(ha_apoyadas) AS ha_apoyadas,
  sum(total_ton) AS total_ton, sum(derechohabientes) AS derechohabientes, sum(superficie_ha) AS superficie_ha
  FROM (SELECT a.estado, 0 AS nivel, a.* EXCLUDE (estado), t.* EXCLUDE (estado) FROM (SELECT estado, {ACHIEVED} FROM ({V30}) v GROUP BY estado) a
        JOIN targets t ON t.estado = a.estado
        UNION ALL SELECT NULL, 1, a.* EXCLUDE (estado), t.* EXCLUDE (estado) FROM (SELECT estado, {ACHIEVED} FROM ({V30}) v GROUP BY estado) a
        JOIN targets t ON t.estado = a.estado) u GROUP BY estado, nivel) s""",
         dbl="abasto entregado total_ton pendiente_entregado",
         big="dh_apoyados ha_apoyadas derechohabientes superficie_ha")

# ---- directory -----------------------------------------------------------------------------------

DIRECTORY = f"""
SELECT estado, coordinacion_estatal AS unidad_operativa, zona_operativa, id_ceda_agricultura, 'RESPONSABLE DE CEDA' AS cargo,
  CAST(NULL AS VARCHAR) AS curp, coalesce(responsable_cedas, '') AS nombre_completo, coalesce(rc_correo, '') AS correo_electronico,
  coalesce(rc_telefono, '') AS telefono, CAST(NULL AS VARCHAR) AS comentarios, TIMESTAMP '{NOW}' AS fecha_actualizacion FROM centres
UNION ALL SELECT estado, coordinacion_estatal, zona_operativa, 'N/A', 'COORDINADOR OPERATIVO DE ZONA', NULL, coordinador_operativo, coz_correo,
  coz_telefono, NULL, TIMESTAMP '{NOW}'
FROM (SELECT DISTINCT ON (estado, zona_operativa) * FROM centres WHERE coordinador_operativo IS NOT NULL
  ORDER BY estado, zona_operativa, id_ceda_agricultura) z"""
register("b2_directory", lambda r: directory.build_directory(r.centres(), NOW), "centres", DIRECTORY)
