"""Filters, joins and corrections, aggregates, series, paging and options."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import register
from catalog.derived import (ALL_END, ALL_START, CAL, DAILY, ENRICHED, FLOW_DBL, FLOW_ROLES, FT, INV, ORD_REM, STOCK,
                             _flows, _supply)
from granero.operators import daily, dedupe, filters, positions, series, sorted_layout, summaries
from granero.plans import deliveries as dl
from granero.plans import batch, freight, inventory, orders, reports
from granero.session import scratch_path
from granero.sources import sinks

TODAY = dt.date(1998, 10, 1)

# ---- filters -------------------------------------------------------------------------------------

register("q1_filter_eq", lambda r: filters.filter_eq(r.freight(), {"estatus": "Entregado", "abreviacion_producto": "URE", "cdf_destino_final": ""}),
         "freight", "SELECT * FROM freight WHERE estatus = 'Entregado' AND abreviacion_producto = 'URE'", dbl=FT)
register("q2_filter_date_range", lambda r: filters.filter_date_range(r.freight(), "fecha_de_llegada", "15/01/1998", "1998-12-31")
         .select("folio_del_flete", "fecha_de_llegada"), "freight",
         """SELECT folio_del_flete, fecha_de_llegada FROM freight WHERE CAST(fecha_de_llegada AS DATE) BETWEEN DATE '1998-01-15' AND DATE '1998-12-31'""")
register("q3_filter_iexact", lambda r: filters.filter_iexact(r.deliveries(), "curp_renapo", "xxxxxxx100hdf").select("acuse_estatal", "curp_renapo"),
         "deliveries", "SELECT acuse_estatal, curp_renapo FROM deliveries WHERE upper(curp_renapo) = 'XXXXXXX100HDF'")
register("q4_filter_in_list", lambda r: filters.filter_in_list(r.deliveries(), "cdf_entrega", " 1, 2\n\n 3 ,5\n", commas=True).select(
    "acuse_estatal", "cdf_entrega"), "deliveries", "SELECT acuse_estatal, cdf_entrega FROM deliveries WHERE cdf_entrega IN ('1', '2', '3', '5')")
register("q4_long_list", lambda r: filters.filter_in_list(r.deliveries(), "acuse_estatal", "\n".join(str(3 * i) for i in range(5000))).select(
    "acuse_estatal", "cdf_entrega"), "deliveries", """SELECT acuse_estatal, cdf_entrega FROM deliveries
WHERE acuse_estatal IN (SELECT CAST(3 * i AS VARCHAR) FROM range(5000) t(i))""")
register("q5_select_valid_columns", lambda r: filters.select_valid_columns(r.centres(), ["nada", "estado", "id_ceda_agricultura"]), "centres",
         "SELECT estado, id_ceda_agricultura FROM centres")
register("q6_default_to_yesterday", lambda r: filters.default_to_yesterday(r.order_lines(), "fecha", None, TODAY).select("id_pedido", "fecha"),
         "order_lines", f"SELECT id_pedido, fecha FROM order_lines WHERE fecha < DATE '{TODAY}'")
register("q7_since_first_movement", lambda r: filters.since_first_movement(
    inventory.daily_stock(_flows(r), r.centres(), ALL_START, ALL_END), "id_ceda_agricultura", "fecha",
    ["dap_ton_total_entrada", "urea_ton_total_entrada"], TODAY, dt.date(1998, 11, 30)), FLOW_ROLES, f"""
SELECT s.* FROM (SELECT * FROM ({STOCK}) x) s
JOIN (SELECT id_ceda_agricultura AS c, coalesce(min(fecha) FILTER (dap_ton_total_entrada > 0 OR urea_ton_total_entrada > 0), DATE '{TODAY}') AS m
  FROM ({STOCK}) y GROUP BY 1) f ON f.c = s.id_ceda_agricultura
WHERE s.fecha >= f.m AND s.fecha <= DATE '1998-11-30'""", dbl=f"{FLOW_DBL} {INV}")
register("q9_filter_positive", lambda r: filters.filter_positive(r.centres(), "meta_dap_ton").select("id_ceda_agricultura", "meta_dap_ton"), "centres",
         "SELECT id_ceda_agricultura, meta_dap_ton FROM centres WHERE meta_dap_ton > 0", dbl="meta_dap_ton")
register("q10_only_authorised", lambda r: filters.only_authorised(r.order_lines()), "order_lines",
         "SELECT * FROM order_lines WHERE estatus_pedido_detalle = 'Autorizado'", dbl="dap urea")
register("q11_null_safe_difference", lambda r: r.deliveries().filter(dedupe.differs(F.col("ton_dap_entregada"), F.col("ton_urea_entregada")))
         .select("acuse_estatal"), "deliveries", "SELECT acuse_estatal FROM deliveries WHERE ton_dap_entregada IS DISTINCT FROM ton_urea_entregada")
register("q12_check_not_null", lambda r: dedupe.check_not_null(r.freight(), ["folio_del_flete", "fecha_de_salida", "fecha_de_entrega"]), "freight",
         """SELECT count(*) FILTER (folio_del_flete IS NULL) AS folio_del_flete, count(*) FILTER (fecha_de_salida IS NULL) AS fecha_de_salida,
  count(*) FILTER (fecha_de_entrega IS NULL) AS fecha_de_entrega FROM freight""")
register("q13_bad_dates", lambda r: dedupe.bad_dates(r.raw("orders").selectExpr("o_orderkey", """CASE o_orderstatus
    WHEN 'F' THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 'O' THEN date_format(o_orderdate, 'yyyy-MM-dd') END AS fecha"""), "fecha", "d/M/yyyy"), "",
         "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders WHERE o_orderstatus = 'O'")
register("q14_open_date_window", lambda r: filters.open_date_window(r.deliveries(), "fecha_entrega", dt.date(1998, 3, 31), dt.date(1998, 5, 1)).select(
    "acuse_estatal", "fecha_entrega"), "deliveries",
         "SELECT acuse_estatal, fecha_entrega FROM deliveries WHERE fecha_entrega > DATE '1998-03-31' AND fecha_entrega < DATE '1998-05-01'")
register("q15_has_coordinates", lambda r: filters.has_coordinates(r.centres()).select("id_ceda_agricultura", "latitud", "longitud"), "centres",
         "SELECT id_ceda_agricultura, latitud, longitud FROM centres WHERE latitud IS NOT NULL AND longitud IS NOT NULL", dbl="latitud longitud")

# ---- joins and corrections -----------------------------------------------------------------------

register("j2_left_enrichment", lambda r: r.order_lines().join(freight.centre_context(r.centres()), F.col("folio_cdf") == F.col("id_ceda_agricultura"), "left"),
         "centres order_lines", """SELECT o.*, rd.id_ceda_agricultura, rd.coordinacion_estatal AS unidad_operativa, rd.estado, rd.zona_operativa
FROM order_lines o LEFT JOIN centres rd ON rd.id_ceda_agricultura = o.folio_cdf""", dbl="dap urea")
register("j3_inner_registry", lambda r: r.deliveries().join(dedupe.first_per_key(
    r.registry().select("acuse_estatal", "estatus"), ["acuse_estatal"]), "acuse_estatal").select("acuse_estatal", "estatus", "cdf_entrega"),
         "registry deliveries", "SELECT d.acuse_estatal, estatus, cdf_entrega FROM deliveries d JOIN registry p ON p.acuse_estatal = d.acuse_estatal")
register("j6_absent_receipts", lambda r: dedupe.rows_absent(r.registry(), r.deliveries(), "acuse_estatal").select("acuse_estatal").distinct(),
         "registry deliveries", "SELECT acuse_estatal FROM registry EXCEPT SELECT acuse_estatal FROM deliveries")
register("j7_removal_list", lambda r: dedupe.rows_absent(
    r.raw("events").selectExpr("event_id", "CASE WHEN event_type <> 'error' THEN user_id END AS clave"),
    r.raw("supplier").selectExpr("CASE WHEN s_acctbal > 0 THEN s_suppkey END AS baja"), "clave", "baja"), "",
         """SELECT event_id, clave FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS clave FROM events) e
WHERE clave IS NULL OR clave NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
register("j9_present_receipts", lambda r: dedupe.rows_present(r.registry().select("acuse_estatal", "estatus"), r.deliveries(), "acuse_estatal"),
         "registry deliveries", "SELECT acuse_estatal, estatus FROM registry WHERE acuse_estatal IN (SELECT acuse_estatal FROM deliveries)")
_BASE = "o_orderkey AS folio", "o_orderpriority AS estatus"


def _corrected(r):
    fixed = r.raw("orders").filter("o_orderstatus = 'P'").selectExpr("o_orderkey + 5 AS folio", "'corregido' AS estatus")
    return r.raw("orders").selectExpr(*_BASE), fixed


register("j10_corrections_win", lambda r: dedupe.corrections_win(*_corrected(r), "folio"), "",
         """SELECT o_orderkey AS folio, o_orderpriority AS estatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey + 5 FROM orders
  WHERE o_orderstatus = 'P') UNION ALL SELECT o_orderkey + 5, 'corregido' FROM orders WHERE o_orderstatus = 'P'""")
register("j10_corrections_append", lambda r: _corrected(r)[0].unionByName(_corrected(r)[1]), "",
         """SELECT o_orderkey AS folio, o_orderpriority AS estatus FROM orders
UNION ALL SELECT o_orderkey + 5, 'corregido' FROM orders WHERE o_orderstatus = 'P'""")
register("j11_centre_from_deliveries", lambda r: dedupe.update_from(
    r.registry().select("acuse_estatal", "id_ceda_agricultura"), r.deliveries(), F.upper(F.trim("acuse_estatal")), F.upper(F.trim("acuse_estatal")),
    "id_ceda_agricultura", F.when(F.trim("cdf_entrega") != "", F.trim("cdf_entrega"))), "registry deliveries",
         """SELECT p.acuse_estatal, coalesce(nullif(trim(d.cdf_entrega), ''), p.id_ceda_agricultura) AS id_ceda_agricultura
FROM registry p LEFT JOIN deliveries d ON upper(trim(d.acuse_estatal)) = upper(trim(p.acuse_estatal))""")
register("j11_surface_for_one_state", lambda r: dedupe.update_from(
    r.deliveries().select("acuse_estatal", "estado_predio_capturada", F.col("superficie_apoyada").cast("bigint").alias("superficie_apoyada")), r.registry(),
    F.col("acuse_estatal"), F.col("acuse_estatal"), "superficie_apoyada", F.expr("CASE WHEN superficie % 4 > 0 THEN superficie END"), F.col("estado_predio_capturada") == "NATION_7", empty="set"),
         "registry deliveries", """SELECT d.acuse_estatal, estado_predio_capturada,
  CASE WHEN estado_predio_capturada = 'NATION_7' AND p.acuse_estatal IS NOT NULL THEN p.superficie ELSE superficie_apoyada END AS superficie_apoyada
FROM deliveries d LEFT JOIN (SELECT acuse_estatal, CASE WHEN superficie % 4 > 0 THEN superficie END AS superficie FROM registry) p
  ON p.acuse_estatal = d.acuse_estatal""")
register("j11_centre_from_registry_file", lambda r: batch.centre_from_registry_file(
    r.registry().select("acuse_estatal", "id_ceda_agricultura"), r.raw("orders").selectExpr(
        "cast(o_orderkey AS string) AS acuse_estatal", "CASE o_orderstatus WHEN 'F' THEN concat(' CEDA-', o_custkey, ' ') WHEN 'O' THEN '  ' END AS id_ceda")),
         "registry", """SELECT p.acuse_estatal, CASE WHEN o_orderstatus = 'F' THEN 'CEDA-' || o_custkey ELSE p.id_ceda_agricultura END AS id_ceda_agricultura
FROM registry p LEFT JOIN orders o ON CAST(o_orderkey AS VARCHAR) = p.acuse_estatal""")
register("j11_tons_from_registry", lambda r: batch.tons_from_registry(r.deliveries().select(
    "acuse_estatal", "ton_dap_entregada", "ton_urea_entregada", "dap_anio_actual", "urea_anio_actual"), r.registry()), "registry deliveries", """
SELECT acuse_estatal, CASE WHEN x THEN coalesce(pd, 0) ELSE ton_dap_entregada END AS ton_dap_entregada,
  CASE WHEN x THEN coalesce(pu, 0) ELSE ton_urea_entregada END AS ton_urea_entregada,
  CASE WHEN x THEN CAST(round(coalesce(pd, 0) * 40) AS INTEGER) ELSE dap_anio_actual END AS dap_anio_actual,
  CASE WHEN x THEN CAST(round(coalesce(pu, 0) * 40) AS INTEGER) ELSE urea_anio_actual END AS urea_anio_actual
FROM (SELECT d.*, p.dap_ton AS pd, p.urea_ton AS pu, p.acuse_estatal IS NOT NULL AND (d.ton_dap_entregada IS DISTINCT FROM p.dap_ton
    OR d.ton_urea_entregada IS DISTINCT FROM p.urea_ton) AS x
  FROM deliveries d LEFT JOIN registry p ON p.acuse_estatal = d.acuse_estatal) y""",
         dbl="ton_dap_entregada ton_urea_entregada")
# several suppliers share a nation: the lookup must not multiply rows
register("j12_normalised_key_join", lambda r: dedupe.update_from(
    r.raw("customer").selectExpr("c_custkey", "concat(' nation_', c_nationkey) AS clave", "c_acctbal AS saldo"),
    r.raw("supplier").selectExpr("concat('Nation_', s_nationkey, ' ') AS clave", "s_acctbal AS saldo"),
    F.upper(F.trim("clave")), F.upper(F.trim("clave")), "saldo", F.col("saldo")), "", """
SELECT c_custkey, ' nation_' || c_nationkey AS clave, coalesce(m, c_acctbal) AS saldo FROM customer
LEFT JOIN (SELECT s_nationkey, min(s_acctbal) AS m FROM supplier GROUP BY 1) s ON s_nationkey = c_nationkey""")
register("j13_difference_report", lambda r: dedupe.difference_report(
    r.deliveries().select("acuse_estatal", F.col("ton_dap_entregada").alias("dap_ton"), F.col("ton_urea_entregada").alias("urea_ton")),
    r.registry(), "acuse_estatal", ["dap_ton", "urea_ton"]), "registry deliveries", """
SELECT d.acuse_estatal, ton_dap_entregada AS dap_ton, ton_urea_entregada AS urea_ton, p.dap_ton AS dap_ton_ref, p.urea_ton AS urea_ton_ref
FROM deliveries d JOIN registry p ON p.acuse_estatal = d.acuse_estatal
WHERE ton_dap_entregada IS DISTINCT FROM p.dap_ton OR ton_urea_entregada IS DISTINCT FROM p.urea_ton""", dbl="dap_ton urea_ton dap_ton_ref urea_ton_ref")
register("j14_map_lookup", lambda r: dedupe.map_lookup(
    r.raw("customer").selectExpr("c_custkey", "c_nationkey AS clave", "c_mktsegment AS nombre", "c_acctbal AS saldo"),
    r.raw("supplier").selectExpr("s_nationkey AS clave", "s_suppkey AS n", "s_name AS prov", "s_acctbal AS cuenta"),
    "clave", {"nombre": "prov", "saldo": "cuenta"}, "n"), "", """
SELECT c_custkey, c_nationkey AS clave, s_name AS nombre, s_acctbal AS saldo FROM customer
LEFT JOIN (SELECT DISTINCT ON (s_nationkey) * FROM supplier ORDER BY s_nationkey, s_suppkey DESC) s ON s_nationkey = c_nationkey""")
register("j16_conditional_updates", lambda r: dedupe.set_where(
    dedupe.set_where(r.deliveries(), "superficie_apoyada", F.col("estado_predio_capturada").isin("NATION_3", "NATION_8"), F.lit(1)),
    "ton_dap_entregada", (F.coalesce("ton_dap_entregada", F.lit(0)) == 0) & (F.coalesce("ton_urea_entregada", F.lit(0)) == 0),
    (F.col("dap_anio_actual") * F.lit("0.025").cast("decimal(4,3)")).cast("decimal(18,3)")).select(
    "acuse_estatal", "superficie_apoyada", "ton_dap_entregada"), "deliveries", """
SELECT acuse_estatal, CASE WHEN estado_predio_capturada IN ('NATION_3', 'NATION_8') THEN 1 ELSE superficie_apoyada END AS superficie_apoyada,
  CASE WHEN coalesce(ton_dap_entregada, 0) = 0 AND coalesce(ton_urea_entregada, 0) = 0 THEN dap_anio_actual * 0.025 ELSE ton_dap_entregada END
  AS ton_dap_entregada FROM deliveries""", dbl="ton_dap_entregada")

# ---- one row per key -----------------------------------------------------------------------------

register("w3_first_per_key", lambda r: dedupe.first_per_key(r.raw("lineitem"), ["l_orderkey"], ["l_shipdate", "l_partkey"]), "", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) x WHERE rn = 1""")
register("w4_keep_last", lambda r: dedupe.last_per_key(r.raw("events"), ["user_id"], ["ts", "event_id"]), "", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""")
register("w4_first_per_state_zone", lambda r: dedupe.first_per_key(
    r.centres().select("estado", "zona_operativa", "id_ceda_agricultura", "nombre_cedas"), ["estado", "zona_operativa"], ["id_ceda_agricultura"]), "centres",
         """SELECT DISTINCT ON (estado, zona_operativa) estado, zona_operativa, id_ceda_agricultura, nombre_cedas FROM centres
ORDER BY estado, zona_operativa, id_ceda_agricultura""")
register("k13_duplicate_rows", lambda r: sinks.duplicate_rows(r.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), "l_orderkey"), "",
         "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)")
register("k13_empty_keys", lambda r: sinks.empty_key_rows(r.raw("orders").selectExpr(
    "o_orderkey", "CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN '  ' END AS clave"), "clave"), "",
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '  ' END AS clave FROM orders WHERE o_orderstatus <> 'F'")

# ---- upserts as row sets -------------------------------------------------------------------------


def _incoming(r):
    return r.raw("orders").filter("o_orderpriority = '2-HIGH'").selectExpr(
        "o_orderkey * 2 AS o_orderkey", "o_custkey", "'X' AS o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


_INCOMING = """SELECT o_orderkey * 2 AS o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '2-HIGH'"""
register("k7_upsert", lambda r: sinks.upsert(r.raw("orders"), _incoming(r), ["o_orderkey"]), "",
         f"SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_INCOMING}) i) UNION ALL {_INCOMING}")
register("k8_insert_if_absent", lambda r: sinks.new_rows(r.raw("orders"), _incoming(r), ["o_orderkey"]), "",
         f"SELECT * FROM ({_INCOMING}) i WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
register("k10_replace_where", lambda r: sinks.replace_where(
    r.raw("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("p")),
    F.col("p").isin("1-URGENT", "5-LOW"), r.raw("customer").selectExpr("c_custkey AS o_orderkey", "'1-URGENT' AS p")), "", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS p FROM orders
WHERE o_orderstatus = 'P' OR o_orderpriority NOT IN ('1-URGENT', '5-LOW') UNION ALL SELECT c_custkey, '1-URGENT' FROM customer""")

# ---- aggregates ----------------------------------------------------------------------------------

register("a1_group_sums", lambda r: r.raw("lineitem").groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
    F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,3)")).alias("q")), "",
         "SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,3))) AS q FROM lineitem GROUP BY 1, 2, 3", dbl="q")


register("a7_distinct_by_surface", lambda r: summaries.surface_summary(
    r.deliveries().withColumn("ha", F.col("dap_anio_actual") - 3), "curp_renapo", "ha", "ton_dap_entregada", "ton_urea_entregada"), "deliveries", """
SELECT CASE WHEN ha < 5 THEN '0 a 4' WHEN ha < 10 THEN '5 a 9' WHEN ha < 15 THEN '10 a 14' WHEN ha < 20 THEN '15 a 19' ELSE '20 o más' END AS rango_superficie,
  CAST(least(floor(ha / 5), 4) AS INTEGER) AS orden, count(DISTINCT curp_renapo) AS productores, sum(ha) AS superficie_total_ha,
  sum(ton_dap_entregada) AS ton_dap_entregada, sum(ton_urea_entregada) AS ton_urea_entregada,
  coalesce(sum(ton_dap_entregada), 0) + coalesce(sum(ton_urea_entregada), 0) AS ton_total_entregada
FROM (SELECT *, dap_anio_actual - 3 AS ha FROM deliveries) d WHERE ha >= 0 GROUP BY 1, 2""",
         dbl="ton_dap_entregada ton_urea_entregada ton_total_entregada", big="superficie_total_ha")
STATUSES = ["Acceso Directo 2024", "Acceso Directo 2025", "Nuevo Ingreso 2025", "NUEVO INGRESO complemento"]
register("a8_pivot_by_status", lambda r: summaries.pivot_status(
    dedupe.rows_present(r.registry(), r.deliveries(), "acuse_estatal"), "municipio_predio_inegi", "estatus", STATUSES,
    {"conteo": F.count(F.lit(1)), "dap_ton_sum": F.sum("dap_ton"), "urea_ton_sum": F.sum("urea_ton")}), "registry deliveries",
         "SELECT municipio_predio_inegi, " + ", ".join(
    f"{agg} FILTER (coalesce(estatus, 'sin_estatus') = '{s}'){end} AS \"{s.replace(' ', '_')}__{m}\"" for s in [*STATUSES, "sin_estatus"]
    for m, agg, end in (("conteo", "count(*)", ""), ("dap_ton_sum", "coalesce(sum(dap_ton)", ", 0)"), ("urea_ton_sum", "coalesce(sum(urea_ton)", ", 0)")))
    + " FROM registry WHERE acuse_estatal IN (SELECT acuse_estatal FROM deliveries) GROUP BY 1",
    dbl=" ".join(f"{s.replace(' ', '_')}__{m}" for s in [*STATUSES, "sin_estatus"] for m in ("dap_ton_sum", "urea_ton_sum")))


def _full(r):
    return r.registry().selectExpr(
        "acuse_estatal", "id_ceda_agricultura AS id_persona", "nombre", "primer_apellido", "segundo_apellido", "curp_renapo",
        "concat('NATION_', superficie) AS estado_predio_capturada", "municipio_predio_inegi AS municipio_predio_capturada",
        "CASE WHEN superficie > 4 THEN 'RIE' ELSE 'TEM' END AS regimen_hidrico")


_WINDOW = "fecha_entrega > DATE '1998-03-31' AND fecha_entrega < DATE '1998-05-01'"
_PEOPLE = f"""SELECT p.id_ceda_agricultura AS id_suri, p.nombre, p.primer_apellido AS "primer apellido", p.segundo_apellido AS "segundo apellido",
  p.curp_renapo AS curp, 'NATION_' || p.superficie AS estado, p.municipio_predio_inegi AS municipio, 'N/A' AS bancarizado, 'APOYADO' AS estatus,
  'apoyo 1998' AS programa FROM registry p JOIN deliveries d USING (acuse_estatal) WHERE {_WINDOW}"""
register("c35_supported_people", lambda r: reports.supported_people(_full(r), r.deliveries(), dt.date(1998, 3, 31), dt.date(1998, 5, 1), "apoyo 1998"),
         "registry deliveries", _PEOPLE)
register("c35_supported_people_of_state", lambda r: reports.supported_people(
    _full(r), r.deliveries(), dt.date(1998, 3, 31), dt.date(1998, 5, 1), "apoyo 1998", "NATION_3"), "registry deliveries", _PEOPLE + " AND p.superficie = 3")
register("c35_producers_by_locality", lambda r: reports.producers_by_locality(
    r.deliveries().withColumns({"ln_nombre": F.col("nombre_ddr"), "sn_primer_apellido": F.col("cultivo"),
                                "sn_segundo_apellido": F.when(F.col("superficie_apoyada") > 2, F.lit(" ")).otherwise(F.col("cdf_entrega"))}),
    _full(r)), "registry deliveries", """SELECT estado_predio_capturada AS "Nombre de estado", municipio_predio_capturada AS "Nombre de municipio",
  CASE WHEN superficie_apoyada > 2 THEN concat_ws(' ', nombre_ddr, cultivo) ELSE concat_ws(' ', nombre_ddr, cultivo, cdf_entrega) END AS "Nombre de Productor",
  'N/A' AS "Grupo de cultivos", d.curp_renapo AS "CURP", cultivo AS "Cultivo", 'N/A' AS "Estrato",
  CASE WHEN p.superficie > 4 THEN 'RIE' WHEN p.superficie IS NOT NULL THEN 'TEM' END AS "Régimen Hídrico",
  superficie_apoyada AS "Superficie (Hectáreas)", 'N/A' AS "Colmenas" FROM deliveries d LEFT JOIN registry p USING (acuse_estatal)""")

# ---- daily series --------------------------------------------------------------------------------


def _daily(r):
    return dl.deliveries_by_day(r.deliveries(), ALL_START, ALL_END)


def _supply_days(r):
    return orders.supply_by_day(r.freight(), r.remnants(), ALL_START, ALL_END, with_transit=False)


_V = "total_ton_entregada"
_POS = f"(SELECT * FROM ({DAILY}) d WHERE total_ton_entregada > 0)"
_REC = f"(SELECT fecha, total_recibido_ton FROM ({_supply(False)}) s WHERE total_recibido_ton > 0)"
_BOTH = (f"(SELECT coalesce(a.fecha, b.fecha) AS fecha, coalesce(total_recibido_ton, 0) AS total_recibido_ton, coalesce({_V}, 0) AS {_V} "
         f"FROM {_REC} a FULL JOIN {_POS} b ON a.fecha = b.fecha)")
_2 = f"total_recibido_ton {_V}"


def _both(r):
    left = filters.filter_positive(_supply_days(r), "total_recibido_ton").select("fecha", "total_recibido_ton")
    return dedupe.full_outer_by_date(left, filters.filter_positive(_daily(r), _V).select("fecha", _V))


register("w5_cumulative_series", lambda r: series.cumulative(_daily(r), _V, "acumulado"), "deliveries",
         f"SELECT fecha, sum({_V}) OVER (ORDER BY fecha) AS acumulado FROM {_POS} p", dbl="acumulado")
register("w6_gaps_as_of", lambda r: series.gaps_as_of({
    "proyectado": (orders.projection_by_day(r.projection(), ALL_START, ALL_END), "abasto_proy_ton"),
    "abasto": (orders.supply_by_day(r.freight(), r.remnants(), ALL_START, ALL_END), "total_recibido_ton"),
    "entregado": (_daily(r), _V),
    "pedido": (orders.orders_and_remnants_by_day(r.order_lines(), r.remnants(), ALL_START, ALL_END), "pedido_total_ton")}, TODAY),
         "freight remnants deliveries order_lines projection", f"""
SELECT p AS proyectado, a AS abasto, e AS entregado, o AS pedido, a - p AS abasto_menos_proyectado, e - p AS entregado_menos_proyectado,
  o - a AS pedidos_por_atender, a - e AS inventario_mas_transito
FROM (SELECT coalesce(sum(toneladas_programadas), 0) AS p FROM projection WHERE fecha >= DATE '{ALL_START}' AND fecha < DATE '{TODAY}') x,
  (SELECT coalesce(sum(total_recibido_ton), 0) AS a FROM ({_supply(True)}) s WHERE fecha < DATE '{TODAY}') y,
  (SELECT coalesce(sum({_V}), 0) AS e FROM ({DAILY}) d WHERE fecha < DATE '{TODAY}') z,
  (SELECT coalesce(sum(pedido_total_ton), 0) AS o FROM ({ORD_REM}) q WHERE fecha < DATE '{TODAY}') w""",
         dbl="proyectado abasto entregado pedido abasto_menos_proyectado entregado_menos_proyectado pedidos_por_atender inventario_mas_transito")
register("w7_weekly_peak_days", lambda r: series.weekly_peak_days(filters.filter_positive(_daily(r), "derechohabientes_apoyados"), ["derechohabientes_apoyados"]),
         "deliveries", f"""
SELECT anio_iso, semana, fecha, valor FROM (SELECT isoyear(fecha) AS anio_iso, week(fecha) AS semana, fecha, derechohabientes_apoyados AS valor,
  row_number() OVER (PARTITION BY isoyear(fecha), week(fecha) ORDER BY derechohabientes_apoyados DESC, fecha) AS rn
  FROM ({DAILY}) d WHERE derechohabientes_apoyados > 0 AND isodow(fecha) <= 4) x WHERE rn = 1""")
register("w7_weekly_peak_of_two", lambda r: series.weekly_peak_days(_both(r), ["total_recibido_ton", _V], with_year=False),
         "freight remnants deliveries", f"""
SELECT semana, fecha, valor FROM (SELECT week(fecha) AS semana, fecha, total_recibido_ton + {_V} AS valor,
  row_number() OVER (PARTITION BY week(fecha) ORDER BY total_recibido_ton + {_V} DESC, fecha) AS rn FROM {_BOTH} b WHERE isodow(fecha) <= 4) x WHERE rn = 1""",
         dbl="valor")
register("w8_penultimate_date", lambda r: series.penultimate_date(filters.filter_positive(_daily(r), _V)), "deliveries",
         f"SELECT fecha FROM {_POS} p ORDER BY fecha DESC LIMIT 1 OFFSET 1")
_FLAGS = f"""
SELECT * FROM (SELECT fecha, %s, isodow(fecha) = 5 AND NOT (%s fecha = f AND f <> m) AS es_viernes, rn = 2 AS es_penultima, %s, %s AS es_pico
FROM (SELECT *, max(fecha) OVER () AS m, max(CASE WHEN isodow(fecha) = 5 THEN fecha END) OVER () AS f, row_number() OVER (ORDER BY fecha DESC) AS rn, %s
  FROM %s b) y) z WHERE es_viernes OR es_penultima OR es_pico"""
register("w9_label_days", lambda r: series.label_days(filters.filter_positive(freight.shipments_by_day(r.freight()), "total_ton_enviadas"),
                                                      ["total_ton_enviadas"], drop_last_friday=True), "freight",
         _FLAGS % ("total_ton_enviadas", "", "umbral_total_ton_enviadas", "total_ton_enviadas >= umbral_total_ton_enviadas",
                   "quantile_cont(CAST(total_ton_enviadas AS DOUBLE), 0.75) OVER () AS umbral_total_ton_enviadas",
                   """(SELECT fecha_de_salida AS fecha, sum(CASE WHEN abreviacion_producto IN ('DAP', 'URE') THEN toneladas_iniciales ELSE 0 END)
  AS total_ton_enviadas FROM freight WHERE fecha_de_salida IS NOT NULL GROUP BY 1 HAVING total_ton_enviadas > 0)"""), dbl="total_ton_enviadas")
register("w9_label_days_of_two", lambda r: series.label_days(_both(r), ["total_recibido_ton", _V]), "freight remnants deliveries",
         _FLAGS % (f"total_recibido_ton, {_V}", "FALSE AND", f"umbral_total_recibido_ton, umbral_{_V}",
                   f"total_recibido_ton >= umbral_total_recibido_ton OR {_V} >= umbral_{_V}",
                   f"quantile_cont(CAST(total_recibido_ton AS DOUBLE), 0.75) OVER () AS umbral_total_recibido_ton, "
                   f"quantile_cont(CAST({_V} AS DOUBLE), 0.75) OVER () AS umbral_{_V}", _BOTH), dbl=_2)
register("a11_quantile_of_series", lambda r: series.quantile_of(filters.filter_positive(_daily(r), _V), _V, 0.75).select(
    F.round("cuantil", 6).alias("cuantil")), "deliveries", f"SELECT round(quantile_cont(CAST({_V} AS DOUBLE), 0.75), 6) AS cuantil FROM {_POS} p")
register("a11_quantile_of_table", lambda r: positions.exact_quantile(r.raw("lineitem"), "l_extendedprice", 0.3).select(
    F.round("cuantil", 6).alias("cuantil")), "", "SELECT round(quantile_cont(l_extendedprice, 0.3), 6) AS cuantil FROM lineitem")
register("a11_quantile_with_copies", lambda r: positions.exact_quantile(r.raw("lineitem"), "l_quantity", 0.75), "",
         "SELECT quantile_cont(l_quantity, 0.75) AS cuantil FROM lineitem")
register("a9_iso_week_sums", lambda r: series.iso_week_sums(_daily(r), [_V]), "deliveries", f"""
SELECT CAST(isoyear(fecha) AS VARCHAR) || '-' || lpad(CAST(week(fecha) AS VARCHAR), 2, '0') AS semana, sum({_V}) AS {_V} FROM ({DAILY}) d GROUP BY 1""", dbl=_V)
# severe losses are rare, so some weeks have none
_SAT = "fecha_incidente + CAST((6 - isodow(fecha_incidente) + 7) % 7 AS INTEGER)"
register("a9_saturday_week_sums", lambda r: series.saturday_week_sums(
    r.incidents().groupBy(F.col("fecha_incidente").alias("fecha")).agg(F.sum("ton_incidencia").alias("ton")), ["ton"]),
         "incidents", f"""
SELECT CAST(s AS DATE) AS fin_semana, week(CAST(s AS DATE)) AS semana, ton
FROM (SELECT unnest(generate_series(min({_SAT}), max({_SAT}), INTERVAL 7 DAY)) AS s FROM incidents) g
LEFT JOIN (SELECT {_SAT} AS f, sum(ton_incidencia) AS ton FROM incidents GROUP BY 1) w ON w.f = CAST(g.s AS DATE)""", dbl="ton")
register("a10_series_kpis", lambda r: series.series_kpis(_daily(r), "derechohabientes_apoyados", 2062239).select(
    "total", "maximo", "minimo", F.round("promedio", 6).alias("promedio"), F.round("porcentaje", 6).alias("porcentaje")), "deliveries", f"""
SELECT sum(n) AS total, max(n) AS maximo, min(n) AS minimo, round(avg(CAST(n AS DOUBLE)), 6) AS promedio, round(CAST(sum(n) AS DOUBLE) * 100 / 2062239, 6) AS porcentaje
FROM (SELECT derechohabientes_apoyados AS n FROM ({DAILY}) d WHERE derechohabientes_apoyados > 0) x""", big="total maximo minimo")
register("j8_full_outer_by_date", _both, "freight remnants deliveries", f"SELECT * FROM {_BOTH} b", dbl=_2)
register("w1_running_totals", lambda r: series.cumulative(_supply_days(r), "total_recibido_ton", "acum"), "freight remnants",
         f"SELECT fecha, sum(total_recibido_ton) OVER (ORDER BY fecha ROWS UNBOUNDED PRECEDING) AS acum FROM {_REC} x", dbl="acum")

# ---- paging, options, sets -----------------------------------------------------------------------

register("l1_null_order", lambda r: positions.number_rows(
    r.freight().select("folio_del_flete", "fecha_de_entrega"), filters.order_sql_style("-fecha_de_entrega", "folio_del_flete"), "lugar")
         .drop("total"), "freight",
         """SELECT folio_del_flete, fecha_de_entrega, row_number() OVER (ORDER BY fecha_de_entrega DESC NULLS FIRST, folio_del_flete) AS lugar
FROM freight""")
register("l2_page", lambda r: filters.page(r.freight().select("folio_del_flete", "fecha_de_salida", "toneladas_iniciales"), 3, 100,
                                           "-fecha_de_salida", "folio_del_flete"), "freight", """
SELECT folio_del_flete, fecha_de_salida, toneladas_iniciales FROM freight ORDER BY fecha_de_salida DESC NULLS FIRST, folio_del_flete LIMIT 100 OFFSET 200""",
         dbl="toneladas_iniciales")
register("l2_deep_page", lambda r: filters.page(r.freight().select("folio_del_flete", "fecha_de_salida"), 40, 100, "-fecha_de_salida",
                                                "folio_del_flete"), "freight", """
SELECT folio_del_flete, fecha_de_salida FROM freight ORDER BY fecha_de_salida DESC NULLS FIRST, folio_del_flete LIMIT 100 OFFSET 3900""")


def _stored_order(r):
    """Three pages of one stored order: the first, one far inside and the last."""
    path = scratch_path(r.spark, "orden")
    sorted_layout.store_sorted(r.freight().select("folio_del_flete", "fecha_de_salida", "toneladas_iniciales"), path, "-fecha_de_salida", "folio_del_flete")
    pages = [sorted_layout.sorted_page(r.spark, path, n, 100).withColumn("pagina", F.lit(name)) for n, name in ((1, "primera"), (40, "40"), (10**9, "última"))]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


register("l2_pages_of_stored_order", _stored_order, "freight", """
SELECT folio_del_flete, fecha_de_salida, toneladas_iniciales, CASE i // 100 WHEN 0 THEN 'primera' WHEN 39 THEN '40' ELSE 'última' END AS pagina
FROM (SELECT *, row_number() OVER (ORDER BY fecha_de_salida DESC NULLS FIRST, folio_del_flete) - 1 AS i, count(*) OVER () AS total FROM freight) n
WHERE i // 100 IN (0, 39, (total - 1) // 100)""", dbl="toneladas_iniciales")
register("l3_limit_with_full_summary", lambda r: filters.rows_with_summary(
    freight.enriched_freight(r.freight(), r.centres()), 10000, ["folio_del_flete"],
    {"fletes": F.count("*"), "toneladas": F.sum("toneladas_iniciales").cast("decimal(18,3)")})
         .select("folio_del_flete", "estado", "fletes", "toneladas"), "centres freight", f"""
SELECT folio_del_flete, estado, (SELECT count(*) FROM ({ENRICHED}) a) AS fletes, (SELECT sum(toneladas_iniciales) FROM ({ENRICHED}) b) AS toneladas
FROM ({ENRICHED}) e ORDER BY folio_del_flete LIMIT 10000""", dbl="toneladas")
_FOUND = """SELECT d.*, coordinacion_estatal AS unidad_operativa, estado, id_ceda_agricultura FROM deliveries d
LEFT JOIN centres ON cdf_entrega = id_ceda_agricultura WHERE coordinacion_estatal = 'ASIA' AND fecha_entrega BETWEEN DATE '1996-01-15' AND DATE '1998-03-31'"""
_ASKED = {"unidad_operativa": "ASIA", "estado": "", "fecha_inicio": "15/01/1996", "fecha_fin": "1998-03-31"}
register("deliveries_query", lambda r: dl.deliveries_query(dl.deliveries_with_centre(r.deliveries(), r.centres()), {
    **_ASKED, "lista_acuses": "\n".join(str(i) for i in range(0, 40000, 2))}).select("acuse_estatal", "estado", "fecha_entrega"), "deliveries centres", f"""
SELECT acuse_estatal, estado, fecha_entrega FROM ({_FOUND}) f WHERE acuse_estatal IN (SELECT CAST(2 * i AS VARCHAR) FROM range(20000) t(i))""")
register("deliveries_query_page", lambda r: dl.deliveries_query_page(
    dl.deliveries_with_centre(r.deliveries(), r.centres()), _ASKED, 10_000_000, ["acuse_estatal", "estado", "nada"]), "deliveries centres", f"""
SELECT acuse_estatal, estado FROM (SELECT *, row_number() OVER (ORDER BY acuse_estatal) AS n, count(*) OVER () AS k FROM ({_FOUND}) f) x
WHERE n > (k - 1) // 200 * 200""")
register("l4_option_list", lambda r: filters.option_list(r.raw("orders").selectExpr("CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderpriority END AS opcion"), "opcion"), "",
         "SELECT DISTINCT o_orderpriority AS opcion FROM orders WHERE o_orderstatus <> 'P'")
register("l5_dependent_options", lambda r: filters.dependent_options(r.centres(), "zona_operativa", {"coordinacion_estatal": "EUROPE", "estado": "NATION_18"}),
         "centres", "SELECT DISTINCT zona_operativa FROM centres WHERE coordinacion_estatal = 'EUROPE' AND estado = 'NATION_18'")
register("l6_sorted_output", lambda r: r.centres().select("estado", "coordinacion_estatal", "zona_operativa", "id_ceda_agricultura").orderBy(
    *filters.order_sql_style("estado", "coordinacion_estatal", "zona_operativa", "id_ceda_agricultura")), "centres",
         "SELECT estado, coordinacion_estatal, zona_operativa, id_ceda_agricultura FROM centres ORDER BY 1, 2, 3, 4")
register("u1_union_by_name", lambda r: r.raw("customer").selectExpr("c_custkey AS id", "c_name AS nombre", "c_mktsegment AS segmento").unionByName(
    r.raw("supplier").selectExpr("s_name AS nombre", "s_suppkey AS id"), allowMissingColumns=True), "",
         "SELECT c_custkey AS id, c_name AS nombre, c_mktsegment AS segmento FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
register("u2_distinct", lambda r: r.registry().select("id_ceda_agricultura", "estatus").distinct(), "registry",
         "SELECT DISTINCT id_ceda_agricultura, estatus FROM registry")
register("u3_set_difference", lambda r: r.registry().select("id_ceda_agricultura").distinct().join(
    r.deliveries().select(F.col("cdf_entrega").alias("id_ceda_agricultura")), "id_ceda_agricultura", "left_anti"),
         "registry deliveries", "SELECT id_ceda_agricultura FROM registry EXCEPT SELECT cdf_entrega FROM deliveries")

# ---- parts of the derived tables on their own ----------------------------------------------------

register("j1_star_left_joins", lambda r: r.deliveries().join(r.registry().select("acuse_estatal", "estatus"), "acuse_estatal", "left").join(
    freight.centre_context(r.centres()), F.col("cdf_entrega") == F.col("id_ceda_agricultura"), "left").select("acuse_estatal", "estatus", "estado"),
         "centres registry deliveries", """SELECT acuse_estatal, estatus, estado FROM deliveries LEFT JOIN registry USING (acuse_estatal)
LEFT JOIN centres c ON c.id_ceda_agricultura = cdf_entrega""")


def _order_facts(r):
    return r.order_lines().groupBy(F.col("folio_cdf").alias("id_ceda_agricultura"), "estatus_suministro", "fecha").agg(
        F.sum("dap").cast("decimal(18,3)").alias("dap"), F.count("*").alias("pedidos"))


def _grid(r, totals=()):
    pairs = r.order_lines().select(F.col("folio_cdf").alias("id_ceda_agricultura"), "estatus_suministro").distinct()
    return daily.day_spans(_order_facts(r), pairs, ["id_ceda_agricultura", "estatus_suministro"], ("dap", "pedidos"), ALL_START, ALL_END, totals=totals)


_GRID = f"""
SELECT k.id_ceda_agricultura, k.estatus_suministro, c.fecha, coalesce(sum(dap), 0) AS dap, count(o.id_pedido) AS pedidos
FROM (SELECT DISTINCT folio_cdf AS id_ceda_agricultura, estatus_suministro FROM order_lines) k CROSS JOIN {CAL} c
LEFT JOIN order_lines o ON o.folio_cdf = k.id_ceda_agricultura AND o.estatus_suministro = k.estatus_suministro AND o.fecha = c.fecha GROUP BY 1, 2, 3"""
register("j4_j5_calendar_grid", lambda r: daily.expand_days(_grid(r), ("dap", "pedidos")), "order_lines", _GRID, dbl="dap")
_DONE = "sum(pedidos) OVER (PARTITION BY id_ceda_agricultura, estatus_suministro ORDER BY fecha)"
register("w2_cumulative_percent", lambda r: daily.expand_days(_grid(r, ("pedidos",)).withColumn(
    "pct", F.when(F.length("id_ceda_agricultura") > 1, F.round(F.col("pedidos_acum").cast("decimal(18,0)") * 100 / 40, 2)).otherwise(0).cast("decimal(18,2)")),
    ("dap", "pedidos")).select("id_ceda_agricultura", "estatus_suministro", "fecha", "pedidos_acum", "pct"), "order_lines", f"""
SELECT id_ceda_agricultura, estatus_suministro, fecha, {_DONE} AS pedidos_acum, CASE WHEN length(id_ceda_agricultura) > 1 THEN {_DONE} * 2.5 ELSE 0 END AS pct
FROM ({_GRID}) g""", dbl="pct", big="pedidos_acum")
register("a2_conditional_sums", lambda r: r.freight().groupBy("id_ceda_agricultura").agg(
    F.count_if(freight.has_status("entregado")).alias("entregados"),
    F.coalesce(F.sum(F.when(freight.has_status("entregado"), F.col("toneladas_en_el_destino"))), F.lit(0)).alias("ton"),
    F.count_if(F.coalesce(F.col("toneladas_iniciales") > 40, F.lit(False))).alias("grandes")), "freight", """
SELECT id_ceda_agricultura, count(*) FILTER (estatus = 'Entregado') AS entregados, coalesce(sum(toneladas_en_el_destino) FILTER (estatus = 'Entregado'), 0) AS ton,
  count(*) FILTER (toneladas_iniciales > 40) AS grandes FROM freight GROUP BY 1""", dbl="ton")
register("a3_centre_to_state", lambda r: orders.network_summary(r.centres()).groupBy("estado").agg(
    F.coalesce(F.sum("suma_dap_ton"), F.lit(0)).alias("dap"), F.sum("suma_ha").alias("ha")), "centres",
         "SELECT estado, coalesce(sum(meta_dap_ton), 0) AS dap, sum(meta_superficie_ha) AS ha FROM centres GROUP BY 1", dbl="dap", big="ha")
