"""Cleaning and scalar rules C1-C36 over text made from the driver's tables.

The SQL states the expected value from the typed columns, so it does not repeat the parsing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import register
from granero.functions import classify, dates, numbers, text
from granero.sources import sinks

TODAY = dt.date(2024, 1, 20)


def _orders(r, *exprs: str):
    return r.raw("orders").selectExpr("o_orderkey", *exprs)


# ---- headers and layout --------------------------------------------------------------------------

ODD_HEADERS = ("o_orderkey AS `﻿Acuse Estatal`", "o_custkey AS `Id CEDA/Agrícola`", "o_orderpriority AS ` Publicación [Fecha]`",
               "o_orderstatus AS `Estatus (actual)`")
for _style, _names in {
    "plain": ("acuse_estatal", "id_ceda/agricola", "publicacion_[fecha]", "estatus_(actual)"),
    "strict": ("acuse_estatal", "id_ceda_agricola", "publicacion_fecha", "estatus_actual"),
    "parens": ("acuse_estatal", "id_ceda_agricola", "publicacion_fecha_", "estatus_(actual)"),
    "letters": ("acuse_estatal", "id_cedaagricola", "publicacion_fecha", "estatus_actual"),
}.items():
    register(f"c1_normalize_headers_{_style}",
             lambda r, s=_style: text.normalize_headers(r.raw("orders").selectExpr(*ODD_HEADERS), s), "",
             "SELECT o_orderkey AS \"{}\", o_custkey AS \"{}\", o_orderpriority AS \"{}\", o_orderstatus AS \"{}\" FROM orders".format(*_names))
register("c2_alias_columns", lambda r: text.alias_columns(
    r.raw("orders").selectExpr("o_orderkey AS acuse", "o_custkey AS `id ceda`", "cast(o_orderdate AS date) AS publicacion__fecha"),
    {"id ceda": "id_ceda_agricultura", "id_ceda": "id_ceda_agricultura", "publicacion__fecha": "fecha_de_publicacion"}), "",
         "SELECT o_orderkey AS acuse, o_custkey AS id_ceda_agricultura, CAST(o_orderdate AS DATE) AS fecha_de_publicacion FROM orders")


def _tolerant(r):
    df = r.raw("orders").selectExpr("o_orderkey AS `Clave Acuse Estatal`", "o_custkey AS `CEDA id (agricultura)`", "o_orderstatus AS Estatus")
    found = {w: text.find_column(df.columns, w) for w in ("estatus", "acuse estatal", "id ceda", "no existe")}
    return df.select(*[F.col(f"`{c}`").alias(w.replace(" ", "_")) for w, c in found.items() if c])


register("c2_tolerant_lookup", _tolerant, "", "SELECT o_orderstatus AS estatus, o_orderkey AS acuse_estatal, o_custkey AS id_ceda FROM orders")
TARGET = T.StructType([T.StructField("o_orderstatus", T.StringType()), T.StructField("nota", T.StringType()),
                       T.StructField("o_orderkey", T.LongType()), T.StructField("superficie", T.LongType())])
register("c4_align_to_schema", lambda r: sinks.align_to_schema(r.raw("orders"), TARGET), "",
         "SELECT o_orderstatus, CAST(NULL AS VARCHAR) AS nota, o_orderkey, CAST(NULL AS BIGINT) AS superficie FROM orders")

register("c4_strict_alignment", lambda r: sinks.align_to_schema(r.raw("orders"), T.StructType([TARGET["o_orderstatus"], TARGET["o_orderkey"]]), strict=True), "",
         "SELECT o_orderstatus, o_orderkey FROM orders")

# ---- numbers -------------------------------------------------------------------------------------

register("c5_null_tokens", lambda r: _orders(r, """CASE o_orderstatus WHEN 'F' THEN ' n/a ' WHEN 'O' THEN '-' ELSE o_orderpriority END AS v""")
         .select("o_orderkey", text.null_tokens(F.col("v")).alias("v"),
                 text.null_tokens(F.col("v"), text.NULL_TOKENS + text.MOVE_NULL_TOKENS + ("5-LOW",)).alias("v2")), "",
         """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS v,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN o_orderpriority END AS v2 FROM orders""")
register("c6_thousands_number", lambda r: _orders(
    r, "CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE concat(' ', format_number(o_totalprice, 2)) END AS v")
         .select("o_orderkey", numbers.to_number(F.col("v")).alias("v")), "",
         "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS v FROM orders", dbl="v")
_COMMA = "CASE o_orderstatus WHEN 'P' THEN 'nan' WHEN 'O' THEN '' ELSE replace(cast(cast(o_totalprice AS decimal(18,2)) AS string), '.', ',') END AS v"
register("c7_decimal_comma", lambda r: _orders(r, _COMMA).select(
    "o_orderkey", numbers.to_number_decimal_comma(F.col("v")).alias("v"), numbers.to_number_decimal_comma(F.col("v"), True).alias("v0")), "",
         """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS v,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS v0 FROM orders""", dbl="v v0")
register("c8_round3", lambda r: _orders(r, "cast(cast(o_totalprice AS decimal(18,2)) * 0.0125 AS string) AS v").select(
    "o_orderkey", numbers.round3(F.col("v")).alias("v")), "",
         "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0125 AS DECIMAL(18,3)) AS v FROM orders", dbl="v")
register("c9_to_int", lambda r: _orders(
    r, "CASE o_orderstatus WHEN 'P' THEN 'sin dato' WHEN 'O' THEN concat(o_custkey, '.0') ELSE cast(o_custkey AS string) END AS v").select(
    "o_orderkey", numbers.to_int(F.col("v")).alias("v"), numbers.to_int(F.col("v"), 0).alias("v0")), "",
         """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS INTEGER) AS v,
  CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey ELSE 0 END AS INTEGER) AS v0 FROM orders""")
register("c10_to_bool", lambda r: _orders(
    r, "CASE o_orderpriority WHEN '1-URGENT' THEN ' SÍ ' WHEN '2-HIGH' THEN 'True' WHEN '3-MEDIUM' THEN '' WHEN '5-LOW' THEN 'quizás' END AS v").select(
    "o_orderkey", text.to_bool(F.col("v")).alias("v")), "",
         """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN TRUE WHEN o_orderpriority = '5-LOW' THEN FALSE END AS v
FROM orders""")
_NUM = "CASE WHEN o_orderpriority = '5-LOW' THEN 'diez' ELSE replace(cast(cast(o_totalprice AS decimal(18,2)) * 0.00003 AS string), '.', ',') END AS v"
register("c11_enforce_numeric", lambda r: _orders(r, _NUM).select(
    "o_orderkey", numbers.enforce_numeric(F.col("v"), 4, 3).alias("n"), numbers.numeric_reject_reason(F.col("v"), 4, 3).alias("motivo")), "",
         """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' AND w < 10 THEN CAST(w AS DECIMAL(4,3)) END AS n,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'no_convertible' WHEN w >= 10 THEN 'overflow_4_3' END AS motivo
FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.00003 AS DECIMAL(18,3)) AS w FROM orders) o""", dbl="n")
register("c12_clip_to_max", lambda r: _orders(r, "cast(cast(o_totalprice AS decimal(18,2)) - 300000 AS string) AS v").select(
    "o_orderkey", numbers.clip_to_max(F.col("v"), 7, 2).alias("v")), "",
         """SELECT o_orderkey, greatest(least(CAST(o_totalprice AS DECIMAL(18,2)) - 300000, 99999.99), -99999.99) AS v FROM orders""", dbl="v")
register("c13_enforce_text", lambda r: r.raw("documents").select(
    "doc_id", text.enforce_text(F.col("text"), 30).alias("texto"), text.enforce_key(F.concat(F.col("source"), F.lit(" ")), 4).alias("clave"),
    text.text_reject_reason(F.col("text"), 30).alias("motivo"), text.text_reject_reason(F.col("source"), 4, True).alias("motivo_clave")), "",
         """SELECT doc_id, CASE WHEN trim(text, ' ') <> '' THEN substr(trim(text, ' '), 1, 30) END AS texto,
  CASE WHEN length(trim(source)) BETWEEN 1 AND 4 THEN trim(source) END AS clave,
  CASE WHEN length(trim(text, ' ')) > 30 THEN 'truncado_varchar_30' END AS motivo,
  CASE WHEN length(source) > 4 THEN 'pk_excede_varchar_4' END AS motivo_clave FROM documents""")

# ---- dates ---------------------------------------------------------------------------------------

_DATES = """CASE o_orderpriority WHEN '1-URGENT' THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN '2-HIGH' THEN date_format(o_orderdate, 'dd/MM/yyyy')
  WHEN '3-MEDIUM' THEN date_format(o_orderdate, 'd/M/yy') WHEN '4-NOT SPECIFIED' THEN date_format(o_orderdate, 'dd-MM-yy')
  ELSE CASE o_orderstatus WHEN 'F' THEN date_format(o_orderdate, 'MM/dd/yyyy') WHEN 'O' THEN '0000-00-00' ELSE '' END END AS v"""
_D = "CAST(o_orderdate AS DATE)"
# month-first text with a day up to 12 reads as day first
_EXPECT = f"""CASE WHEN o_orderpriority <> '5-LOW' THEN {_D} WHEN o_orderstatus = 'F' AND day({_D}) <= 12
  THEN make_date(year({_D}), day({_D}), month({_D})) WHEN o_orderstatus = 'F' THEN {_D} END"""
register("c14_parse_date", lambda r: _orders(r, _DATES).select("o_orderkey", dates.parse_date(F.col("v")).alias("d")), "",
         f"SELECT o_orderkey, {_EXPECT} AS d FROM orders")
register("c17_parse_date_or_sentinel", lambda r: _orders(r, _DATES).select(
    "o_orderkey", dates.parse_date_or_sentinel(F.col("v")).alias("d")), "",
         f"SELECT o_orderkey, coalesce({_EXPECT}, DATE '1900-01-01') AS d FROM orders")
register("c17_replaced_dates", lambda r: dates.replaced_dates(_orders(r, _DATES), "o_orderkey", "v"), "",
         """SELECT CAST(o_orderkey AS VARCHAR) AS clave, 'v' AS columna, CASE o_orderstatus WHEN 'O' THEN '0000-00-00' ELSE '' END AS valor
FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'F'""")
register("c15_parse_timestamp", lambda r: r.raw("events").selectExpr("event_id", """CASE event_type
    WHEN 'click' THEN date_format(ts, 'd/M/yy H:mm') WHEN 'view' THEN date_format(ts, 'dd/MM/yyyy HH:mm')
    WHEN 'signup' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 'error' THEN '0000-00-00 00:00:00' ELSE 'mañana' END AS v""").select(
    "event_id", dates.parse_timestamp(F.col("v")).alias("t")), "",
         """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN date_trunc('minute', ts)
  WHEN event_type = 'signup' THEN date_trunc('second', ts) END AS t FROM events""")
register("c16_parse_date_iso_first", lambda r: r.raw("events").selectExpr("event_id", """CASE event_type
    WHEN 'click' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 'view' THEN date_format(ts, 'd/M/yyyy H:mm') WHEN 'error' THEN ''
    ELSE date_format(ts, 'd-M-yy') END AS v""").select("event_id", dates.parse_date_iso_first(F.col("v")).alias("d")), "",
         "SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS d FROM events")
register("c32_iso_week_label", lambda r: r.raw("orders").select(
    "o_orderkey", dates.iso_week_label(F.to_date("o_orderdate")).alias("semana")), "",
         f"SELECT o_orderkey, CAST(isoyear({_D}) AS VARCHAR) || '-' || lpad(CAST(week({_D}) AS VARCHAR), 2, '0') AS semana FROM orders")
register("c21_days_elapsed", lambda r: r.deliveries().join(r.registry().select("acuse_estatal", "fecha_de_publicacion"), "acuse_estatal").select(
    "acuse_estatal", dates.days_elapsed(F.col("fecha_entrega"), F.col("fecha_de_publicacion")).alias("dias")), "registry deliveries",
         """SELECT d.acuse_estatal, date_diff('day', fecha_de_publicacion, fecha_entrega) + 1 AS dias FROM deliveries d
JOIN registry p ON p.acuse_estatal = d.acuse_estatal""", big="dias")

# ---- rules ---------------------------------------------------------------------------------------

register("c18_assign_centre", lambda r: r.freight().select("folio_del_flete", "id_ceda_agricultura"), "freight",
         "SELECT folio_del_flete, id_ceda_agricultura FROM freight")
register("c18_assign_centre_move", lambda r: r.transfers().select("folio_transferencia", "id_ceda_agricultura"), "transfers",
         "SELECT folio_transferencia, id_ceda_agricultura FROM transfers")


def _zones(r):
    df = _orders(r, "CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS `zona norte`", "CASE o_orderstatus WHEN 'O' THEN ' ' END AS `zona centro`",
                 "cast(o_custkey AS string) AS `zona sur`")
    return df.select("o_orderkey", text.coalesce_prefix(df, "zona").alias("zona"), text.coalesce_prefix(df, "otra").alias("otra"))


register("c19_coalesce_prefix", _zones, "",
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS zona, CAST(NULL AS VARCHAR) AS otra FROM orders")
register("c20_classify_list", lambda r: r.registry().select("acuse_estatal", classify.classify_list(F.col("estatus")).alias("incorporacion")), "registry",
         """SELECT acuse_estatal, CASE WHEN lower(coalesce(estatus, '')) LIKE '%nuevo ingreso%' THEN 'NUEVO INGRESO' ELSE 'ACCESO DIRECTO' END
  AS incorporacion FROM registry""")
register("c22_full_name", lambda r: r.registry().select("acuse_estatal", text.full_name(
    F.when(F.col("superficie") > 0, F.col("nombre")), F.col("primer_apellido"), F.col("segundo_apellido")).alias("nombre_completo")), "registry",
         """SELECT acuse_estatal, CASE WHEN superficie > 0 THEN nombre || ' ' || primer_apellido ||
  CASE WHEN coalesce(segundo_apellido, '') <> '' THEN ' ' || segundo_apellido ELSE '' END END AS nombre_completo FROM registry""")
register("c23_sex_from_curp", lambda r: r.deliveries().select("acuse_estatal", text.sex_from_curp(F.col("curp_renapo")).alias("sexo")),
         "deliveries", "SELECT acuse_estatal, upper(substr(curp_renapo, 11, 1)) AS sexo FROM deliveries")
register("c24_bags_and_tons", lambda r: r.freight().select(
    "folio_del_flete", numbers.bags_to_tons(F.col("bultos_iniciales")).alias("ton"),
    numbers.tons_to_bags(F.col("toneladas_en_el_destino")).alias("bultos")), "freight",
         """SELECT folio_del_flete, bultos_iniciales * 0.025 AS ton, CAST(round(toneladas_en_el_destino * 40, 0) AS BIGINT) AS bultos FROM freight""",
         dbl="ton")
register("c25_default_if_null", lambda r: r.order_summary().select("id_cdf", numbers.default_if_null(F.col("dap_solicitado")).alias("dap")),
         "order_summary", "SELECT id_cdf, coalesce(dap_solicitado, 3) AS dap FROM order_summary", dbl="dap")
register("c26_bucket_surface", lambda r: r.raw("lineitem").selectExpr("l_orderkey", "l_partkey", "l_linenumber", "l_quantity - 3 AS q").select(
    "l_orderkey", "l_partkey", "l_linenumber", classify.bucket_surface(F.col("q")).alias("rango"), classify.surface_order(F.col("q")).alias("orden")), "",
         """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_quantity < 3 THEN NULL WHEN l_quantity < 8 THEN '0 a 4'
  WHEN l_quantity < 13 THEN '5 a 9' WHEN l_quantity < 18 THEN '10 a 14' WHEN l_quantity < 23 THEN '15 a 19' ELSE '20 o más' END AS rango,
  CAST(CASE WHEN l_quantity < 3 THEN NULL ELSE least(floor((l_quantity - 3) / 5), 4) END AS INTEGER) AS orden FROM lineitem""")
register("c27_diff_category", lambda r: r.freight().select("folio_del_flete", classify.diff_category(
    F.col("toneladas_iniciales") - F.col("toneladas_en_el_destino")).alias("categoria")), "freight",
         """SELECT folio_del_flete, CASE WHEN d IS NULL THEN '—' WHEN d < 0 THEN CASE WHEN d > -1 THEN '< -1 ton' WHEN d > -10 THEN '< -10 ton'
  ELSE '> -10 ton' END WHEN d > 0 THEN CASE WHEN d < 1 THEN '< 1 ton' WHEN d < 10 THEN '< 10 ton' ELSE '> 10 ton' END ELSE '0.000' END AS categoria
FROM (SELECT *, toneladas_iniciales - toneladas_en_el_destino AS d FROM freight) f""")
register("c28_stock_gap_class", lambda r: r.freight().select("folio_del_flete", classify.stock_gap_class(
    F.col("toneladas_iniciales") - F.col("toneladas_en_el_destino")).alias("clase")), "freight",
         """SELECT folio_del_flete, CASE WHEN d < -1 THEN 'faltante_grave' WHEN d < -0.01 THEN 'faltante_menor' WHEN d > 1 THEN 'excedente_grave'
  WHEN d > 0.01 THEN 'excedente_menor' ELSE 'sin_diferencia' END AS clase
FROM (SELECT *, toneladas_iniciales - toneladas_en_el_destino AS d FROM freight) f""")
register("c29_reporting_compliance", lambda r: r.field_reports().select(
    "id_reporte", classify.days_late(F.to_date("fecha_y_hora"), TODAY).alias("atraso"),
    classify.reporting_compliance(F.to_date("fecha_y_hora"), TODAY, F.col("bultos_dap"), F.col("bultos_urea")).alias("cumple")), "field_reports",
         f"""SELECT id_reporte, CASE WHEN a <= 1 THEN 0 ELSE a END AS atraso, a <= 1 OR (coalesce(bultos_dap, 0) = 0 AND coalesce(bultos_urea, 0) = 0) AS cumple
FROM (SELECT *, coalesce(DATE '{TODAY}' - CAST(fecha_y_hora AS DATE), 999) AS a FROM field_reports) f""", big="atraso")
register("c30_row_hash", lambda r: r.raw("orders").select(
    "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("p"), "o_custkey").withColumn(
    "hash", text.row_hash(["o_orderkey", "p", "o_custkey"])), "",
         """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS p, o_custkey,
  md5(o_orderkey || '|' || CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END || '|' || o_custkey) AS hash FROM orders""")
register("c31_case_normalise", lambda r: text.normalize_report_text(
    r.raw("events").selectExpr("event_id", "concat(' ceda-', user_id, ' ') AS id_ceda_agricultura", "concat(' ', upper(event_type)) AS quien"),
    "id_ceda_agricultura").withColumn("directorio", text.directory_text(F.when(F.col("quien") != "error", F.col("quien")))), "",
         """SELECT event_id, 'CEDA-' || user_id AS id_ceda_agricultura, event_type AS quien,
  CASE WHEN event_type = 'error' THEN 'N/A' ELSE upper(event_type) END AS directorio FROM events""")
register("c33_percent_of_target", lambda r: r.raw("customer").selectExpr(
    "c_custkey", "cast(c_acctbal AS decimal(18,2)) AS v", "CASE WHEN c_nationkey > 3 THEN cast(c_nationkey * 300 AS decimal(18,2)) WHEN c_nationkey > 1 THEN 0 END AS meta").select(
    "c_custkey", numbers.percent_of_target(F.col("v"), F.col("meta")).alias("pct"), numbers.pending(F.col("v"), F.col("meta")).alias("pendiente")), "",
         """SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN least(CAST(floor(CAST(v * 100 AS DOUBLE) / (c_nationkey * 300)) AS BIGINT), 100) ELSE 0 END AS pct,
  CASE WHEN c_nationkey > 3 THEN greatest(c_nationkey * 300 - v, 0) ELSE greatest(-v, 0) END AS pendiente
FROM (SELECT *, CAST(c_acctbal AS DECIMAL(18,2)) AS v FROM customer) c""", dbl="pendiente")
register("c35_export_projection", lambda r: r.registry().select(
    F.col("acuse_estatal").alias("ACUSE"), F.lit("2025").alias("EJERCICIO"), F.lit("APOYO EN ESPECIE").alias("COMPONENTE"),
    F.upper("estatus").alias("LISTADO"), F.col("fecha_de_publicacion").alias("FECHA")), "registry",
         """SELECT acuse_estatal AS "ACUSE", '2025' AS "EJERCICIO", 'APOYO EN ESPECIE' AS "COMPONENTE", upper(estatus) AS "LISTADO",
  fecha_de_publicacion AS "FECHA" FROM registry""")
register("c36_fill_zero_numeric", lambda r: _orders(
    r, "CASE o_orderstatus WHEN 'F' THEN cast(cast(o_totalprice AS decimal(18,2)) AS string) WHEN 'O' THEN 's/d' END AS v").select(
    "o_orderkey", numbers.fill_zero_numeric(F.col("v")).alias("v")), "",
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS v FROM orders", dbl="v")
