"""Loads from text over whole tables: typed rows, rejects, corrections and removals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import register
from granero import schemas
from granero.functions.dates import parse_date_iso_first
from granero.plans import loads, registry_load
from granero.session import scratch_path
from granero.sources import sinks

# ---- registry ------------------------------------------------------------------------------------


def _registry_text(r):
    """Two extracts: the second repeats the receipts of finished orders with another status."""
    first = r.raw("orders").selectExpr(
        "cast(o_orderkey AS string) AS `Acuse Estatal`", "concat('  ', repeat(o_orderpriority, 3)) AS `Estatus`", "cast(o_custkey AS string) AS `ID CEDA`",
        "replace(cast(cast(o_totalprice AS decimal(18,2)) * 0.00003 AS string), '.', ',') AS `DAP (ton)`",
        "CASE o_orderstatus WHEN 'P' THEN 'pendiente' ELSE '1.5' END AS `Urea (ton)`", "CASE WHEN o_orderkey % 11 = 0 THEN 'sin fecha' ELSE date_format(o_orderdate, 'd/M/yyyy H:mm') END AS `Fecha de Publicación`",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'doce' ELSE cast(o_custkey AS string) END AS `Superficie`", "1 AS archivo")
    again = r.raw("orders").filter("o_orderstatus = 'F'").selectExpr("cast(o_orderkey AS string) AS `Acuse Estatal`", "'segundo' AS `Estatus`", "2 AS archivo")
    return first.unionByName(again, allowMissingColumns=True)


_REG = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.00003 AS DECIMAL(18,3))"
register("load_registry", lambda r: registry_load.typed_registry(_registry_text(r), "archivo").selectExpr(
    "acuse_estatal", "estatus", "id_ceda_agricultura", "`dap_(ton)` AS dap", "`urea_(ton)` AS urea", "fecha_de_publicacion", "superficie", "direccion"), "", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS acuse_estatal, CASE o_orderstatus WHEN 'F' THEN 'segundo' ELSE substr(repeat(o_orderpriority, 3), 1, 29) END AS estatus,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS id_ceda_agricultura, CASE WHEN o_orderstatus <> 'F' AND {_REG} < 10 THEN {_REG} END AS dap,
  CASE o_orderstatus WHEN 'O' THEN 1.5 END AS urea, CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS fecha_de_publicacion,
  CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 13 > 0 THEN o_custkey END AS superficie, CAST(NULL AS VARCHAR) AS direccion FROM orders""", dbl="dap urea")
_REJECTED = "SELECT '{}' AS tipo, '{}' AS columna, CAST(o_orderkey AS VARCHAR) AS clave, {} AS valor, '{}' AS motivo FROM orders WHERE {}"
register("load_registry_rejects", lambda r: registry_load.registry_rejects(_registry_text(r), "archivo"), "", " UNION ALL ".join((
    _REJECTED.format("numeric", "dap_(ton)", "replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.00003 AS VARCHAR), '.', ',')", "overflow_4_3", f"{_REG} >= 10"),
    _REJECTED.format("numeric", "urea_(ton)", "'pendiente'", "no_convertible", "o_orderstatus = 'P'"),
    _REJECTED.format("numeric", "superficie", "'doce'", "no_convertible", "o_orderkey % 13 = 0"),
    _REJECTED.format("date", "fecha_de_publicacion", "'sin fecha'", "fecha_no_valida", "o_orderkey % 11 = 0"),
    _REJECTED.format("text", "estatus", "'  ' || repeat(o_orderpriority, 3)", "truncado_varchar_29", "length(o_orderpriority) > 9"))))



def _merged(r):
    """Two loads into one stored table: all receipts, then new statuses for some and receipts that were not there."""
    path = scratch_path(r.spark, "padron")
    text = _registry_text(r)
    columns = ("acuse_estatal", "estatus", "superficie")
    sinks.merge_into(registry_load.typed_registry(text.filter("archivo = 1"), "archivo").select(*columns), path, "acuse_estatal", 16)
    again = r.raw("orders").filter("o_orderkey % 5 = 0").selectExpr(
        "concat(CASE WHEN o_orderkey % 2 = 0 THEN 'N-' ELSE '' END, o_orderkey) AS `Acuse Estatal`", "'corregido' AS `Estatus`", "'7' AS `Superficie`", "2 AS archivo")
    sinks.merge_into(registry_load.typed_registry(again, "archivo").select(*columns), path, "acuse_estatal", 16)
    return r.spark.read.parquet(path).select(*columns)


register("load_registry_merge", _merged, "", """
SELECT CAST(o_orderkey AS VARCHAR) AS acuse_estatal, CASE WHEN o_orderkey % 10 = 5 THEN 'corregido' ELSE substr(repeat(o_orderpriority, 3), 1, 29) END AS estatus,
  CASE WHEN o_orderkey % 10 = 5 THEN 7 WHEN o_orderkey % 13 > 0 THEN o_custkey END AS superficie FROM orders
UNION ALL SELECT 'N-' || o_orderkey, 'corregido', 7 FROM orders WHERE o_orderkey % 10 = 0""")

# ---- freight and moves ---------------------------------------------------------------------------

_DAY = "date_format(l_shipdate, '{}')"
_FOLIO = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"


def _freight_text(r):
    return r.raw("lineitem").selectExpr(
        f"{_FOLIO} AS `Folio del flete`", "CASE l_linestatus WHEN 'F' THEN 'Entregado' ELSE 'Autorizado' END AS `Estatus`",
        "format_number(l_extendedprice, 2) AS `Toneladas iniciales`", "CASE l_returnflag WHEN 'N' THEN 'N/A' ELSE cast(cast(l_quantity AS int) AS string) END AS `Bultos iniciales`",
        f"CASE WHEN l_tax = 0 THEN '0000-00-00 00:00:00' WHEN l_tax < 0.04 THEN {_DAY.format('dd/MM/yy H:mm')} ELSE {_DAY.format('yyyy-MM-dd HH:mm:ss')} END AS `Fecha de entrega`",
        f"{_DAY.format('dd/MM/yyyy')} AS `Fecha de salida`", "cast(l_suppkey AS string) AS `CDF destino original`", "cast(l_partkey AS string) AS `CDF destino final`")


def _load_freight(r):
    fixed = r.raw("orders").selectExpr("concat('C-', o_orderkey) AS `Folio del flete`", "' otro' AS `Estatus`")
    gone = r.raw("lineitem").filter("l_discount = 0.1").selectExpr(f"{_FOLIO} AS folio_del_flete")
    return loads.load_freight(_freight_text(r), fixed, gone).select(
        "folio_del_flete", "estatus", "toneladas_iniciales", "bultos_iniciales", "fecha_de_entrega", "fecha_de_salida", "id_ceda_agricultura")


register("load_freight", _load_freight, "", """
WITH l AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS folio FROM lineitem)
SELECT folio AS folio_del_flete, CASE l_linestatus WHEN 'F' THEN 'Entregado' ELSE 'Autorizado' END AS estatus,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(10,3)) AS toneladas_iniciales, CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INTEGER) END AS bultos_iniciales,
  CASE WHEN l_tax > 0 THEN l_shipdate END AS fecha_de_entrega, CAST(l_shipdate AS DATE) AS fecha_de_salida,
  CAST(CASE l_linestatus WHEN 'F' THEN l_partkey ELSE l_suppkey END AS VARCHAR) AS id_ceda_agricultura
FROM l WHERE folio NOT IN (SELECT folio FROM l WHERE l_discount = 0.1)
UNION ALL SELECT 'C-' || o_orderkey, 'otro', NULL, NULL, NULL, NULL, NULL FROM orders""", dbl="toneladas_iniciales")


def _load_moves(r):
    base = r.raw("orders").selectExpr(
        "cast(o_orderkey AS string) AS `Folio transferencia`", "CASE o_orderstatus WHEN 'F' THEN ' Entregada ' WHEN 'O' THEN 'NULL' ELSE 'autorizada' END AS `Estatus`",
        "date_format(o_orderdate, 'd-M-yy') AS `Fecha de salida`", "'0000-00-00' AS `Fecha de llegada`", "cast(o_custkey AS string) AS `CDF destino original`", "'final' AS `CDF destino final`",
        "format_number(o_totalprice, 2) AS `Toneladas iniciales`")
    fixed = r.raw("orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
        "cast(o_orderkey * 2 AS string) AS `Folio transferencia`", "date_format(o_orderdate, 'yyyy/MM/dd') AS `Fecha de salida`", "'corregido' AS `CDF destino original`")
    return loads.load_moves(base, fixed).select("folio_transferencia", "estatus", "fecha_de_salida", "fecha_de_llegada", "toneladas_iniciales", "id_ceda_agricultura")


register("load_moves", _load_moves, "", """
WITH c AS (SELECT o_orderkey * 2 AS k, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT CAST(o_orderkey AS VARCHAR) AS folio_transferencia, CASE o_orderstatus WHEN 'F' THEN ' Entregada ' WHEN 'P' THEN 'autorizada' END AS estatus,
  CAST(o_orderdate AS DATE) AS fecha_de_salida, CAST(NULL AS DATE) AS fecha_de_llegada, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(10,3)) AS toneladas_iniciales,
  CASE o_orderstatus WHEN 'F' THEN 'final' ELSE CAST(o_custkey AS VARCHAR) END AS id_ceda_agricultura
FROM orders WHERE o_orderkey NOT IN (SELECT k FROM c)
UNION ALL SELECT CAST(k AS VARCHAR), NULL, d, NULL, NULL, 'corregido' FROM c""", dbl="toneladas_iniciales")


def _load_order_lines(r):
    raw = r.raw("orders").selectExpr("o_orderkey AS orden", "cast(o_custkey AS string) AS `Folio CDF`", "date_format(o_orderdate, 'yyyy-MM-dd') AS `Fecha`",
                                     "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS `DAP`", "CASE o_orderstatus WHEN 'F' THEN 'Autorizado' ELSE 'Pendiente' END AS `Estatus pedido detalle`")
    gone = r.raw("customer").filter("c_acctbal < 0").selectExpr("cast(c_custkey AS string) AS id_ceda_agricultura")
    return loads.load_order_lines(raw, "orden", gone).select(F.col("id_pedido").cast("bigint").alias("id_pedido"), "folio_cdf", "fecha", "dap")


register("load_order_lines", _load_order_lines, "", """
SELECT id_pedido, CAST(o_custkey AS VARCHAR) AS folio_cdf, CAST(o_orderdate AS DATE) AS fecha, CAST(o_totalprice AS DECIMAL(18,2)) AS dap
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS id_pedido FROM orders) o
WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""", dbl="dap")


def _freight_with_losses(r):
    return r.raw("lineitem").selectExpr(
        "concat(lpad(l_orderkey, 14, '0'), lpad(l_linenumber, 14, '0'), l_partkey) AS `Folio del flete`",
        "CASE l_returnflag WHEN 'A' THEN '12345678.5' WHEN 'R' THEN 'mucho' ELSE '1,234.5' END AS `Toneladas iniciales`",
        "CASE WHEN l_linenumber = 1 THEN '2025-13-45' WHEN l_linenumber = 2 THEN '0000-00-00' ELSE date_format(l_shipdate, 'dd/MM/yyyy') END AS `Fecha de salida`",
        "CASE l_linestatus WHEN 'F' THEN 'Entregado' ELSE ' Autorizado por la central ' END AS `Estatus`", "CASE WHEN l_linenumber = 3 THEN 'doce' ELSE '5' END AS `Bultos iniciales`")


_LONG_FOLIO = "lpad(CAST(l_orderkey AS VARCHAR), 14, '0') || lpad(CAST(l_linenumber AS VARCHAR), 14, '0') || l_partkey"
register("load_freight_whole_text", lambda r: loads.load_freight(_freight_with_losses(r)).select(
    "folio_del_flete", "estatus", "toneladas_iniciales", "bultos_iniciales", "fecha_de_salida"), "", f"""
SELECT {_LONG_FOLIO} AS folio_del_flete, CASE l_linestatus WHEN 'F' THEN 'Entregado' ELSE 'Autorizado por la central' END AS estatus,
  CASE WHEN l_returnflag = 'N' THEN 1234.5 END AS toneladas_iniciales, CASE WHEN l_linenumber <> 3 THEN 5 END AS bultos_iniciales,
  CASE WHEN l_linenumber > 2 THEN CAST(l_shipdate AS DATE) END AS fecha_de_salida FROM lineitem""", dbl="toneladas_iniciales")
_LOST = f"SELECT '{{}}' AS tipo, '{{}}' AS columna, {_LONG_FOLIO} AS clave, {{}} AS valor, '{{}}' AS motivo FROM lineitem WHERE {{}}"
register("load_freight_rejects", lambda r: loads.load_rejects(_freight_with_losses(r), schemas.FREIGHT, schemas.KEYS["freight"]), "", " UNION ALL ".join((
    _LOST.format("string", "folio_del_flete", _LONG_FOLIO, "excede_varchar_28", "true"),
    _LOST.format("string", "estatus", "' Autorizado por la central '", "excede_varchar_10", "l_linestatus <> 'F'"),
    _LOST.format("decimal", "toneladas_iniciales", "'12345678.5'", "overflow_10_3", "l_returnflag = 'A'"),
    _LOST.format("decimal", "toneladas_iniciales", "'mucho'", "no_convertible", "l_returnflag = 'R'"),
    _LOST.format("integer", "bultos_iniciales", "'doce'", "no_entero", "l_linenumber = 3"),
    _LOST.format("date", "fecha_de_salida", "'2025-13-45'", "fecha_no_valida", "l_linenumber = 1"))))


def _delivery_text(r):
    return r.raw("orders").selectExpr(
        "concat('A', o_orderkey) AS `Acuse estatal`", "repeat(o_orderpriority, 8) AS `Cultivo`", "date_format(o_orderdate, 'yyyy-MM-dd') AS `Fecha entrega`",
        "CASE o_orderstatus WHEN 'F' THEN '0.125' WHEN 'O' THEN 'x' END AS `Ton DAP entregada`", "CASE o_orderstatus WHEN 'P' THEN 'tres' ELSE '3' END AS `DAP anio actual`")


register("load_deliveries", lambda r: loads.load_deliveries(_delivery_text(r)).select(
    "acuse_estatal", "cultivo", "fecha_entrega", "ton_dap_entregada", "ton_urea_entregada", "dap_anio_actual", "superficie_apoyada"), "", """
SELECT 'A' || o_orderkey AS acuse_estatal, repeat(o_orderpriority, 8) AS cultivo, CAST(o_orderdate AS DATE) AS fecha_entrega,
  CASE o_orderstatus WHEN 'F' THEN 0.125 ELSE 0 END AS ton_dap_entregada, 0 AS ton_urea_entregada,
  CASE o_orderstatus WHEN 'P' THEN 0 ELSE 3 END AS dap_anio_actual, 0 AS superficie_apoyada FROM orders""", dbl="ton_dap_entregada ton_urea_entregada")
_MISSED = "SELECT '{}' AS tipo, '{}' AS columna, 'A' || o_orderkey AS clave, {} AS valor, '{}' AS motivo FROM orders WHERE {}"
register("load_deliveries_rejects", lambda r: loads.load_rejects(
    _delivery_text(r), schemas.DELIVERIES, schemas.KEYS["deliveries"], dates=parse_date_iso_first), "", " UNION ALL ".join((
        _MISSED.format("string", "cultivo", "repeat(o_orderpriority, 8)", "excede_varchar_50", "length(o_orderpriority) > 6"),
        _MISSED.format("decimal", "ton_dap_entregada", "'x'", "no_convertible", "o_orderstatus = 'O'"),
        _MISSED.format("integer", "dap_anio_actual", "'tres'", "no_entero", "o_orderstatus = 'P'"))))
