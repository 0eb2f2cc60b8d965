"""Registry of queries and their SQL, and the programme tables written as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.plans.driver_roles import Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, so that both engines hand over the same type."""
    return df.select([
        F.col(f"`{f.name}`").cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def register(name: str, build: Callable[[Roles], DataFrame], roles: str = "", sql: str | None = None, dbl: str = "",
             big: str = "") -> None:
    """Add a query over the programme tables, and its SQL.

    `roles` names the tables the SQL uses; `dbl` and `big` list its exact decimal and whole-number columns.
    """
    QUERIES[name] = lambda spark, folder: plain(build(Roles(spark, folder)))
    if sql is not None:
        ORACLE[name] = role_sql(roles, typed(sql, dbl, big))


def typed(sql: str, dbl: str, big: str) -> str:
    casts = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in dbl.split()]
    casts += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in big.split()]
    if not casts:
        return sql
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) AS q"


def role_sql(roles: str, body: str) -> str:
    if not roles:
        return body
    ctes = ",\n".join(f"{r} AS ({ROLE_SQL[r]})" for r in roles.split())
    return f"WITH {ctes}\n{body}"


_N = "(SELECT count(*) FROM supplier)"
_FOLIO = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) - DATE '1970-01-01')"


def _moves(flag: str) -> str:
    return f"""
SELECT *, CASE WHEN lower(trim(estatus)) = 'entregada' THEN cdf_destino_final ELSE cdf_destino_original END
  AS id_ceda_agricultura
FROM (SELECT {_FOLIO} AS folio_transferencia,
  CASE WHEN l_linenumber <= 5 THEN CAST(l_suppkey AS VARCHAR) ELSE 'EXTERNO' END AS cdf_origen,
  CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.04 THEN 'autorizada' ELSE ' Entregada' END AS estatus,
  CASE WHEN l_linestatus = 'F' THEN 'DAP' ELSE 'URE' END AS abreviacion_producto,
  CAST(l_quantity AS DECIMAL(18,3)) AS toneladas_iniciales,
  CAST(CAST(l_quantity AS DECIMAL(18,3)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,3)) AS toneladas_en_el_destino,
  CAST(l_shipdate AS DATE) AS fecha_de_salida, CAST(l_shipdate AS DATE) + l_linenumber AS fecha_de_llegada,
  CAST(l_suppkey AS VARCHAR) AS cdf_destino_original, CAST(l_partkey % {_N} AS VARCHAR) AS cdf_destino_final
  FROM lineitem WHERE l_returnflag = '{flag}') m"""


def _freight(origin: bool) -> str:
    source = "lineitem LEFT JOIN part ON p_partkey = l_partkey" if origin else "lineitem"
    return f"""
SELECT *, CASE lower(estatus) WHEN 'entregado' THEN cdf_destino_final WHEN 'autorizado' THEN cdf_destino_original END
  AS id_ceda_agricultura
FROM (SELECT {_FOLIO} AS folio_del_flete,
  CASE WHEN l_linestatus = 'O' THEN 'AUTORIZADO' WHEN l_tax = 0 THEN 'Cancelado' ELSE 'Entregado' END AS estatus,
  CASE l_returnflag WHEN 'A' THEN 'DAP' WHEN 'R' THEN 'URE' ELSE 'OTR' END AS abreviacion_producto,
  CAST(l_quantity AS DECIMAL(18,3)) AS toneladas_iniciales, CAST(l_quantity * 40 AS INTEGER) AS bultos_iniciales,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity * 40 AS INTEGER) - l_linenumber END AS bultos_en_destino,
  {"p_brand" if origin else "CAST(NULL AS VARCHAR)"} AS estado_procedencia,
  CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity AS DECIMAL(18,3))
    * (1 - (CAST(l_discount AS DECIMAL(4,2)) - 0.02) * 4) AS DECIMAL(18,3)) END AS toneladas_en_el_destino,
  CASE WHEN l_discount < 0.1 THEN CAST(l_shipdate AS DATE) END AS fecha_de_salida,
  CAST(l_suppkey AS VARCHAR) AS cdf_destino_original,
  CASE WHEN l_linenumber <= 5 THEN CAST(l_suppkey AS VARCHAR) ELSE '0' END AS cdf_destino_final,
  CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) + (l_linenumber - 2) AS TIMESTAMP) END AS fecha_de_llegada,
  CASE WHEN l_linestatus = 'F' AND l_linenumber <> 4 THEN
    CAST(CAST(l_shipdate AS DATE) + (CAST(round(l_tax * 100) AS INTEGER) - 1) AS TIMESTAMP) END AS fecha_de_entrega
  FROM {source}) f"""


ROLE_SQL: dict[str, str] = {
    "centres": """
SELECT 2025 AS anio, CAST(s_suppkey AS VARCHAR) AS id_ceda_agricultura, r_name AS coordinacion_estatal, n_name AS estado,
  'ZONA ' || (s_suppkey % 4) AS zona_operativa, 'MUNICIPIO ' || (s_suppkey % 10) AS municipio, s_name AS nombre_cedas,
  CASE WHEN s_suppkey % 5 = 0 THEN 'SI' ELSE 'NO' END AS bodega_concentradora,
  CAST(floor(abs(s_acctbal) / 50) AS INTEGER) AS meta_derechohabientes,
  CAST(floor(abs(s_acctbal) / 25) AS INTEGER) AS meta_superficie_ha,
  CASE WHEN s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,3)) END AS meta_dap_ton,
  CAST(CAST(abs(s_acctbal) AS DECIMAL(18,2)) * 0.02 AS DECIMAL(18,3)) AS meta_urea_ton,
  CASE WHEN s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 0.03 AS DECIMAL(18,3)) END AS meta_total_ton,
  CAST(3 + s_nationkey % 3 AS DECIMAL(18,3)) AS altura_estiba_m,
  CAST(CAST(abs(s_acctbal) AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,3)) AS tonelaje_alm_total,
  CASE WHEN s_acctbal >= 0 THEN CAST(14 + s_nationkey AS DECIMAL(18,3)) END AS latitud,
  CASE WHEN s_suppkey % 3 <> 0 THEN CAST(-90 - s_nationkey AS DECIMAL(18,3)) END AS longitud,
  CAST(10 + s_suppkey % 7 AS INTEGER) AS capacidad_descarga,
  CASE WHEN s_suppkey % 9 <> 0 THEN 'Coordinador ' || (s_suppkey % 9) END AS coordinador_operativo,
  'coz' || (s_suppkey % 9) || '@example.org' AS coz_correo, '55-' || (s_suppkey % 9) AS coz_telefono,
  CASE WHEN s_suppkey % 6 <> 0 THEN 'Responsable ' || s_suppkey END AS responsable_cedas,
  'rc' || s_suppkey || '@example.org' AS rc_correo, '56-' || s_suppkey AS rc_telefono
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "registry": f"""
SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'P-' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS acuse_estatal,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_custkey % {_N} % 7 = 0 THEN 'SIN CEDA' ELSE CAST(o_custkey % {_N} AS VARCHAR) END
    AS id_ceda_agricultura,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Nuevo Ingreso 2025' WHEN '2-HIGH' THEN 'NUEVO INGRESO complemento'
    WHEN '3-MEDIUM' THEN 'Acceso Directo 2024' WHEN '4-NOT SPECIFIED' THEN 'Acceso Directo 2025' END AS estatus,
  'AP' || o_custkey AS primer_apellido,
  CASE o_orderstatus WHEN 'F' THEN 'AM' || (o_custkey % 50) WHEN 'O' THEN '' END AS segundo_apellido,
  'NOMBRE ' || (o_orderkey % 1000) AS nombre,
  lpad(CAST(o_custkey AS VARCHAR), 10, 'X') || CASE WHEN o_custkey % 2 = 0 THEN 'h' ELSE 'm' END || 'DF' AS curp_renapo,
  CAST(floor(o_totalprice / 50000) AS BIGINT) AS superficie,
  CASE WHEN o_orderstatus <> 'O' OR o_orderpriority <> '4-NOT SPECIFIED'
    THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.000005 AS DECIMAL(18,3)) END AS dap_ton,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.000007 AS DECIMAL(18,3)) END AS urea_ton,
  CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS fecha_de_publicacion,
  'MUNICIPIO ' || (o_custkey % 10) AS municipio_predio_inegi
FROM orders""",
    "deliveries": """
SELECT CAST(l_orderkey AS VARCHAR) AS acuse_estatal, CAST(l_suppkey AS VARCHAR) AS cdf_entrega,
  lpad(CAST(l_partkey AS VARCHAR), 10, 'X') || CASE WHEN l_partkey % 2 = 0 THEN 'h' ELSE 'm' END || 'DF' AS curp_renapo,
  'NATION_' || (l_partkey % 25) AS estado_predio_capturada, 'MUNICIPIO ' || (l_partkey % 40) AS municipio_predio_capturada,
  'DDR ' || (l_partkey % 12) AS nombre_ddr,
  CASE l_returnflag WHEN 'A' THEN 'MAIZ' WHEN 'R' THEN 'FRIJOL' ELSE 'ARROZ' END AS cultivo,
  CASE WHEN l_tax > 0 THEN CAST(CAST(l_quantity AS DECIMAL(18,3)) * 0.013 AS DECIMAL(18,3)) END AS ton_dap_entregada,
  CASE WHEN l_discount > 0 THEN CAST(CAST(l_quantity AS DECIMAL(18,3)) * 0.021 AS DECIMAL(18,3)) END AS ton_urea_entregada,
  CASE WHEN l_linenumber <> 7 OR l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS fecha_entrega,
  CAST(l_quantity AS INTEGER) AS dap_anio_actual, CAST(floor(l_extendedprice / 1000) AS INTEGER) AS urea_anio_actual,
  CAST(round(l_discount * 100) AS INTEGER) AS dap_remanente, CAST(round(l_tax * 100) AS INTEGER) AS urea_remanente,
  l_linenumber AS superficie_apoyada
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_linenumber, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) l WHERE rn = 1""",
    "freight": _freight(False),
    "freight_origin": _freight(True),
    "transfers": _moves("R"),
    "remnants": _moves("A"),
    "incidents": f"""
SELECT {_FOLIO} AS ln_folio_incidencia, CAST(l_suppkey AS VARCHAR) AS cdf_incidente,
  CASE WHEN l_linestatus = 'F' THEN 'DAP' ELSE 'URE' END AS clave_producto,
  CAST(CAST(l_quantity AS DECIMAL(18,3)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,3)) AS ton_incidencia,
  CAST(l_shipdate AS DATE) AS fecha_incidente FROM lineitem WHERE l_returnflag = 'N'""",
    "order_lines": f"""
SELECT o_orderkey AS id_pedido, CAST(o_custkey % {_N} AS VARCHAR) AS folio_cdf, CAST(o_orderdate AS DATE) AS fecha,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,3)) AS dap,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.00005 AS DECIMAL(18,3)) END AS urea,
  o_orderpriority AS estatus_suministro,
  CASE o_orderstatus WHEN 'F' THEN 'Autorizado' WHEN 'O' THEN 'autorizado' ELSE 'Pendiente' END AS estatus_pedido_detalle
FROM orders""",
    "order_summary": """
SELECT c_custkey AS id_cdf, CAST(c_custkey AS VARCHAR) AS folio_cdf, c_mktsegment AS entidad,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,3)) END AS dap_solicitado,
  CASE WHEN c_nationkey > 4 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 2 AS DECIMAL(18,3)) END AS urea_solicitada,
  CASE WHEN c_acctbal >= 5000 THEN CAST(c_acctbal - 5000 AS DECIMAL(18,3)) END AS dap_por_suministrar
FROM customer""",
    "field_reports": """
SELECT event_id AS id_reporte,
  CASE WHEN event_type <> 'error' THEN ts - to_days(CAST(9000 + user_id % 400 AS INTEGER)) END AS fecha_y_hora,
  CAST(user_id AS VARCHAR) AS id_ceda_agricultura,
  CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS INTEGER) END AS bultos_dap,
  CASE WHEN event_type <> 'click' THEN CAST(floor(value * 2) AS INTEGER) END AS bultos_urea,
  ' ' || event_type || ' ' AS quien_reporta, props AS observaciones FROM events""",
    "targets": """
SELECT n_name AS estado, n_nationkey % 5 * 100 AS derechohabientes, n_nationkey % 4 * 1000 AS superficie_ha,
  CAST(n_nationkey * 1000 AS DECIMAL(18,3)) AS dap_ton, CAST(n_nationkey * 2000 AS DECIMAL(18,3)) AS urea_ton,
  CAST(n_nationkey * 3000 AS DECIMAL(18,3)) AS total_ton FROM nation WHERE n_regionkey <> 0""",
    "projection": """
SELECT 'NATION_' || (o_custkey % 25) AS estado, CAST(o_orderdate AS DATE) + 30 AS fecha,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0002 AS DECIMAL(18,3)) AS toneladas_programadas FROM orders""",
    "comments": """
SELECT CAST(user_id AS VARCHAR) AS id_ceda_agricultura, event_type || ' ' || props AS comentario, ts AS fecha,
  event_id AS id FROM events""",
    # one flow per row: centre, day and the four amounts
    "flows": """
SELECT id_ceda_agricultura, CAST(fecha_de_entrega AS DATE) AS fecha,
  CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino END AS de,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino END AS ue, NULL AS ds, NULL AS us
  FROM freight WHERE lower(estatus) = 'entregado'
UNION ALL SELECT id_ceda_agricultura, fecha_de_llegada, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino END,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino END, NULL, NULL FROM transfers
  WHERE lower(trim(estatus)) = 'entregada'
UNION ALL SELECT cdf_origen, fecha_de_salida, NULL, NULL, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_iniciales END,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_iniciales END FROM transfers
UNION ALL SELECT id_ceda_agricultura, fecha_de_llegada, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_en_el_destino END,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_en_el_destino END, NULL, NULL FROM remnants
  WHERE lower(trim(estatus)) = 'entregada'
UNION ALL SELECT cdf_origen, fecha_de_salida, NULL, NULL, CASE WHEN abreviacion_producto = 'DAP' THEN toneladas_iniciales END,
  CASE WHEN abreviacion_producto = 'URE' THEN toneladas_iniciales END FROM remnants
UNION ALL SELECT cdf_incidente, fecha_incidente, NULL, NULL, CASE WHEN clave_producto = 'DAP' THEN ton_incidencia END,
  CASE WHEN clave_producto = 'URE' THEN ton_incidencia END FROM incidents
UNION ALL SELECT cdf_entrega, fecha_entrega, NULL, NULL, ton_dap_entregada, ton_urea_entregada FROM deliveries""",
}
