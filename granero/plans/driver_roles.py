"""The programme's tables, expressed over the TPC-H-like test tables.

Each function returns one programme table in its own column names; the derived tables in this package only ever see
those. The mapping is a projection wherever the grain is the same. Tons of one row are narrow decimals, as they are in
the programme's own tables: Spark sums up to eight digits in a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.functions.classify import assign_centre, assign_centre_move
from granero.operators.dedupe import first_per_key
from granero.sources.readers import read_table


class Roles:
    """Lazy access to the programme tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A driver table; its footer is read once however many roles use it."""
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.folder, name)
        return self._read[name]

    def _centre_count(self) -> Column:
        return self.raw("supplier").agg(F.count("*")).scalar()

    def centres(self) -> DataFrame:
        """red_distribucion: one row per distribution centre."""
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        joined = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
        return joined.selectExpr(
            "2025 AS anio",
            "cast(s_suppkey AS string) AS id_ceda_agricultura",
            "r_name AS coordinacion_estatal",
            "n_name AS estado",
            "concat('ZONA ', s_suppkey % 4) AS zona_operativa",
            "concat('MUNICIPIO ', s_suppkey % 10) AS municipio",
            "s_name AS nombre_cedas",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'SI' ELSE 'NO' END AS bodega_concentradora",
            "cast(floor(abs(s_acctbal) / 50) AS int) AS meta_derechohabientes",
            "cast(floor(abs(s_acctbal) / 25) AS int) AS meta_superficie_ha",
            "CASE WHEN s_acctbal >= 0 THEN cast(cast(s_acctbal AS decimal(18,2)) * 0.01 AS decimal(8,3)) END AS meta_dap_ton",
            "cast(cast(abs(s_acctbal) AS decimal(18,2)) * 0.02 AS decimal(8,3)) AS meta_urea_ton",
            "CASE WHEN s_acctbal >= 0 THEN cast(cast(s_acctbal AS decimal(18,2)) * 0.03 AS decimal(8,3)) END AS meta_total_ton",
            "cast(3 + s_nationkey % 3 AS decimal(8,3)) AS altura_estiba_m",
            "cast(cast(abs(s_acctbal) AS decimal(18,2)) * 0.05 AS decimal(8,3)) AS tonelaje_alm_total",
            "CASE WHEN s_acctbal >= 0 THEN cast(14 + s_nationkey AS decimal(8,3)) END AS latitud",
            "CASE WHEN s_suppkey % 3 <> 0 THEN cast(-90 - s_nationkey AS decimal(8,3)) END AS longitud",
            "cast(10 + s_suppkey % 7 AS int) AS capacidad_descarga",
            "CASE WHEN s_suppkey % 9 <> 0 THEN concat('Coordinador ', s_suppkey % 9) END AS coordinador_operativo",
            "concat('coz', s_suppkey % 9, '@example.org') AS coz_correo",
            "concat('55-', s_suppkey % 9) AS coz_telefono",
            "CASE WHEN s_suppkey % 6 <> 0 THEN concat('Responsable ', s_suppkey) END AS responsable_cedas",
            "concat('rc', s_suppkey, '@example.org') AS rc_correo",
            "concat('56-', s_suppkey) AS rc_telefono",
        )

    def registry(self) -> DataFrame:
        """derechohabientes_padrones_compilado: one row per receipt, from `orders`.

        Some receipts have no delivery (and their deliveries no registry row), and one status has no centre in some
        places, so orphans are met on both sides.
        """
        o = self.raw("orders").withColumn("n_cedas", self._centre_count())
        return o.selectExpr(
            "CASE WHEN o_orderkey % 97 = 0 THEN concat('P-', o_orderkey) ELSE cast(o_orderkey AS string) END AS acuse_estatal",
            """CASE WHEN o_orderpriority = '2-HIGH' AND o_custkey % n_cedas % 7 = 0 THEN 'SIN CEDA'
               ELSE cast(o_custkey % n_cedas AS string) END AS id_ceda_agricultura""",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'Nuevo Ingreso 2025'
               WHEN '2-HIGH' THEN 'NUEVO INGRESO complemento' WHEN '3-MEDIUM' THEN 'Acceso Directo 2024'
               WHEN '4-NOT SPECIFIED' THEN 'Acceso Directo 2025' END AS estatus""",
            "concat('AP', o_custkey) AS primer_apellido",
            "CASE o_orderstatus WHEN 'F' THEN concat('AM', o_custkey % 50) WHEN 'O' THEN '' END AS segundo_apellido",
            "concat('NOMBRE ', o_orderkey % 1000) AS nombre",
            "concat(lpad(cast(o_custkey AS string), 10, 'X'), CASE WHEN o_custkey % 2 = 0 THEN 'h' ELSE 'm' END, 'DF') AS curp_renapo",
            "cast(floor(o_totalprice / 50000) AS bigint) AS superficie",
            """CASE WHEN o_orderstatus <> 'O' OR o_orderpriority <> '4-NOT SPECIFIED'
               THEN cast(cast(o_totalprice AS decimal(18,2)) * 0.000005 AS decimal(7,3)) END AS dap_ton""",
            """CASE WHEN o_orderstatus <> 'P' THEN cast(cast(o_totalprice AS decimal(18,2)) * 0.000007 AS decimal(7,3)) END
               AS urea_ton""",
            "CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN cast(o_orderdate AS date) END AS fecha_de_publicacion",
            "concat('MUNICIPIO ', o_custkey % 10) AS municipio_predio_inegi",
        )

    def deliveries(self) -> DataFrame:
        """derechohabientes: one row per receipt, the earliest line of each order."""
        li = self.raw("lineitem").withColumn("acuse_estatal", F.col("l_orderkey").cast("string")).drop("l_orderkey")
        first = first_per_key(li, ["acuse_estatal"], ["l_shipdate", "l_partkey", "l_linenumber", "l_suppkey"])
        return first.selectExpr(
            "acuse_estatal",
            "cast(l_suppkey AS string) AS cdf_entrega",
            "concat(lpad(cast(l_partkey AS string), 10, 'X'), CASE WHEN l_partkey % 2 = 0 THEN 'h' ELSE 'm' END, 'DF') AS curp_renapo",
            "concat('NATION_', l_partkey % 25) AS estado_predio_capturada",
            "concat('MUNICIPIO ', l_partkey % 40) AS municipio_predio_capturada",
            "concat('DDR ', l_partkey % 12) AS nombre_ddr",
            "CASE l_returnflag WHEN 'A' THEN 'MAIZ' WHEN 'R' THEN 'FRIJOL' ELSE 'ARROZ' END AS cultivo",
            "CASE WHEN l_tax > 0 THEN cast(cast(l_quantity AS decimal(7,3)) * 0.013 AS decimal(7,3)) END AS ton_dap_entregada",
            "CASE WHEN l_discount > 0 THEN cast(cast(l_quantity AS decimal(7,3)) * 0.021 AS decimal(7,3)) END AS ton_urea_entregada",
            "CASE WHEN l_linenumber <> 7 OR l_returnflag <> 'N' THEN cast(l_shipdate AS date) END AS fecha_entrega",
            "cast(l_quantity AS int) AS dap_anio_actual",
            "cast(floor(l_extendedprice / 1000) AS int) AS urea_anio_actual",
            "cast(cast(l_discount AS decimal(6,2)) * 100 AS int) AS dap_remanente",
            "cast(cast(l_tax AS decimal(6,2)) * 100 AS int) AS urea_remanente",
            "l_linenumber AS superficie_apoyada",
        )

    def freight(self, with_origin: bool = False) -> DataFrame:
        """fletes: one row per line item. `with_origin` looks the state of origin up in `part`."""
        li = self.raw("lineitem")
        origin = "cast(NULL AS string)"
        if with_origin:
            li = li.join(self.raw("part").select("p_partkey", "p_brand"), li.l_partkey == F.col("p_partkey"), "left")
            origin = "p_brand"
        return li.selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_date(cast(l_shipdate AS date))) AS folio_del_flete",
            "CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN 'Cancelado' WHEN l_linestatus = 'F' THEN 'Entregado' ELSE 'AUTORIZADO' END AS estatus",
            "CASE l_returnflag WHEN 'A' THEN 'DAP' WHEN 'R' THEN 'URE' ELSE 'OTR' END AS abreviacion_producto",
            "cast(l_quantity AS decimal(8,3)) AS toneladas_iniciales",
            "cast(l_quantity * 40 AS int) AS bultos_iniciales",
            "CASE WHEN l_linestatus = 'F' THEN cast(l_quantity * 40 AS int) - l_linenumber END AS bultos_en_destino",
            f"{origin} AS estado_procedencia",
            """CASE WHEN l_linestatus = 'F' THEN cast(cast(l_quantity AS decimal(8,3))
               * (1 - (cast(l_discount AS decimal(4,2)) - 0.02) * 4) AS decimal(8,3)) END AS toneladas_en_el_destino""",
            "CASE WHEN l_discount < 0.1 THEN cast(l_shipdate AS date) END AS fecha_de_salida",
            "cast(l_suppkey AS string) AS cdf_destino_original",
            "CASE WHEN l_linenumber <= 5 THEN cast(l_suppkey AS string) ELSE '0' END AS cdf_destino_final",
            "CASE WHEN l_linestatus = 'F' THEN cast(date_add(cast(l_shipdate AS date), l_linenumber - 2) AS timestamp_ntz) END AS fecha_de_llegada",
            """CASE WHEN l_linestatus = 'F' AND l_linenumber <> 4 THEN cast(date_add(cast(l_shipdate AS date),
               cast(cast(l_tax AS decimal(6,2)) * 100 AS int) - 1) AS timestamp_ntz) END AS fecha_de_entrega""",
        ).withColumn("id_ceda_agricultura", _freight_centre())

    def _moves(self, lines: DataFrame, product: str) -> DataFrame:
        li = lines.withColumn("n_cedas", self._centre_count())
        return li.selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_date(cast(l_shipdate AS date))) AS folio_transferencia",
            "CASE WHEN l_linenumber <= 5 THEN cast(l_suppkey AS string) ELSE 'EXTERNO' END AS cdf_origen",
            "CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.04 THEN 'autorizada' ELSE ' Entregada' END AS estatus",
            f"CASE {product} WHEN 'F' THEN 'DAP' ELSE 'URE' END AS abreviacion_producto",
            "cast(l_quantity AS decimal(8,3)) AS toneladas_iniciales",
            "cast(cast(l_quantity AS decimal(8,3)) * (1 - cast(l_discount AS decimal(4,2))) AS decimal(8,3)) AS toneladas_en_el_destino",
            "cast(l_shipdate AS date) AS fecha_de_salida",
            "cast(date_add(cast(l_shipdate AS date), l_linenumber) AS date) AS fecha_de_llegada",
            "cast(l_suppkey AS string) AS cdf_destino_original",
            "cast(l_partkey % n_cedas AS string) AS cdf_destino_final",
        ).withColumn("id_ceda_agricultura", _move_centre())

    def transfers(self) -> DataFrame:
        """transferencias: the line items returned by the customer (flag R)."""
        return self._moves(self.raw("lineitem").filter("l_returnflag = 'R'"), "l_linestatus")

    def remnants(self) -> DataFrame:
        """remanentes: the accepted line items (flag A)."""
        return self._moves(self.raw("lineitem").filter("l_returnflag = 'A'"), "l_linestatus")

    def incidents(self) -> DataFrame:
        """incidentes: the untouched line items (flag N)."""
        return self.raw("lineitem").filter("l_returnflag = 'N'").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_date(cast(l_shipdate AS date))) AS ln_folio_incidencia",
            "cast(l_suppkey AS string) AS cdf_incidente",
            "CASE l_linestatus WHEN 'F' THEN 'DAP' ELSE 'URE' END AS clave_producto",
            "cast(cast(l_quantity AS decimal(8,3)) * cast(l_tax AS decimal(4,2)) AS decimal(8,3)) AS ton_incidencia",
            "cast(l_shipdate AS date) AS fecha_incidente",
        )

    def order_lines(self) -> DataFrame:
        """pedidos_desglosado: one row per order."""
        o = self.raw("orders").withColumn("n_cedas", self._centre_count())
        return o.selectExpr(
            "o_orderkey AS id_pedido",
            "cast(o_custkey % n_cedas AS string) AS folio_cdf",
            "cast(o_orderdate AS date) AS fecha",
            "cast(cast(o_totalprice AS decimal(18,2)) * 0.0001 AS decimal(8,3)) AS dap",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN cast(cast(o_totalprice AS decimal(18,2)) * 0.00005 AS decimal(8,3)) END AS urea",
            "o_orderpriority AS estatus_suministro",
            "CASE o_orderstatus WHEN 'F' THEN 'Autorizado' WHEN 'O' THEN 'autorizado' ELSE 'Pendiente' END AS estatus_pedido_detalle",
        )

    def order_summary(self) -> DataFrame:
        """pedidos_sigap: one row per ordering centre, from `customer`."""
        return self.raw("customer").selectExpr(
            "c_custkey AS id_cdf",
            "cast(c_custkey AS string) AS folio_cdf",
            "c_mktsegment AS entidad",
            "CASE WHEN c_acctbal >= 0 THEN cast(c_acctbal AS decimal(8,3)) END AS dap_solicitado",
            "CASE WHEN c_nationkey > 4 THEN cast(cast(c_acctbal AS decimal(18,2)) * 2 AS decimal(8,3)) END AS urea_solicitada",
            "CASE WHEN c_acctbal >= 5000 THEN cast(c_acctbal - 5000 AS decimal(8,3)) END AS dap_por_suministrar",
        )

    def field_reports(self) -> DataFrame:
        """inventarios_diarios_ceda_campo: one row per report sent from the field, from `events`."""
        return self.raw("events").selectExpr(
            "event_id AS id_reporte",
            # moved back to where the movements are
            "CASE WHEN event_type <> 'error' THEN ts - make_dt_interval(cast(9000 + user_id % 400 AS int)) END AS fecha_y_hora",
            "cast(user_id AS string) AS id_ceda_agricultura",
            "CASE WHEN event_type <> 'view' THEN cast(floor(value) AS int) END AS bultos_dap",
            "CASE WHEN event_type <> 'click' THEN cast(floor(value * 2) AS int) END AS bultos_urea",
            "concat(' ', event_type, ' ') AS quien_reporta",
            "props AS observaciones",
        )

    def targets(self) -> DataFrame:
        """metas: one row per state; one region has none and some targets are 0."""
        return self.raw("nation").filter("n_regionkey <> 0").selectExpr(
            "n_name AS estado",
            "cast(n_nationkey % 5 * 100 AS int) AS derechohabientes",
            "cast(n_nationkey % 4 * 1000 AS int) AS superficie_ha",
            "cast(n_nationkey * 1000 AS decimal(8,3)) AS dap_ton",
            "cast(n_nationkey * 2000 AS decimal(8,3)) AS urea_ton",
            "cast(n_nationkey * 3000 AS decimal(8,3)) AS total_ton",
        )

    def projection(self) -> DataFrame:
        """proyeccion_abasto: tons planned per state and day."""
        return self.raw("orders").selectExpr(
            "concat('NATION_', o_custkey % 25) AS estado",
            "date_add(cast(o_orderdate AS date), 30) AS fecha",
            "cast(cast(o_totalprice AS decimal(18,2)) * 0.0002 AS decimal(8,3)) AS toneladas_programadas",
        )

    def comments(self) -> DataFrame:
        """comentarios_ceda: free text per centre, from `events`."""
        return self.raw("events").selectExpr(
            "cast(user_id AS string) AS id_ceda_agricultura", "concat(event_type, ' ', props) AS comentario",
            "ts AS fecha", "event_id AS id")


def _freight_centre() -> Column:

    return assign_centre(F.col("estatus"), F.col("cdf_destino_original"), F.col("cdf_destino_final"))


def _move_centre() -> Column:

    return assign_centre_move(F.col("estatus"), F.col("cdf_destino_original"), F.col("cdf_destino_final"))
