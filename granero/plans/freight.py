"""Freight: enrichment, per-centre summaries, transit and anomalies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import date_bound
from granero.operators.filters import filter_date_range, filter_eq, filter_in_list, select_valid_columns

# Product codes as stored (three characters) and freight states.
DAP, UREA = "DAP", "URE"
DELIVERED, IN_TRANSIT = "entregado", "autorizado"

QUERY_FILTERS = ("unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "estatus",
                 "abreviacion_producto", "cdf_destino_original", "cdf_destino_final")
DEFAULT_COLUMNS = ("folio_del_flete", "unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "estatus",
                   "abreviacion_producto", "fecha_de_salida", "fecha_de_entrega")


def has_status(value: str) -> Column:
    return F.lower("estatus") == value


def product_sum(code: str, measure: str | Column, column: str = "abreviacion_producto") -> Column:
    """Sum of a measure for one product, 0 when there is none."""
    value = F.col(measure) if isinstance(measure, str) else measure
    return F.coalesce(F.sum(F.when(F.col(column) == code, value)), F.lit(0))


def centre_context(centres: DataFrame, *extra: str) -> DataFrame:
    return centres.select("id_ceda_agricultura", F.col("coordinacion_estatal").alias("unidad_operativa"), "estado",
                          "zona_operativa", *extra)


def enriched_freight(freight: DataFrame, centres: DataFrame) -> DataFrame:
    """All freight columns with unit, state, zone and name of the centre."""
    return freight.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura", "left")


def freight_query(enriched: DataFrame, request: dict) -> DataFrame:
    """Rows behind a freight search: equalities, date ranges, a list of folios.

    `request` holds the filter names plus `fecha_salida_ini/fin`, `fecha_entrega_ini/fin`, `folios_multiline`.
    """
    out = filter_eq(enriched, {k: request.get(k) for k in QUERY_FILTERS})
    out = filter_date_range(out, "fecha_de_salida", date_bound(request.get("fecha_salida_ini")),
                            date_bound(request.get("fecha_salida_fin")))
    out = filter_date_range(out, "fecha_de_entrega", date_bound(request.get("fecha_entrega_ini")),
                            date_bound(request.get("fecha_entrega_fin")))
    return filter_in_list(out, "folio_del_flete", request.get("folios_multiline"), commas=True)


def freight_query_rows(enriched: DataFrame, request: dict, columns: Sequence[str] = ()) -> DataFrame:
    """The requested columns of the search result."""
    return select_valid_columns(freight_query(enriched, request), columns, DEFAULT_COLUMNS)


def freight_summary(rows: DataFrame, dap: str = DAP, urea: str = UREA) -> DataFrame:
    """A4: one row of totals over a search result, by product. The product codes are parameters."""
    is_dap, is_urea = F.col("abreviacion_producto") == dap, F.col("abreviacion_producto") == urea
    return rows.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum("toneladas_iniciales"), F.lit(0)).alias("sum_toneladas_iniciales"),
        F.coalesce(F.sum("toneladas_en_el_destino"), F.lit(0)).alias("sum_toneladas_en_el_destino"),
        F.count_if(is_dap).alias("dap_count"), F.count_if(is_urea).alias("urea_count"),
        product_sum(dap, "toneladas_iniciales").alias("dap_toneladas_iniciales"),
        product_sum(dap, "toneladas_en_el_destino").alias("dap_toneladas_en_el_destino"),
        product_sum(urea, "toneladas_iniciales").alias("urea_toneladas_iniciales"),
        product_sum(urea, "toneladas_en_el_destino").alias("urea_toneladas_en_el_destino"))


def freight_by_centre(freight: DataFrame) -> DataFrame:
    """Counts, tons and dates per centre and product, delivered and in transit, in one aggregate."""
    got, moving = has_status(DELIVERED), has_status(IN_TRANSIT)

    def count(code: str, cond: Column) -> Column:
        return F.count_if((F.col("abreviacion_producto") == code) & cond)

    return freight.filter(F.col("id_ceda_agricultura").isNotNull()).groupBy("id_ceda_agricultura").agg(
        count(DAP, got).alias("dap_recibido_fletes"), count(UREA, got).alias("urea_recibido_fletes"),
        count(DAP, moving).alias("dap_transito_fletes"), count(UREA, moving).alias("urea_transito_fletes"),
        product_sum(DAP, F.when(got, F.col("toneladas_en_el_destino"))).alias("dap_fletes_ton"),
        product_sum(UREA, F.when(got, F.col("toneladas_en_el_destino"))).alias("urea_fletes_ton"),
        product_sum(DAP, F.when(moving, F.col("toneladas_iniciales"))).alias("dap_transito_ton"),
        product_sum(UREA, F.when(moving, F.col("toneladas_iniciales"))).alias("urea_transito_ton"),
        F.max(F.when(got, F.to_date("fecha_de_entrega"))).alias("ultimo_flete_recibido"),
        F.max("fecha_de_salida").alias("ultimo_flete_enviado"),
        F.min(F.when(got, F.to_date("fecha_de_entrega"))).alias("primer_flete_recibido"))


def shipments_by_day(freight: DataFrame) -> DataFrame:
    """Tons sent per departure day."""
    return _sent(freight.filter("fecha_de_salida IS NOT NULL").groupBy(F.col("fecha_de_salida").alias("fecha")))


def shipments_by_day_state(freight: DataFrame, centres: DataFrame) -> DataFrame:
    """Tons sent per departure day and state; summed per centre before the lookup."""
    slim = freight.filter("fecha_de_salida IS NOT NULL").groupBy(
        F.col("fecha_de_salida").alias("fecha"), "id_ceda_agricultura", "abreviacion_producto").agg(
        F.sum("toneladas_iniciales").alias("toneladas_iniciales"))
    return _sent(slim.join(centre_context(centres), "id_ceda_agricultura").groupBy("fecha", "estado"))


def _sent(grouped) -> DataFrame:
    out = grouped.agg(product_sum(DAP, "toneladas_iniciales").alias("dap_ton_enviadas"),
                      product_sum(UREA, "toneladas_iniciales").alias("urea_ton_enviadas"))
    return out.withColumn("total_ton_enviadas", F.col("dap_ton_enviadas") + F.col("urea_ton_enviadas"))


def freight_by_delivery_day(freight: DataFrame) -> DataFrame:
    """Delivered tons per centre and delivery time, one column per product."""
    got = freight.filter(has_status(DELIVERED) & F.col("fecha_de_entrega").isNotNull())
    out = got.groupBy("id_ceda_agricultura", "fecha_de_entrega").agg(
        product_sum(DAP, "toneladas_en_el_destino").alias("dap"),
        product_sum(UREA, "toneladas_en_el_destino").alias("ure"))
    return out.withColumn("total_general", F.col("dap") + F.col("ure"))


def transit_detail(freight: DataFrame, centres: DataFrame, today: dt.date) -> DataFrame:
    """Freight under way, with the days since departure and a mark from 30 days on."""
    days = F.datediff(F.lit(today), F.col("fecha_de_salida"))
    rows = freight.filter(has_status(IN_TRANSIT)).select(
        "folio_del_flete", "id_ceda_agricultura", "abreviacion_producto", "toneladas_iniciales", "fecha_de_salida",
        days.alias("dias_en_transito"), F.coalesce(days >= 30, F.lit(False)).alias("demorado"))
    return rows.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura", "left")


def _transit_sums(grouped, weight: str | None = None) -> DataFrame:
    count = (lambda code: F.count_if(F.col("abreviacion_producto") == code)) if weight is None else (
        lambda code: product_sum(code, weight))
    out = grouped.agg(
        count(DAP).alias("fletes_transito_dap"), count(UREA).alias("fletes_transito_urea"),
        product_sum(DAP, "toneladas_iniciales").alias("ton_transito_dap"),
        product_sum(UREA, "toneladas_iniciales").alias("ton_transito_urea"),
        F.max("dias_en_transito").alias("max_dias_en_transito"))
    return out.withColumns({
        "total_fletes_transito": F.col("fletes_transito_dap") + F.col("fletes_transito_urea"),
        "total_ton_transito": F.col("ton_transito_dap") + F.col("ton_transito_urea")})


def _transit_by_product(freight: DataFrame, today: dt.date) -> DataFrame:
    return freight.filter(has_status(IN_TRANSIT)).groupBy("id_ceda_agricultura", "abreviacion_producto").agg(
        F.count("*").alias("fletes"), F.sum("toneladas_iniciales").alias("toneladas_iniciales"),
        F.max(F.datediff(F.lit(today), F.col("fecha_de_salida"))).alias("dias_en_transito"))


def transit_by_centre(freight: DataFrame, centres: DataFrame, today: dt.date) -> DataFrame:
    """Freight under way per centre."""
    sums = _transit_sums(_transit_by_product(freight, today).groupBy("id_ceda_agricultura"), "fletes")
    return sums.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura", "left")


def transit_by_state(freight: DataFrame, centres: DataFrame, today: dt.date) -> DataFrame:
    """Freight under way per unit and state."""
    rows = _transit_by_product(freight, today).join(centre_context(centres), "id_ceda_agricultura", "left")
    return _transit_sums(rows.groupBy("unidad_operativa", "estado"), "fletes")


def transit_footer(rows: DataFrame) -> DataFrame:
    """Footer of the transit page: totals, and the longest time (0 without rows)."""
    sums = [c for c in rows.columns if c.startswith(("fletes_", "ton_", "total_"))]
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
                    F.coalesce(F.max("max_dias_en_transito"), F.lit(0)).alias("max_dias_en_transito"))


def freight_by_origin(freight: DataFrame, centres: DataFrame) -> DataFrame:
    """Tons and counts per centre, state of origin and product."""
    sums = freight.groupBy("id_ceda_agricultura", "estado_procedencia").agg(
        F.count_if(F.col("abreviacion_producto") == DAP).alias("fletes_dap"),
        F.count_if(F.col("abreviacion_producto") == UREA).alias("fletes_urea"),
        product_sum(DAP, "toneladas_iniciales").alias("dap_ton"),
        product_sum(UREA, "toneladas_iniciales").alias("urea_ton"),
        F.sum("toneladas_iniciales").alias("toneladas_iniciales"),
        F.coalesce(F.sum("toneladas_en_el_destino"), F.lit(0)).alias("toneladas_en_el_destino"))
    return sums.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura", "left")


def atypical_tons(freight: DataFrame) -> DataFrame:
    """Received tons far from those sent: over 10 missing, or more than 1 too many."""
    diff = F.col("toneladas_iniciales") - F.col("toneladas_en_el_destino")
    return freight.withColumn("diferencia_ton", diff).filter((diff > 10) | (diff < -1)).select(
        "folio_del_flete", "id_ceda_agricultura", "abreviacion_producto", "toneladas_iniciales",
        "toneladas_en_el_destino", "diferencia_ton")


def incoherent_dates(freight: DataFrame) -> DataFrame:
    """Freight that left after it arrived or was delivered."""
    left = F.col("fecha_de_salida")
    late = (left > F.to_date("fecha_de_llegada")) | (left > F.to_date("fecha_de_entrega"))
    return freight.filter(late).select("folio_del_flete", "id_ceda_agricultura", "estatus", "fecha_de_salida",
                                       "fecha_de_llegada", "fecha_de_entrega")
