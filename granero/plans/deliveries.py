"""Deliveries summed per centre, state, day, week, sex and municipality, and the reports sent outside."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import iso_year
from granero.functions.numbers import bags_to_tons
from granero.functions.text import full_name, sex_from_curp
from granero.operators.daily import on_calendar
from granero.operators.filters import (clamp_page, filter_date_range, filter_eq, filter_iexact, filter_in_list, page,
                                       select_valid_columns)
from granero.plans.freight import centre_context
from granero.sources.calendar import days_between, with_calendar_columns

SUMS = ("derechohabientes_apoyados", "dap_ton_entregada", "urea_ton_entregada", "total_ton_entregada")


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def _sums(grouped) -> DataFrame:
    """Count and tons; the total adds the two sums, so a missing part does not hide the other."""
    out = grouped.agg(F.count("*").alias("derechohabientes_apoyados"),
                      F.coalesce(F.sum("ton_dap_entregada"), F.lit(0)).alias("dap_ton_entregada"),
                      F.coalesce(F.sum("ton_urea_entregada"), F.lit(0)).alias("urea_ton_entregada"))
    return out.withColumn("total_ton_entregada", F.col("dap_ton_entregada") + F.col("urea_ton_entregada"))


def _resum(grouped) -> DataFrame:
    return grouped.agg(*[F.sum(c).alias(c) for c in SUMS])


def deliveries_by_centre(deliveries: DataFrame) -> DataFrame:
    """Totals, dates, days with deliveries and the tons of the last day, per centre.

    Summed per centre and day first, so the last day and the number of days need no second pass over the rows.
    """
    per_day = deliveries.groupBy(F.col("cdf_entrega").alias("id_ceda_agricultura"), "fecha_entrega").agg(
        F.count("*").alias("n"), F.sum("ton_dap_entregada").alias("dap"), F.sum("ton_urea_entregada").alias("urea"),
        F.sum("superficie_apoyada").alias("ha"),
        *[F.sum(bags_to_tons(F.col(c))).alias(c)
          for c in ("dap_remanente", "urea_remanente", "dap_anio_actual", "urea_anio_actual")])
    days = F.count("fecha_entrega")
    out = per_day.groupBy("id_ceda_agricultura").agg(
        F.sum("n").alias("total_derechohabientes"), F.sum("dap").alias("dap_entregado_ton"),
        F.sum("urea").alias("urea_entregado_ton"), F.sum("ha").alias("superficie_apoyada"),
        F.sum("dap_remanente").alias("dap_rem_entregado_ton"), F.sum("urea_remanente").alias("urea_rem_entregado_ton"),
        F.sum("dap_anio_actual").alias("dap_entregado_anio_actual_ton"),
        F.sum("urea_anio_actual").alias("urea_entregado_anio_actual_ton"),
        F.max("fecha_entrega").alias("ultima_entrega_realizada"),
        F.min("fecha_entrega").alias("primer_entrega_realizada"),
        days.alias("no_de_dias_realizando_entregas"),
        F.max_by(F.struct(_zero("dap").alias("dap"), _zero("urea").alias("urea")), "fecha_entrega").alias("ultima"))
    rate = F.round(F.try_divide(F.col("total_derechohabientes").cast("decimal(18,0)"),
                                F.col("no_de_dias_realizando_entregas").cast("decimal(18,0)")), 2)
    return out.select(
        *[c for c in out.columns if c != "ultima"], rate.alias("derechohabientes_atendidos_por_dia"),
        F.col("ultima.dap").alias("dap_ultima_entrega"), F.col("ultima.urea").alias("urea_ultima_entrega"),
        (F.col("ultima.dap") + F.col("ultima.urea")).alias("total_ton_ultima_entrega"))


def progress_by_state(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Deliveries per state, with the surface."""
    per_centre = deliveries.groupBy(F.col("cdf_entrega").alias("id_ceda_agricultura")).agg(
        F.count("*").alias("derechohabientes_apoyados"),
        F.coalesce(F.sum("ton_dap_entregada"), F.lit(0)).alias("dap_ton_entregada"),
        F.coalesce(F.sum("ton_urea_entregada"), F.lit(0)).alias("urea_ton_entregada"),
        F.sum("superficie_apoyada").alias("superficie_beneficiada"))
    out = per_centre.join(centre_context(centres), "id_ceda_agricultura").groupBy("estado").agg(
        *[F.sum(c).alias(c) for c in per_centre.columns[1:]])
    return out.withColumn("total_ton_entregada", F.col("dap_ton_entregada") + F.col("urea_ton_entregada"))


def deliveries_by_day(deliveries: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every day of the calendar with its deliveries."""
    facts = _sums(deliveries.filter(F.col("fecha_entrega").between(F.lit(start), F.lit(end)))
                  .groupBy(F.col("fecha_entrega").alias("fecha")))
    return on_calendar(days_between(deliveries.sparkSession, start, end), facts, SUMS)


def deliveries_by_state_centre_day(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Deliveries per state, centre and day."""
    facts = _sums(deliveries.filter("fecha_entrega IS NOT NULL").groupBy(
        F.col("cdf_entrega").alias("id_ceda_agricultura"), F.col("fecha_entrega").alias("fecha")))
    return facts.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura").select(
        "estado", "id_ceda_agricultura", "nombre_cedas", "fecha", *SUMS)


def deliveries_by_day_state(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Deliveries per day and state."""
    return _resum(deliveries_by_state_centre_day(deliveries, centres).groupBy("fecha", "estado"))


def deliveries_by_week(deliveries: DataFrame) -> DataFrame:
    """Deliveries per ISO week, with its Monday, Sunday and the month of the Monday."""
    daily = _sums(deliveries.filter("fecha_entrega IS NOT NULL").groupBy("fecha_entrega"))
    d = F.col("fecha_entrega")
    weeks = _resum(daily.groupBy(iso_year(d).alias("anio"), F.weekofyear(d).alias("semana"),
                                 F.date_sub(d, F.weekday(d)).alias("fecha_inicio_semana")))
    month = with_calendar_columns(weeks.select("fecha_inicio_semana", "anio", "semana", *SUMS).withColumnsRenamed(
        {"anio": "_anio", "semana": "_semana"}), "fecha_inicio_semana")
    return month.select(F.col("_anio").alias("anio"), F.col("_semana").cast("bigint").alias("semana"),
                        "fecha_inicio_semana", F.date_add("fecha_inicio_semana", 6).alias("fecha_fin_semana"),
                        "nombre_mes", *SUMS)


def deliveries_by_state_and_sex(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Men, women and tons per state."""
    sex = sex_from_curp(F.col("curp_renapo"))
    per_centre = deliveries.groupBy(F.col("cdf_entrega").alias("id_ceda_agricultura")).agg(
        F.count_if(sex == "H").alias("hombres"), F.count_if(sex == "M").alias("mujeres"),
        F.count("*").alias("avance_total"),
        F.coalesce(F.sum("ton_dap_entregada"), F.lit(0)).alias("toneladas_dap"),
        F.coalesce(F.sum("ton_urea_entregada"), F.lit(0)).alias("toneladas_urea"))
    out = per_centre.join(centre_context(centres), "id_ceda_agricultura").groupBy("estado").agg(
        *[F.sum(c).alias(c) for c in per_centre.columns[1:]])
    return out.withColumn("toneladas_totales", F.col("toneladas_dap") + F.col("toneladas_urea"))


def deliveries_with_centre(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Deliveries with unit, state and id of their centre."""
    context = centres.select(F.col("coordinacion_estatal").alias("unidad_operativa"), "estado", "id_ceda_agricultura")
    return deliveries.join(context, F.col("cdf_entrega") == F.col("id_ceda_agricultura"), "left")


def beneficiary_report(deliveries: DataFrame, registry: DataFrame) -> DataFrame:
    """Columns of the external beneficiary report."""
    names = registry.select("acuse_estatal", "nombre", "primer_apellido", "segundo_apellido",
                            F.col("curp_renapo").alias("curp_registro"))
    return deliveries.join(names, "acuse_estatal").select(
        "acuse_estatal", F.col("curp_renapo").alias("curp_productor"), F.col("curp_registro").alias("curp_historica"),
        full_name(F.col("nombre"), F.col("primer_apellido"), F.col("segundo_apellido")).alias("nombre_completo"),
        F.col("estado_predio_capturada").alias("estado"), F.col("municipio_predio_capturada").alias("municipio"),
        F.col("ton_dap_entregada").alias("toneladas_dap_entregadas"),
        F.col("ton_urea_entregada").alias("toneladas_urea_entregadas"), F.col("fecha_entrega").alias("fecha_de_entrega"),
        "nombre_ddr", F.col("cdf_entrega").alias("clave_ceda_entrega"), F.lit("ENTREGADO").alias("situacion"))


def freight_report(freight: DataFrame, centres: DataFrame) -> DataFrame:
    """Columns of the external freight report."""
    return freight.join(centre_context(centres), "id_ceda_agricultura", "left").select(
        "folio_del_flete", "estatus", F.col("abreviacion_producto").alias("producto"),
        F.col("toneladas_iniciales").alias("toneladas"), "bultos_iniciales", "estado_procedencia", "fecha_de_salida",
        "bultos_en_destino", "toneladas_en_el_destino", F.col("estado").alias("estado_destino"), "fecha_de_llegada",
        F.col("id_ceda_agricultura").alias("clave_ceda_destino"))


def beneficiaries_by_municipality(deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """Deliveries per state and municipality."""
    counted = deliveries.groupBy(F.col("cdf_entrega").alias("id_ceda_agricultura"),
                                 F.col("municipio_predio_capturada").alias("municipio")).agg(F.count("*").alias("n"))
    return counted.join(centre_context(centres), "id_ceda_agricultura").groupBy("estado", "municipio").agg(
        F.sum("n").alias("derechohabientes_apoyados"))


def deliveries_query(rows: DataFrame, request: dict) -> DataFrame:
    """The search over deliveries with their centre (V20): equalities, day range, keys without regard to case, receipts.

    `request` holds the filter names plus `fecha_inicio`, `fecha_fin` and `lista_acuses`; empty values are no filter.
    """
    out = filter_eq(rows, {k: request.get(k) for k in ("unidad_operativa", "estado", "id_ceda_agricultura")})
    out = filter_date_range(out, "fecha_entrega", request.get("fecha_inicio"), request.get("fecha_fin"))
    for key in ("acuse_estatal", "curp_solicitud", "curp_renapo"):
        if key in out.columns:
            out = filter_iexact(out, key, request.get(key))
    return filter_in_list(out, "acuse_estatal", request.get("lista_acuses"))


def deliveries_query_page(rows: DataFrame, request: dict, number: int, columns: Sequence[str] = (), size: int = 200) -> DataFrame:
    """One page of the search by receipt; a page number outside the result goes to the nearest page."""
    found = deliveries_query(rows, request)
    number = clamp_page(number, size, found.count())
    return select_valid_columns(page(found, number, size, "acuse_estatal"), columns)
