"""Orders, supply by day and state, the centre network and its comments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.numbers import default_if_null
from granero.operators.daily import on_calendar, sum_of
from granero.operators.filters import filter_date_range, filter_eq, only_authorised
from granero.plans.freight import DAP, DELIVERED, IN_TRANSIT, UREA, centre_context, has_status, product_sum
from granero.sources.calendar import days_between


def orders_by_centre(lines: DataFrame) -> DataFrame:
    """Authorised orders per centre and the date of the last one."""
    return only_authorised(lines).groupBy(F.col("folio_cdf").alias("id_ceda_agricultura")).agg(
        F.coalesce(F.sum("dap"), F.lit(0)).alias("dap_pedido_acumulado"),
        F.coalesce(F.sum("urea"), F.lit(0)).alias("urea_pedido_acumulado"),
        F.max("fecha").alias("ultimo_pedido_solicitado"))


def _ordered_by_date(lines: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    inside = only_authorised(lines).filter(F.col("fecha").between(F.lit(start), F.lit(end)))
    return inside.groupBy("fecha").agg(F.coalesce(F.sum("dap"), F.lit(0)).alias("pedido_dap_ton"),
                                       F.coalesce(F.sum("urea"), F.lit(0)).alias("pedido_urea_ton"))


def orders_by_day(lines: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every calendar day with the tons ordered."""
    facts = _ordered_by_date(lines, start, end)
    days = on_calendar(days_between(lines.sparkSession, start, end), facts, ("pedido_dap_ton", "pedido_urea_ton"))
    return days.withColumn("pedido_total_ton", F.col("pedido_dap_ton") + F.col("pedido_urea_ton"))


def remnants_by_date(remnants: DataFrame, *keys: str) -> DataFrame:
    received = remnants.filter((F.lower(F.trim("estatus")) == "entregada") & F.col("fecha_de_llegada").isNotNull())
    return received.groupBy(F.col("fecha_de_llegada").alias("fecha"), *keys).agg(
        product_sum(DAP, "toneladas_en_el_destino").alias("dap_remanentes_ton"),
        product_sum(UREA, "toneladas_en_el_destino").alias("urea_remanentes_ton"))


def orders_and_remnants_by_day(lines: DataFrame, remnants: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Ordered tons and carry-over received, every day that has either."""
    rem = remnants_by_date(remnants).filter(F.col("fecha").between(F.lit(start), F.lit(end))).select(
        "fecha", F.col("dap_remanentes_ton").alias("remanente_dap_ton"),
        F.col("urea_remanentes_ton").alias("remanente_urea_ton"))
    both = _ordered_by_date(lines, start, end).join(rem, "fecha", "full")
    parts = ("pedido_dap_ton", "pedido_urea_ton", "remanente_dap_ton", "remanente_urea_ton")
    return both.select("fecha", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in parts],
                       sum_of(*[F.col(c) for c in parts]).alias("pedido_total_ton"))


def order_detail(lines: DataFrame, centres: DataFrame) -> DataFrame:
    """Order lines with their centre."""
    context = centre_context(centres, "nombre_cedas")
    return lines.join(context, F.col("folio_cdf") == F.col("id_ceda_agricultura"), "left").drop("folio_cdf")


def orders_query(detail: DataFrame, request: dict) -> DataFrame:
    """The search over order lines (V33): unit and state, and the day range `fecha_inicio`, `fecha_fin`."""
    found = filter_eq(detail, {k: request.get(k) for k in ("unidad_operativa", "estado")})
    return filter_date_range(found, "fecha", request.get("fecha_inicio"), request.get("fecha_fin"))


def comments_query(comments: DataFrame, request: dict) -> DataFrame:
    """The search over comments with their centre (V34): equalities on the centre's columns."""
    return filter_eq(comments, {k: request.get(k) for k in ("unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura")})


def order_detail_footer(detail: DataFrame) -> DataFrame:
    """Rows and tons of an order search."""
    return detail.agg(F.count("*").alias("total"), F.coalesce(F.sum("dap"), F.lit(0)).alias("dap"),
                      F.coalesce(F.sum("urea"), F.lit(0)).alias("urea"))


def order_summary_by_centre(centres: DataFrame, summary: DataFrame) -> DataFrame:
    """Every centre with its order totals; a missing figure shows as 3."""
    sums = summary.select(F.col("folio_cdf").alias("id_ceda_agricultura"), "dap_solicitado", "urea_solicitada",
                          "dap_por_suministrar")
    joined = centres.select("id_ceda_agricultura", "estado").join(sums, "id_ceda_agricultura", "left")
    return joined.select("id_ceda_agricultura", "estado",
                         *[default_if_null(F.col(c)).alias(c) for c in sums.columns if c != "id_ceda_agricultura"])


def network_summary(centres: DataFrame) -> DataFrame:
    """Targets and storage per centre."""
    return centres.groupBy("id_ceda_agricultura", "estado", "zona_operativa", "nombre_cedas", "bodega_concentradora").agg(
        F.sum("meta_derechohabientes").alias("suma_productores"), F.sum("meta_superficie_ha").alias("suma_ha"),
        F.sum("meta_dap_ton").alias("suma_dap_ton"), F.sum("meta_urea_ton").alias("suma_urea_ton"),
        F.sum("tonelaje_alm_total").alias("suma_tonelaje_almacenamiento"),
        F.sum("altura_estiba_m").alias("suma_altura_estiba_m"),
        F.sum("capacidad_descarga").alias("suma_capacidad_descarga"))


# ---- supply --------------------------------------------------------------------------------------

SUPPLY = ("dap_fletes_ton", "urea_fletes_ton", "dap_remanentes_ton", "urea_remanentes_ton")
TRANSIT = ("dap_transito_ton", "urea_transito_ton")


def _freight_days(freight: DataFrame, *keys: str, with_transit: bool = False) -> DataFrame:
    """Tons received by delivery day and, with transit, tons under way by departure day, from one scan."""
    got, moving = has_status(DELIVERED), has_status(IN_TRANSIT)
    day = F.when(got, F.to_date("fecha_de_entrega"))
    sums = [product_sum(DAP, F.when(got, F.col("toneladas_en_el_destino"))).alias("dap_fletes_ton"),
            product_sum(UREA, F.when(got, F.col("toneladas_en_el_destino"))).alias("urea_fletes_ton")]
    if with_transit:
        day = day.when(moving, F.col("fecha_de_salida"))
        sums += [product_sum(DAP, F.when(moving, F.col("toneladas_iniciales"))).alias("dap_transito_ton"),
                 product_sum(UREA, F.when(moving, F.col("toneladas_iniciales"))).alias("urea_transito_ton")]
    return freight.withColumn("fecha", day).filter("fecha IS NOT NULL").groupBy("fecha", *keys).agg(*sums)


def _stacked(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Sum frames with different measures over the same keys: one shuffle instead of a chain of joins."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return union.groupBy(*keys).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in union.columns if c not in keys])


def supply_by_day(freight: DataFrame, remnants: DataFrame, start: dt.date, end: dt.date,
                  with_transit: bool = True) -> DataFrame:
    """Received freight and carry-over (and freight under way) for every calendar day."""
    names = SUPPLY + TRANSIT if with_transit else SUPPLY
    parts = [_freight_days(freight, with_transit=with_transit), remnants_by_date(remnants)]
    facts = _stacked(parts, ["fecha"]).filter(F.col("fecha").between(F.lit(start), F.lit(end)))
    days = on_calendar(days_between(freight.sparkSession, start, end), facts, names)
    return days.withColumn("total_recibido_ton", sum_of(*[F.col(c) for c in names]))


def supply_by_day_and_state(freight: DataFrame, remnants: DataFrame, centres: DataFrame) -> DataFrame:
    """Received freight and carry-over per day and state; summed per centre first."""
    per_centre = _stacked([_freight_days(freight, "id_ceda_agricultura"),
                           remnants_by_date(remnants, "id_ceda_agricultura")], ["fecha", "id_ceda_agricultura"])
    out = per_centre.join(centre_context(centres), "id_ceda_agricultura").groupBy("fecha", "estado").agg(
        *[F.sum(c).alias(c) for c in SUPPLY])
    return out.withColumn("total_recibido_ton", sum_of(*[F.col(c) for c in SUPPLY]))


def supply_by_state(freight: DataFrame, remnants: DataFrame, centres: DataFrame) -> DataFrame:
    """Freight and carry-over received per state."""
    out = supply_by_day_and_state(freight, remnants, centres).groupBy("estado").agg(
        *[F.sum(c).alias(c) for c in SUPPLY])
    return out.withColumns({
        "total_fletes_ton": F.col("dap_fletes_ton") + F.col("urea_fletes_ton"),
        "total_remanente_ton": F.col("dap_remanentes_ton") + F.col("urea_remanentes_ton"),
        "total_abasto_ton": sum_of(*[F.col(c) for c in SUPPLY])})


def projection_by_day(projection: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Planned supply for every calendar day."""
    facts = projection.filter(F.col("fecha").between(F.lit(start), F.lit(end))).groupBy("fecha").agg(
        F.sum("toneladas_programadas").alias("abasto_proy_ton"))
    return on_calendar(days_between(projection.sparkSession, start, end), facts, ("abasto_proy_ton",))


def comments_by_centre(centres: DataFrame, comments: DataFrame) -> DataFrame:
    """Every centre with its comments, one row each, NULL for centres without any.

    Kept as rows: sort by centre and descending time to read them. The inner join and the centres without comments
    are built apart, so a centre with very many comments can be split between tasks.
    """
    context = centre_context(centres, "nombre_cedas")
    present = comments.join(context, "id_ceda_agricultura")
    absent = context.join(comments.select("id_ceda_agricultura").distinct(), "id_ceda_agricultura", "left_anti")
    return present.unionByName(absent, allowMissingColumns=True).select(
        "unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "nombre_cedas", "fecha", "id",
        "comentario")
