"""Stock per centre and day, built from all movements, and its comparison with field reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.functions.classify import days_late, reporting_compliance, stock_gap_class
from granero.functions.numbers import TONS, bags_to_tons
from granero.operators.daily import counted, day_spans, expand_days, measured
from granero.operators.dedupe import first_per_key
from granero.plans.freight import DAP, DELIVERED, UREA, centre_context, has_status, product_sum

FLOWS = ("dap_ton_total_entrada", "urea_ton_total_entrada", "dap_ton_total_salida", "urea_ton_total_salida")


def _received() -> Column:
    return F.lower(F.trim("estatus")) == "entregada"


def _flow(df: DataFrame, centre: str, date: Column, dap: Column, urea: Column, inward: bool) -> DataFrame:
    none = F.lit(None)
    columns = (dap, urea, none, none) if inward else (none, none, dap, urea)
    return df.select(F.col(centre).alias("id_ceda_agricultura"), date.alias("fecha"),
                     *[c.alias(n) for c, n in zip(columns, FLOWS)])


def _by_product(tons: str, product: str = "abreviacion_producto") -> tuple[Column, Column]:
    return F.when(F.col(product) == DAP, F.col(tons)), F.when(F.col(product) == UREA, F.col(tons))


def move_flows(moves: DataFrame) -> DataFrame:
    """Transfers or carry-over: in at the destination on arrival when received, out at the origin on departure.

    Both sides of a move come out of one scan.
    """
    none = F.lit(None).cast(moves.schema["toneladas_iniciales"].dataType)
    arrived, left = _by_product("toneladas_en_el_destino"), _by_product("toneladas_iniciales")

    def side(counts: Column, centre: str, date: str, amounts: Sequence[Column]) -> Column:
        return F.struct(counts.alias("_cuenta"), F.col(centre).alias("id_ceda_agricultura"), F.col(date).alias("fecha"),
                        *[c.alias(n) for c, n in zip(amounts, FLOWS)])

    # both sides are always made and filtered as rows: dropping one inside the array would be interpreted for each move
    sides = F.array(
        side(F.coalesce(_received(), F.lit(False)), "id_ceda_agricultura", "fecha_de_llegada", [*arrived, none, none]),
        side(F.lit(True), "cdf_origen", "fecha_de_salida", [none, none, *left]))
    return moves.select(F.explode(sides).alias("f")).select("f.*").filter("_cuenta").drop("_cuenta")


def freight_flows(freight: DataFrame) -> DataFrame:
    """Delivered freight comes in at its centre."""
    return _flow(freight.filter(has_status(DELIVERED)), "id_ceda_agricultura", F.to_date("fecha_de_entrega"),
                 *_by_product("toneladas_en_el_destino"), inward=True)


def stock_flows(freight: DataFrame, transfers: DataFrame, remnants: DataFrame, incidents: DataFrame,
                deliveries: DataFrame) -> DataFrame:
    """All movements in one shape. In: freight, transfers, carry-over. Out: deliveries, transfers, losses."""
    return reduce(DataFrame.unionByName, [
        freight_flows(freight),
        move_flows(transfers),
        move_flows(remnants),
        _flow(incidents, "cdf_incidente", F.col("fecha_incidente"), *_by_product("ton_incidencia", "clave_producto"),
              inward=False),
        _flow(deliveries, "cdf_entrega", F.col("fecha_entrega"), F.col("ton_dap_entregada"),
              F.col("ton_urea_entregada"), inward=False),
    ])


def daily_flows(flows: DataFrame) -> DataFrame:
    """Sums per centre and movement day; rows without centre or day do not count."""
    return flows.filter("id_ceda_agricultura IS NOT NULL AND fecha IS NOT NULL").groupBy(
        "id_ceda_agricultura", "fecha").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(TONS).alias(c) for c in FLOWS])


def daily_stock(flows: DataFrame, centres: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per centre and day with the day's movements and the stock reached.

    Movements are summed per centre and day before they are shuffled; days without movement carry the stock on.
    """
    names = first_per_key(centre_context(centres, "nombre_cedas"), ["id_ceda_agricultura"])
    daily = daily_flows(flows).withColumns({
        "dap": (F.col("dap_ton_total_entrada") - F.col("dap_ton_total_salida")).cast(TONS),
        "urea": (F.col("urea_ton_total_entrada") - F.col("urea_ton_total_salida")).cast(TONS)})
    spans = day_spans(daily, names, ["id_ceda_agricultura"], FLOWS, start, end, totals=("dap", "urea"))
    stock = spans.select(*names.columns, "fecha", "hasta", *FLOWS, F.col("dap_acum").alias("dap_ton_inventario_acumulado"),
                         F.col("urea_acum").alias("urea_ton_inventario_acumulado"))
    return expand_days(stock, FLOWS)


def negative_stock(stock: DataFrame) -> DataFrame:
    """Days on which either product is below zero."""
    return stock.filter("dap_ton_inventario_acumulado < 0 OR urea_ton_inventario_acumulado < 0")


def current_stock(flows: DataFrame, centres: DataFrame, until: dt.date | None = None) -> DataFrame:
    """Stock per centre now, as one aggregate over the movements; centres without any show 0."""
    moved = flows if until is None else flows.filter(F.col("fecha") <= F.lit(until))
    sums = moved.filter("fecha IS NOT NULL").groupBy("id_ceda_agricultura").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FLOWS])
    rows = centre_context(centres, "nombre_cedas").join(sums, "id_ceda_agricultura", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in FLOWS}
    return rows.withColumns(zero).withColumns({
        "dap_ton_inventario_acumulado": F.col("dap_ton_total_entrada") - F.col("dap_ton_total_salida"),
        "urea_ton_inventario_acumulado": F.col("urea_ton_total_entrada") - F.col("urea_ton_total_salida")})


def carry_over_flows(remnants: DataFrame) -> DataFrame:
    """The movements of carried-over stock alone."""
    return move_flows(remnants)


def stock_by_state(current: DataFrame) -> DataFrame:
    """Stock per unit and state, with the total and the number of centres above and below zero."""
    return current.groupBy("unidad_operativa", "estado").agg(
        F.sum("dap_ton_inventario_acumulado").alias("dap_ton_inventario_acumulado"), F.sum("urea_ton_inventario_acumulado").alias("urea_ton_inventario_acumulado"),
        F.sum(F.col("dap_ton_inventario_acumulado") + F.col("urea_ton_inventario_acumulado")).alias("total_inventario"),
        F.count_if((F.col("dap_ton_inventario_acumulado") > 0) | (F.col("urea_ton_inventario_acumulado") > 0)).alias("cedas_positivas"),
        F.count_if((F.col("dap_ton_inventario_acumulado") < 0) | (F.col("urea_ton_inventario_acumulado") < 0)).alias("cedas_negativas"))


def centres_with_stock(current: DataFrame, negative: bool = False) -> DataFrame:
    """Centres holding stock of a product, or owing it."""
    sign = "<" if negative else ">"
    return current.filter(f"dap_ton_inventario_acumulado {sign} 0 OR urea_ton_inventario_acumulado {sign} 0")


def stock_footer(current: DataFrame) -> DataFrame:
    """Totals of the remaining-stock page."""
    return current.agg(F.count("*").alias("total_cedas"),
                       *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("dap_ton_inventario_acumulado", "urea_ton_inventario_acumulado")],
                       F.coalesce(F.sum(F.col("dap_ton_inventario_acumulado") + F.col("urea_ton_inventario_acumulado")), F.lit(0)).alias("total_ton"))


# ---- totals per centre ---------------------------------------------------------------------------

def incident_totals(incidents: DataFrame) -> DataFrame:
    """Losses per centre and product."""
    return incidents.groupBy(F.col("cdf_incidente").alias("id_ceda_agricultura")).agg(
        product_sum(DAP, "ton_incidencia", "clave_producto").alias("dap_incidencias_ton"),
        product_sum(UREA, "ton_incidencia", "clave_producto").alias("urea_incidencias_ton"))


def remnant_totals(remnants: DataFrame) -> DataFrame:
    """Carry-over received per centre and product."""
    return remnants.filter(_received()).groupBy("id_ceda_agricultura").agg(
        product_sum(DAP, "toneladas_en_el_destino").alias("dap_remanente_ton"),
        product_sum(UREA, "toneladas_en_el_destino").alias("urea_remanente_ton"))


def transfer_totals(transfers: DataFrame) -> DataFrame:
    """Transfers in by destination and out by origin, in one aggregate."""
    return move_flows(transfers).groupBy("id_ceda_agricultura").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in zip(FLOWS, (
            "dap_transferencia_entrada", "urea_transferencia_entrada", "dap_transferencia_salida",
            "urea_transferencia_salida"))])


# ---- field reports -------------------------------------------------------------------------------

def last_report_per_day(reports: DataFrame) -> DataFrame:
    """The last report of each centre and day, in tons. The maximum is combined before the shuffle."""
    last = reports.filter("fecha_y_hora IS NOT NULL").groupBy(
        "id_ceda_agricultura", F.to_date("fecha_y_hora").alias("fecha")).agg(
        F.max(F.struct("fecha_y_hora", "id_reporte", "bultos_dap", "bultos_urea", "quien_reporta")).alias("r"))
    return last.select("id_ceda_agricultura", "fecha", bags_to_tons(F.col("r.bultos_dap")).alias("dap_campo"),
                       bags_to_tons(F.col("r.bultos_urea")).alias("urea_campo"),
                       F.col("r.quien_reporta").alias("quien_reporta"))


def field_vs_system(flows: DataFrame, reports: DataFrame, centres: DataFrame) -> DataFrame:
    """Reported stock against the stock the movements give for that day.

    Reports join the daily movements as rows of their own, so a running sum per centre answers "stock as of the
    report" without a range join; a centre has at most one row of each kind per day.
    """
    net = {"dap": F.col("dap_ton_total_entrada") - F.col("dap_ton_total_salida"), "urea": F.col("urea_ton_total_entrada") - F.col("urea_ton_total_salida")}
    daily = daily_flows(flows).select("id_ceda_agricultura", "fecha", *[counted(v.cast(TONS), T.DecimalType(18, 3)).alias(c) for c, v in net.items()])
    both = daily.unionByName(last_report_per_day(reports).withColumn("_reporte", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("id_ceda_agricultura").orderBy("fecha", "_reporte").rowsBetween(Window.unboundedPreceding, 0)  # the day's movements first
    seen = both.withColumns({f"{c}_sigap": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in net}).filter("_reporte").withColumns({
        f"{c}_sigap": measured(F.col(f"{c}_sigap"), T.DecimalType(18, 3)).cast("decimal(29,3)") for c in net})
    zero = F.lit(0)
    return seen.join(centre_context(centres, "nombre_cedas"), "id_ceda_agricultura").select(
        "unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "nombre_cedas", "fecha", "quien_reporta",
        "dap_campo", "urea_campo", "dap_sigap", "urea_sigap",
        (F.coalesce("dap_campo", zero) - F.col("dap_sigap")).alias("dap_campo_vs_sigap"),
        (F.coalesce("urea_campo", zero) - F.col("urea_sigap")).alias("urea_campo_vs_sigap"))


def field_statistics(flows: DataFrame, reports: DataFrame, centres: DataFrame, today: dt.date) -> DataFrame:
    """Per centre the last report, days reported, gaps to the system and compliance."""
    last = last_report_per_day(reports).groupBy("id_ceda_agricultura").agg(
        F.max(F.struct("fecha", "dap_campo", "urea_campo")).alias("r"), F.count("*").alias("dias_reportados"))
    stock = current_stock(flows, centres, today).select(
        "unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "nombre_cedas",
        F.col("dap_ton_inventario_acumulado").alias("dap_sigap"), F.col("urea_ton_inventario_acumulado").alias("urea_sigap"))
    rows = stock.join(last, "id_ceda_agricultura", "left").select(
        *stock.columns, F.col("r.fecha").alias("fecha_ultimo_reporte"),
        F.coalesce("dias_reportados", F.lit(0)).alias("dias_reportados"),
        F.col("r.dap_campo").alias("inventario_dap_ultimo"), F.col("r.urea_campo").alias("inventario_urea_ultimo"))
    gap_dap = F.col("inventario_dap_ultimo") - F.col("dap_sigap")
    gap_urea = F.col("inventario_urea_ultimo") - F.col("urea_sigap")
    stocks = [F.col(c) for c in ("dap_sigap", "urea_sigap", "inventario_dap_ultimo", "inventario_urea_ultimo")]
    return rows.select(
        "*", gap_dap.alias("dap_campo_vs_sigap"), gap_urea.alias("urea_campo_vs_sigap"),
        stock_gap_class(gap_dap).alias("clase_dap"), stock_gap_class(gap_urea).alias("clase_urea"),
        reporting_compliance(F.col("fecha_ultimo_reporte"), today, *stocks).alias("cumplimiento_status"),
        days_late(F.col("fecha_ultimo_reporte"), today).alias("dias_atraso"))


def gap_tallies(statistics: DataFrame) -> DataFrame:
    """How many centres fall in each gap class, the two products counted separately."""
    def tally(name: str) -> Column:
        return F.count_if(F.col("clase_dap") == name) + F.count_if(F.col("clase_urea") == name)

    return statistics.agg(
        tally("faltante_grave").alias("faltantes_graves"), tally("faltante_menor").alias("faltantes_menores"),
        tally("excedente_grave").alias("excedentes_graves"), tally("excedente_menor").alias("excedentes_menores"),
        F.count_if(~F.col("cumplimiento_status")).alias("sin_reporte"))


def who_reports(reports: DataFrame, centres: DataFrame) -> DataFrame:
    """Reports, days and last time per centre and sender."""
    sender = F.lower(F.trim("quien_reporta"))
    per_day = reports.filter("fecha_y_hora IS NOT NULL").groupBy(
        "id_ceda_agricultura", sender.alias("quien_reporta"), F.to_date("fecha_y_hora").alias("d")).agg(
        F.count("*").alias("n"), F.max("fecha_y_hora").alias("u"))
    sums = per_day.groupBy("id_ceda_agricultura", "quien_reporta").agg(
        F.sum("n").alias("reportes"), F.count("*").alias("dias"), F.max("u").alias("ultimo_reporte"))
    return sums.join(centre_context(centres), "id_ceda_agricultura")
