"""Operating progress per centre and the national figures derived from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.numbers import TONS, pending, percent_of_target
from granero.operators.filters import filter_eq
from granero.plans.freight import DAP, DELIVERED, UREA, has_status
from granero.plans.inventory import FLOWS, move_flows

INFLOWS = ("dap_flete", "urea_flete", "dap_transfer", "urea_transfer", "dap_remanente", "urea_remanente")
OUTFLOWS = ("dap_transf_out", "urea_transf_out", "dap_rem_out", "urea_rem_out")


def operating_progress(freight: DataFrame, transfers: DataFrame, remnants: DataFrame, incidents: DataFrame,
                       deliveries: DataFrame, centres: DataFrame) -> DataFrame:
    """One row per centre with all its movements, deliveries and targets.

    Every source contributes rows with its own columns to one aggregate, in place of six joins on the same key.
    """
    def part(df: DataFrame, centre: str, **cols: Column) -> DataFrame:
        return df.select(F.col(centre).alias("id_ceda_agricultura"), *[c.alias(n) for n, c in cols.items()])

    def moves(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
        return part(move_flows(df), "id_ceda_agricultura", **{n: F.col(c) for c, n in zip(FLOWS, names)})

    def product(code: str, tons: str, column: str) -> Column:
        return F.when(F.col(column) == code, F.col(tons))

    parts = [
        part(freight.filter(has_status(DELIVERED)), "id_ceda_agricultura",
             dap_flete=product(DAP, "toneladas_en_el_destino", "abreviacion_producto"),
             urea_flete=product(UREA, "toneladas_en_el_destino", "abreviacion_producto")),
        moves(transfers, ("dap_transfer", "urea_transfer", "dap_transf_out", "urea_transf_out")),
        moves(remnants, ("dap_remanente", "urea_remanente", "dap_rem_out", "urea_rem_out")),
        part(incidents, "cdf_incidente", dap_incidente=product(DAP, "ton_incidencia", "clave_producto"),
             urea_incidente=product(UREA, "ton_incidencia", "clave_producto")),
        part(deliveries, "cdf_entrega", dap_dh=F.col("ton_dap_entregada"), urea_dh=F.col("ton_urea_entregada"),
             dh_apoyados=F.lit(1), ha_apoyadas=F.col("superficie_apoyada")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in stacked.columns if c != "id_ceda_agricultura"]
    sums = stacked.groupBy("id_ceda_agricultura").agg(*[
        F.sum(c).cast("bigint" if c in ("dh_apoyados", "ha_apoyadas") else TONS).alias(c) for c in names])
    goal = centres.select("id_ceda_agricultura", F.col("coordinacion_estatal").alias("unidad_operativa"), "estado",
                          "meta_derechohabientes", "meta_superficie_ha", "meta_total_ton")
    return goal.join(sums, "id_ceda_agricultura", "left").select(
        *goal.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names])


def supply_expression() -> Column:
    """A5: inflows minus outflows of a row; a NULL part makes the row NULL."""
    total = F.lit(0)
    for c in INFLOWS:
        total = total + F.col(c)
    for c in OUTFLOWS:
        total = total - F.col(c)
    return total


def _achieved(grouped) -> DataFrame:
    return grouped.agg(
        F.sum(supply_expression()).alias("abasto"), F.sum(F.col("dap_dh") + F.col("urea_dh")).alias("entregado"),
        F.sum("dh_apoyados").alias("dh_apoyados"), F.sum("ha_apoyadas").alias("ha_apoyadas"))


def progress_by_state(progress: DataFrame) -> DataFrame:
    """A6, first level: supply and deliveries per state."""
    return _achieved(progress.groupBy("estado"))


def national_totals(progress: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """A6 with state `targets` (states without one drop out), A15 with the centres' own targets."""
    if targets is None:
        own = ("meta_total_ton", "meta_derechohabientes", "meta_superficie_ha")
        return progress.agg(
            F.sum(own[0]).alias("meta_total_ton"), F.sum(supply_expression()).alias("abasto"),
            F.sum(F.col("dap_dh") + F.col("urea_dh")).alias("entregado"), F.sum("dh_apoyados").alias("dh_apoyados"),
            F.sum("ha_apoyadas").alias("ha_apoyadas"), F.sum(own[1]).alias("meta_dh"), F.sum(own[2]).alias("meta_ha"))
    joined = progress_by_state(progress).join(targets, "estado")
    return joined.agg(
        F.sum("total_ton").alias("meta_total_ton"), F.sum("abasto").alias("abasto"),
        F.sum("entregado").alias("entregado"), F.sum("dh_apoyados").alias("dh_apoyados"),
        F.sum("ha_apoyadas").alias("ha_apoyadas"), F.sum("derechohabientes").alias("meta_dh"),
        F.sum("superficie_ha").alias("meta_ha"))


def national_kpi(progress: DataFrame, targets: DataFrame | None = None, **chosen: str) -> DataFrame:
    """The national cards. Official targets with `targets`, unless one centre is chosen."""
    rows = filter_eq(progress, chosen)
    official = targets if not chosen.get("id_ceda_agricultura") else None
    t = national_totals(rows, official)
    pairs = (("abasto", "meta_total_ton", "abasto"), ("entregado", "meta_total_ton", "entregado"),
             ("dh_apoyados", "meta_dh", "dh"), ("ha_apoyadas", "meta_ha", "ha"))
    return t.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in t.columns],
        *[percent_of_target(F.col(v), F.col(m)).alias(f"porc_{n}") for v, m, n in pairs],
        *[pending(F.col(v), F.col(m)).alias(f"pendiente_{n}") for v, m, n in pairs])


def state_progress_table(progress: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual per state with percent and pending, plus the national row (`estado` NULL, nivel 1).

    Sort by `porc_entregado` descending to show it.
    """
    joined = progress_by_state(progress).join(targets, "estado")
    names = ("abasto", "entregado", "dh_apoyados", "ha_apoyadas", "total_ton", "derechohabientes", "superficie_ha")
    table = joined.rollup("estado").agg(F.grouping("estado").cast("int").alias("nivel"),
                                        *[F.sum(c).alias(c) for c in names])
    return table.select(
        "*", percent_of_target(F.col("abasto"), F.col("total_ton")).alias("porc_abasto"),
        percent_of_target(F.col("entregado"), F.col("total_ton")).alias("porc_entregado"),
        percent_of_target(F.col("dh_apoyados"), F.col("derechohabientes")).alias("porc_dh"),
        pending(F.col("entregado"), F.col("total_ton")).alias("pendiente_entregado"))
