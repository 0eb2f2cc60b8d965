"""Targets and progress per centre, list status and day, and the delivery lists behind them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.classify import classify_list
from granero.functions.dates import days_elapsed
from granero.functions.numbers import sum_tons
from granero.operators.daily import day_spans, expand_days
from granero.operators.dedupe import first_per_key, rows_absent

CENTRE_COLUMNS = ("unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "nombre_cedas")
MEASURES = ("avance_dh", "avance_superficie", "avance_dap_ton", "avance_urea_ton", "avance_total_ton")
TARGETS = ("meta_dh", "meta_superficie", "meta_dap_ton", "meta_urea_ton", "meta_total_ton")
KEYS = ("id_ceda_agricultura", "estatus", "incorporacion")


def centre_names(centres: DataFrame) -> DataFrame:
    """One row per centre with the columns the reports show."""
    named = centres.select(F.col("coordinacion_estatal").alias("unidad_operativa"), "estado", "zona_operativa",
                           "id_ceda_agricultura", "nombre_cedas")
    return first_per_key(named, ["id_ceda_agricultura"])


def unique_registry(registry: DataFrame, *extra: str) -> DataFrame:
    """One row per receipt, with the class of its list. The receipt is the key and never NULL."""
    slim = registry.filter("acuse_estatal IS NOT NULL").select(
        "acuse_estatal", "id_ceda_agricultura", "estatus", "superficie", "dap_ton", "urea_ton", *extra)
    return first_per_key(slim, ["acuse_estatal"]).withColumn("incorporacion", classify_list(F.col("estatus")))


def _registry_sums(unique: DataFrame, *extra: str) -> DataFrame:
    """Targets per registry centre and status; its rows are also the pairs that the daily grid shows."""
    return unique.groupBy(*KEYS, *extra).agg(
        F.count("*").alias("meta_dh"), F.sum("superficie").alias("meta_superficie"),
        sum_tons(F.col("dap_ton")).alias("meta_dap_ton"), sum_tons(F.col("urea_ton")).alias("meta_urea_ton"),
        sum_tons(F.col("dap_ton") + F.col("urea_ton")).alias("meta_total_ton"))


def targets_by_centre(registry: DataFrame, centres: DataFrame, by_publication: bool = False) -> DataFrame:
    """V1: target counts and tons per centre and status, in one variant also per publication date.

    The registry is summed per centre first; only those sums meet the centres. Centres outside the network then fall
    together under NULL, as they do when grouping by the network's columns. Total tons skip rows with a missing part.
    """
    extra = ("fecha_de_publicacion",) if by_publication else ()
    sums = _registry_sums(unique_registry(registry, *extra), *extra)
    names = centre_names(centres)
    joined = sums.withColumnRenamed("id_ceda_agricultura", "_id").join(
        names, F.col("_id") == names.id_ceda_agricultura, "left")
    return joined.groupBy(*CENTRE_COLUMNS, "estatus", "incorporacion", *extra).agg(
        *[F.sum(m).cast(sums.schema[m].dataType).alias(m) for m in TARGETS])


def _progress_facts(deliveries: DataFrame, unique: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    slim = unique.select("acuse_estatal", "estatus", "incorporacion")
    inside = deliveries.filter(F.col("fecha_entrega").between(F.lit(start), F.lit(end)))
    return inside.join(slim, "acuse_estatal").groupBy(
        F.col("cdf_entrega").alias("id_ceda_agricultura"), "estatus", "incorporacion",
        F.col("fecha_entrega").alias("fecha")).agg(
        F.count("*").alias("avance_dh"), F.sum("superficie_apoyada").alias("avance_superficie"),
        sum_tons(F.col("ton_dap_entregada")).alias("avance_dap_ton"),
        sum_tons(F.col("ton_urea_entregada")).alias("avance_urea_ton"),
        sum_tons(F.col("ton_dap_entregada") + F.col("ton_urea_entregada")).alias("avance_total_ton"))


def _progress_spans(deliveries: DataFrame, registry: DataFrame, centres: DataFrame, year: int,
                    totals: tuple[str, ...] = ()) -> DataFrame:
    """Movement days of every registry pair, with the names of its centre and its targets."""
    start, end = dt.date(year, 1, 1), dt.date(year, 12, 31)
    unique = unique_registry(registry)
    names = centre_names(centres).withColumn("_in_network", F.lit(True))
    spine = _registry_sums(unique).join(names, "id_ceda_agricultura", "left")
    # targets belong to centres of the network and to a named status
    has_target = F.col("_in_network") & F.col("estatus").isNotNull()
    spine = spine.select(*KEYS, *[c for c in CENTRE_COLUMNS if c not in KEYS],
                         *[F.when(has_target, F.col(t)).alias(t) for t in TARGETS])
    return day_spans(_progress_facts(deliveries, unique, start, end), spine, KEYS, MEASURES, start, end, totals=totals)


def daily_progress(deliveries: DataFrame, registry: DataFrame, centres: DataFrame, year: int) -> DataFrame:
    """V2: progress per centre, status and day of the year, zero-filled.

    The grid comes from the registry, so a delivery at a pair the registry does not list is lost; see `lost_progress`.
    """
    days = expand_days(_progress_spans(deliveries, registry, centres, year), MEASURES)
    return days.select(*CENTRE_COLUMNS, "estatus", "incorporacion", "fecha", *MEASURES)


def lost_progress(deliveries: DataFrame, registry: DataFrame, year: int) -> DataFrame:
    """V2 side output: progress whose centre and status pair is missing (or NULL) in the registry."""
    unique = unique_registry(registry)
    facts = _progress_facts(deliveries, unique, dt.date(year, 1, 1), dt.date(year, 12, 31))
    return facts.join(unique.select(*KEYS).distinct(), list(KEYS), "left_anti").select(*KEYS, "fecha", *MEASURES)


def progress_vs_target(deliveries: DataFrame, registry: DataFrame, centres: DataFrame, year: int) -> DataFrame:
    """V3: daily progress with running totals (W1) and percent of the target."""
    spans = _progress_spans(deliveries, registry, centres, year, totals=MEASURES)

    def percent(done: str, target: str):
        share = F.round(F.try_divide(F.col(done).cast("decimal(18,3)") * 100, F.col(target).cast("decimal(18,3)")), 2)
        return F.when(F.col(target) > 0, share).otherwise(0).cast("decimal(18,2)")

    # totals and percents hold for a whole span, so they are worked out before the days are filled in
    days = expand_days(spans.withColumns({
        "avance_pct_dh_acum": percent("avance_dh_acum", "meta_dh"),
        "avance_pct_ton_acum": percent("avance_total_ton_acum", "meta_total_ton")}), MEASURES)
    return days.select(*CENTRE_COLUMNS, "estatus", "incorporacion", "fecha", *TARGETS, *MEASURES,
                       *[f"{m}_acum" for m in MEASURES], "avance_pct_dh_acum", "avance_pct_ton_acum")


def target_and_progress(deliveries: DataFrame, registry: DataFrame, centres: DataFrame, year: int) -> DataFrame:
    """Targets with the year's progress per centre and status, without the day."""
    unique = unique_registry(registry)
    facts = _progress_facts(deliveries, unique, dt.date(year, 1, 1), dt.date(year, 12, 31))
    done = facts.groupBy("id_ceda_agricultura", "estatus").agg(*[F.sum(m).alias(m) for m in MEASURES])
    goal = targets_by_centre(registry, centres)
    return goal.join(done, ["id_ceda_agricultura", "estatus"], "left").select(
        *CENTRE_COLUMNS, "estatus", "incorporacion", *TARGETS,
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in MEASURES])


def _delivery_list(deliveries: DataFrame, registry: DataFrame) -> DataFrame:
    reg = registry.select("acuse_estatal", "primer_apellido", "segundo_apellido", "nombre", "fecha_de_publicacion",
                          "estatus")
    return deliveries.join(reg, "acuse_estatal", "left").select(
        "acuse_estatal", F.col("curp_renapo").alias("curp"), "primer_apellido", "segundo_apellido", "nombre",
        F.col("cdf_entrega").alias("id_ceda_agricultura"), F.col("fecha_de_publicacion").alias("fecha_publicacion"),
        "fecha_entrega", F.col("estatus").alias("listado"), classify_list(F.col("estatus"), "_").alias("tipo_incorporacion"),
        "cultivo", F.col("superficie_apoyada").alias("hectareas"), F.col("ton_dap_entregada").alias("dap_ton"),
        F.col("ton_urea_entregada").alias("urea_ton"),
        (F.coalesce("ton_dap_entregada", F.lit(0)) + F.coalesce("ton_urea_entregada", F.lit(0))).alias("total_ton"),
        days_elapsed(F.col("fecha_entrega"), F.col("fecha_de_publicacion")).alias("dias_transcurridos_entrega"))


def delivery_list(deliveries: DataFrame, registry: DataFrame, centres: DataFrame) -> DataFrame:
    """Every delivery with its registry entry and centre."""
    names = centres.select(F.col("coordinacion_estatal").alias("unidad_operativa"), "estado", "zona_operativa",
                           "id_ceda_agricultura", F.col("nombre_cedas").alias("nombre_ceda"))
    rows = _delivery_list(deliveries, registry)
    return rows.join(names, "id_ceda_agricultura", "left").select(
        "unidad_operativa", "estado", "zona_operativa", "nombre_ceda", *rows.columns)


# Prefix and class label of the wide columns.
LIST_CLASSES = (("ad", "ACCESO_DIRECTO"), ("ni", "NUEVO_INGRESO"))
LIST_SUMS = ("hectareas", "dap_ton", "urea_ton", "total_ton")
WIDE_MEASURES = tuple(f"{p}_{m}" for p, _ in LIST_CLASSES for m in ("apoyados", *LIST_SUMS)) + ("mas_de_150_dias",)


def list_progress_by_centre(deliveries: DataFrame, registry: DataFrame, centres: DataFrame) -> DataFrame:
    """V5, A2: both list classes side by side per centre, and the deliveries later than 150 days."""
    return list_progress_of(_delivery_list(deliveries, registry), centres)


def list_progress_of(listed: DataFrame, centres: DataFrame) -> DataFrame:
    """V5 over a delivery list (V4) that is there already. Summed per centre before the centre columns are looked up."""
    columns = []
    for prefix, label in LIST_CLASSES:
        inside = F.col("tipo_incorporacion") == label
        columns.append(F.count_if(inside).alias(f"{prefix}_apoyados"))
        columns += [F.coalesce(F.sum(F.when(inside, F.col(m))), F.lit(0)).alias(f"{prefix}_{m}") for m in LIST_SUMS]
    late = F.count_if(F.coalesce(F.col("dias_transcurridos_entrega") > 150, F.lit(False))).alias("mas_de_150_dias")
    sums = listed.groupBy("id_ceda_agricultura").agg(*columns, late)
    names = centre_names(centres).withColumnRenamed("nombre_cedas", "nombre_ceda")
    return sums.join(names, "id_ceda_agricultura", "left").select(
        "unidad_operativa", "estado", "zona_operativa", "id_ceda_agricultura", "nombre_ceda", *WIDE_MEASURES)


def list_progress_by_state(by_centre: DataFrame) -> DataFrame:
    """V6, A3: the centre rows rolled up to states."""
    return by_centre.groupBy("unidad_operativa", "estado").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in WIDE_MEASURES])


def unregistered_deliveries(deliveries: DataFrame, registry: DataFrame) -> DataFrame:
    """Deliveries whose receipt is not in the registry."""
    return rows_absent(deliveries, registry, "acuse_estatal")
