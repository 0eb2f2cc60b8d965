"""The daily batch: corrections, derived tables in dependency order, exports. Parquet is the hand-over."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero import schemas
from granero.functions.dates import parse_date_iso_first
from granero.operators.dedupe import differs, set_where, update_from
from granero.plans import deliveries, freight, inventory, kpi, loads, progress
from granero.sources.sinks import drop_stored, export_csv

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """One table of the batch: its name, the tables it reads, and how it is built."""

    name: str
    needs: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    export: bool = False


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    rows: int | None = None
    error: str | None = None


def load_steps() -> list[Step]:
    """B1, first part: the tables from their text extracts, named `<table>_texto`, each with its rejects beside it."""
    plain = {
        "freight": (loads.load_freight, schemas.FREIGHT, {}),
        "transfers": (loads.load_moves, schemas.MOVES, loads.MOVE_TEXT), "remnants": (loads.load_moves, schemas.MOVES, loads.MOVE_TEXT),
        "incidents": (loads.load_incidents, schemas.INCIDENTS, {}), "centres": (loads.load_centres, schemas.CENTRES, {}),
        "deliveries": (loads.load_deliveries, schemas.DELIVERIES, {"dates": parse_date_iso_first}),
        "order_lines": (lambda raw: loads.load_order_lines(raw, "orden"), schemas.ORDER_LINES, {"style": "strict"}),
        "order_summary": (loads.load_order_summary, schemas.ORDER_SUMMARY, {"style": "strict"}),
        "field_reports": (loads.load_field_reports, schemas.FIELD_REPORTS, {}),
    }
    steps = []
    for name, (load, schema, style) in plain.items():
        text, key = f"{name}_texto", schemas.KEYS[name]
        steps.append(Step(name, (text,), lambda t, text=text, load=load: load(t[text])))
        steps.append(Step(f"{name}_rechazos", (text,), lambda t, text=text, schema=schema, key=key, style=style:
                          loads.load_rejects(t[text], schema, key, **style)))
    return steps


def daily_steps(year: int, start: dt.date, end: dt.date, one_hectare: tuple[str, ...] = (),
                surface_from_registry: tuple[str, ...] = (), today: dt.date | None = None, registry_tons: bool = False) -> list[Step]:
    """B1: corrections and all derived tables over `centres`, `registry`, `deliveries`, `freight`, `transfers`,
    `remnants`, `incidents`, `field_reports` (and `registry_file` where a corrected registry extract is at hand).

    With `registry_tons` the delivered tons and bags follow the registry where they differ (J11 d)."""
    state, today = F.col("estado_predio_capturada"), today or end

    def corrected_deliveries(t: Tables) -> DataFrame:
        fixed = set_where(t["deliveries"].withColumn("superficie_apoyada", F.col("superficie_apoyada").cast("bigint")),
                          "superficie_apoyada", state.isin(*one_hectare), F.lit(1).cast("bigint"))
        fixed = update_from(fixed, t["registry"], F.col("acuse_estatal"), F.col("acuse_estatal"), "superficie_apoyada",
                            F.col("superficie"), state.isin(*surface_from_registry), empty="set")
        return tons_from_registry(fixed, t["registry"]) if registry_tons else fixed

    def corrected_registry(t: Tables) -> DataFrame:
        rows = t["registry"]
        if "registry_file" in t:
            rows = centre_from_registry_file(rows, t["registry_file"])
        return update_from(rows, t["deliveries"], F.upper(F.trim("acuse_estatal")),
                           F.upper(F.trim("acuse_estatal")), "id_ceda_agricultura",
                           F.when(F.trim("cdf_entrega") != "", F.trim("cdf_entrega")))

    def flows(t: Tables) -> DataFrame:
        return inventory.stock_flows(t["freight"], t["transfers"], t["remnants"], t["incidents"], t["entregas"])

    moves = ("freight", "transfers", "remnants", "incidents", "entregas", "centres")
    lists = ("entregas", "padron", "centres")
    return [
        Step("entregas", ("deliveries", "registry"), corrected_deliveries),
        Step("padron", ("registry", "deliveries"), corrected_registry),
        Step("avance_operativo_ceda", moves, lambda t: kpi.operating_progress(*(t[n] for n in moves)), export=True),
        Step("entregas_diarias_ceda", ("entregas", "centres"),
             lambda t: deliveries.deliveries_by_state_centre_day(t["entregas"], t["centres"])),
        Step("entregas_diarias_estado", ("entregas", "centres"),
             lambda t: deliveries.deliveries_by_day_state(t["entregas"], t["centres"])),
        Step("inventario_diario", moves, lambda t: inventory.daily_stock(flows(t), t["centres"], start, end)),
        Step("remanente_diario", ("remnants", "centres"),
             lambda t: inventory.daily_stock(inventory.carry_over_flows(t["remnants"]), t["centres"], start, end)),
        Step("remanente", ("remnants", "centres"),
             lambda t: inventory.current_stock(inventory.carry_over_flows(t["remnants"]), t["centres"])),
        Step("inventario_campo_sigap", (*moves, "field_reports"),
             lambda t: inventory.field_vs_system(flows(t), t["field_reports"], t["centres"])),
        Step("estadisticas_campo", (*moves, "field_reports"),
             lambda t: inventory.field_statistics(flows(t), t["field_reports"], t["centres"], today)),
        Step("fletes_enriquecidos", ("freight", "centres"), lambda t: freight.enriched_freight(t["freight"], t["centres"])),
        Step("avance_por_listado", lists, lambda t: progress.delivery_list(*(t[n] for n in lists))),
        Step("avance_listado_ceda", ("avance_por_listado", "centres"),
             lambda t: progress.list_progress_of(t["avance_por_listado"], t["centres"]), export=True),
        Step("avance_listado_estado", ("avance_listado_ceda",),
             lambda t: progress.list_progress_by_state(t["avance_listado_ceda"]), export=True),
        Step("metas_ceda_estatus", ("padron", "centres"), lambda t: progress.targets_by_centre(t["padron"], t["centres"])),
        Step("avances_diarios_ceda_estatus", lists, lambda t: progress.daily_progress(*(t[n] for n in lists), year)),
        Step("meta_y_avance_ceda_estatus", lists, lambda t: progress.target_and_progress(*(t[n] for n in lists), year), export=True),
        Step("avance_contra_meta", lists, lambda t: progress.progress_vs_target(*(t[n] for n in lists), year)),
        Step("quien_reporta", ("field_reports", "centres"), lambda t: inventory.who_reports(t["field_reports"], t["centres"])),
    ]


def centre_from_registry_file(registry: DataFrame, file: DataFrame) -> DataFrame:
    """J11 (a): the centre id of the registry extract, where it names one."""
    centre = F.trim("id_ceda")
    return update_from(registry, file, F.col("acuse_estatal"), F.col("acuse_estatal"), "id_ceda_agricultura",
                       F.when(centre != "", centre))


def tons_from_registry(delivered: DataFrame, registry: DataFrame) -> DataFrame:
    """J11 (d): where tons differ from the registry's, both tons and both bag counts follow it; a bag is 0.025 t, none is 0."""
    given = delivered.join(registry.select("acuse_estatal", "dap_ton", "urea_ton").groupBy("acuse_estatal").agg(
        F.min(F.struct("dap_ton", "urea_ton")).alias("_r")), "acuse_estatal", "left")
    differ = F.col("_r").isNotNull() & (differs(F.col("ton_dap_entregada"), F.col("_r.dap_ton"))
                                        | differs(F.col("ton_urea_entregada"), F.col("_r.urea_ton")))
    changed = {}
    for tons, bags, value in (("ton_dap_entregada", "dap_anio_actual", F.coalesce("_r.dap_ton", F.lit(0))),
                              ("ton_urea_entregada", "urea_anio_actual", F.coalesce("_r.urea_ton", F.lit(0)))):
        kind = {c: delivered.schema[c].dataType for c in (tons, bags)}
        changed[tons] = F.when(differ, value.cast(kind[tons])).otherwise(F.col(tons))
        changed[bags] = F.when(differ, F.round(value / F.lit(0.025).cast("decimal(4,3)")).cast(kind[bags])).otherwise(F.col(bags))
    return given.withColumns(changed).select(delivered.columns)


def steps_for(steps: list[Step], *wanted: str) -> list[Step]:
    """The steps that the wanted tables are built from, in order: for a run that is after these tables only."""
    kept, names = [], set(wanted)
    for step in reversed(steps):
        if step.name in names:
            kept.insert(0, step)
            names |= set(step.needs)
    return kept


def run_daily(spark: SparkSession, sources: Tables, out: str, steps: list[Step]) -> list[Outcome]:
    """B1: write every step under `out`, over what an earlier run left there.

    A failed step stops the steps that need it; whatever fails or is left out has no table under `out` afterwards, so
    an old one is never taken for new. A table counts as soon as it is stored, even if its export fails.
    """
    tables: dict[str, DataFrame] = dict(sources)
    outcomes: list[Outcome] = []
    for step in steps:
        path, csv = f"{out}/{step.name}", f"{out}/csv/{step.name}"
        missing = [n for n in step.needs if n not in tables]
        if missing:
            tables.pop(step.name, None)
            for old in (path, csv):
                drop_stored(spark, old)
            outcomes.append(Outcome(step.name, "omitida", error=f"falta {', '.join(missing)}"))
            continue
        try:
            step.build(tables).write.mode("overwrite").parquet(path)
        except Exception as e:  # reported with the other outcomes; dependants are left out
            tables.pop(step.name, None)
            for old in (path, csv):
                drop_stored(spark, old)
            outcomes.append(Outcome(step.name, "error", error=str(e)))
            continue
        tables[step.name] = stored = spark.read.parquet(path)
        rows = stored.count()
        try:
            if step.export:
                export_csv(stored, csv, mode="overwrite")
        except Exception as e:
            drop_stored(spark, csv)
            outcomes.append(Outcome(step.name, "sin exportar", rows, str(e)))
        else:
            outcomes.append(Outcome(step.name, "ok", rows))
    return outcomes


def report(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    """The outcomes as rows: one per step."""
    return spark.createDataFrame([(o.name, o.status, o.rows, o.error) for o in outcomes],
                                 "tabla string, estado string, filas bigint, error string")
