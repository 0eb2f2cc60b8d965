"""The batch as a graph: independent steps run side by side, and a rerun builds only what changed or failed."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

import granero
from granero.plans import deliveries, freight, inventory, orders
from granero.plans.batch import Outcome, Step, Tables
from granero.sources.sinks import drop_stored, export_csv, stored_exists

MANIFEST = "paso string, huella string, estado string, filas bigint, error string, tabla_anterior string"
STORED = ("ok", "vigente", "sin exportar")


# ---- exports of the batch

def export_steps(start: dt.date, end: dt.date) -> list[Step]:
    """The tables that are exported each day beside those of `daily_steps`, over the same names."""
    def step(name: str, needs: str, build) -> Step:
        return Step(name, tuple(needs.split()), lambda t: build(*(t[n] for n in needs.split())), export=True)

    return [
        step("entregas_td", "entregas", deliveries.deliveries_by_centre),
        step("fletes_td", "freight", freight.freight_by_centre),
        step("fletes_fechas_td", "freight", freight.freight_by_delivery_day),
        step("fletes_por_origen", "freight centres", freight.freight_by_origin),
        step("incidencias_td", "incidents", inventory.incident_totals),
        step("pedidos_sigap_td", "centres order_summary", orders.order_summary_by_centre),
        step("pedidos_td", "order_lines", orders.orders_by_centre),
        step("red_td", "centres", orders.network_summary),
        step("remanentes_td", "remnants", inventory.remnant_totals),
        step("transferencias_td", "transfers", inventory.transfer_totals),
        step("abasto_por_estado", "freight remnants centres", orders.supply_by_state),
        step("avances_td", "entregas centres", deliveries.progress_by_state),
        step("entregas_diarias", "entregas", lambda d: deliveries.deliveries_by_day(d, start, end)),
        step("envios_diarios", "freight", freight.shipments_by_day),
        step("derechohabientes_por_municipio", "entregas centres", deliveries.beneficiaries_by_municipality),
        step("abasto_y_remanente_por_dia", "freight remnants", lambda f, m: orders.supply_by_day(f, m, start, end)),
        step("abasto_y_remanente_por_dia_sin_transito", "freight remnants",
             lambda f, m: orders.supply_by_day(f, m, start, end, with_transit=False)),
        step("pedidos_y_remanentes_por_dia", "order_lines remnants", lambda o, m: orders.orders_and_remnants_by_day(o, m, start, end)),
        step("entregas_por_estado_y_sexo", "entregas centres", deliveries.deliveries_by_state_and_sex),
        step("entregas_semanales", "entregas", deliveries.deliveries_by_week),
        step("pedidos_por_dia", "order_lines", lambda o: orders.orders_by_day(o, start, end)),
        step("reporte_derechohabientes", "entregas registry", deliveries.beneficiary_report),
        step("reporte_fletes", "freight centres", deliveries.freight_report),
        step("entregas_por_estado_ceda_y_fecha", "entregas centres", deliveries.deliveries_by_state_centre_day),
    ]


# ---- fingerprints

def code_fingerprint() -> str:
    """Of the library's source: any change of code builds everything anew."""
    digest = hashlib.sha256()
    root = Path(granero.__file__).parent
    for source in sorted(root.rglob("*.py")):
        if "llm" not in source.relative_to(root).parts:
            digest.update(source.read_bytes())
    return digest.hexdigest()


def stored_fingerprint(spark: SparkSession, path: str) -> str:
    """Of a stored table: names, lengths and times of its files; no data is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def _fingerprints(steps: Iterable[Step], sources: Mapping[str, str], code: str, parameters: str) -> dict[str, str | None]:
    """Of every step: its name, code, parameters and what it reads; None where a source has none, such a step always runs."""
    out: dict[str, str | None] = dict(sources)
    for step in steps:
        parts = [out.get(n) for n in step.needs]
        out[step.name] = None if None in parts else hashlib.sha256("\n".join([step.name, code, parameters, *parts]).encode()).hexdigest()
    return out


# ---- the run

def in_order(steps: Iterable[Step]) -> list[Step]:
    """Every step after the ones it needs; a circle raises `graphlib.CycleError`."""
    by_name = {s.name: s for s in steps}
    graph = TopologicalSorter({s.name: [n for n in s.needs if n in by_name] for s in by_name.values()})
    return [by_name[n] for n in graph.static_order()]


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """What the last run left: one row per step."""
    return spark.read.schema(MANIFEST).parquet(f"{out}/_manifiesto")


def run_graph(spark: SparkSession, sources: Tables, out: str, steps: list[Step], *, fingerprints: Mapping[str, str] | None = None,
              parameters: str = "", workers: int = 4, only: Iterable[str] | None = None, code: str | None = None) -> list[Outcome]:
    """B1: write the steps under `out`, up to `workers` of them at a time, each in a scheduler pool of its own.

    A step starts when all it needs is stored. The manifest keeps each step's fingerprint (`fingerprints` has those of the
    sources): a step with the same one whose table is there is left as it is (`vigente`), so after a failure or a changed
    source a run builds what failed, what changed and what depends on it. `only` names steps to build; the others are
    taken as stored.

    A failed step stops the steps that need it, no others. Its last good table moves to `out/_anteriores`, named in the
    manifest, so it is neither lost nor taken for new. Tables are written beside the old ones and change places when they
    are complete. The outcomes come in the order of the graph.
    """
    ordered, code = in_order(steps), code_fingerprint() if code is None else code
    chosen = {s.name for s in ordered} if only is None else set(only)
    known = {r["paso"]: r for r in read_manifest(spark, out).collect()} if stored_exists(spark, f"{out}/_manifiesto") else {}
    marks = _fingerprints(ordered, fingerprints or {}, code, parameters)
    tables: dict[str, DataFrame] = dict(sources)
    done: dict[str, Outcome] = {}
    old_places: dict[str, str] = {}

    def current(step: Step) -> bool:
        row = known.get(step.name)
        if row is None or row["estado"] not in ("ok", "vigente") or not stored_exists(spark, f"{out}/{step.name}"):
            return False
        return step.name not in chosen or (marks[step.name] is not None and row["huella"] == marks[step.name])

    def build(step: Step) -> Outcome:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step.name)
        fresh, place = f"{out}/_nuevos/{step.name}", f"{out}/{step.name}"
        try:
            step.build(tables).write.mode("overwrite").parquet(fresh)
            _move(spark, fresh, place)
            rows = spark.read.parquet(place).count()
        except Exception as e:  # reported with the other outcomes
            old_places[step.name] = _set_aside(spark, out, step.name)
            return Outcome(step.name, "error", error=str(e))
        try:
            if step.export:
                export_csv(spark.read.parquet(place), f"{out}/csv/{step.name}", mode="overwrite")
        except Exception as e:
            drop_stored(spark, f"{out}/csv/{step.name}")
            return Outcome(step.name, "sin exportar", rows, str(e))
        return Outcome(step.name, "ok", rows)

    names, running = {s.name for s in ordered}, dict[Future, str]()
    waiting = list(ordered)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        while waiting or running:
            for step in list(waiting):
                inner = [n for n in step.needs if n in names]
                if any(n not in done for n in inner):
                    continue
                waiting.remove(step)
                missing = [n for n in step.needs if n not in tables]
                rebuilt = any(done[n].status != "vigente" for n in inner)
                if missing:
                    old_places[step.name] = _set_aside(spark, out, step.name)
                    done[step.name] = Outcome(step.name, "omitida", error=f"falta {', '.join(missing)}")
                elif current(step) and not (rebuilt and step.name in chosen):
                    done[step.name] = Outcome(step.name, "vigente", known[step.name]["filas"])
                    tables[step.name] = spark.read.parquet(f"{out}/{step.name}")
                elif step.name not in chosen:
                    done[step.name] = Outcome(step.name, "omitida", error="no pedida y sin tabla")
                else:
                    running[pool.submit(inheritable_thread_target(spark)(build), step)] = step.name
                    continue
                break  # what has just been settled may free others
            else:
                if running:
                    finished, _ = wait(running, return_when=FIRST_COMPLETED)
                    for future in finished:
                        name = running.pop(future)
                        done[name] = future.result()
                        if done[name].status in STORED:
                            tables[name] = spark.read.parquet(f"{out}/{name}")
    outcomes = [done[s.name] for s in ordered]
    rows = [(o.name, marks[o.name], o.status, o.rows, o.error, old_places.get(o.name)) for o in outcomes]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{out}/_manifiesto")
    return outcomes


def _move(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    drop_stored(spark, target)
    if not system.rename(path(source), path(target)):
        raise OSError(f"{source} cannot take the place of {target}")


def _set_aside(spark: SparkSession, out: str, name: str) -> str | None:
    """Move a step's last good table out of the way, with its export gone; its new place, if there was one."""
    drop_stored(spark, f"{out}/csv/{name}")
    target = f"{out}/_anteriores/{name}"
    if stored_exists(spark, f"{out}/{name}"):
        _move(spark, f"{out}/{name}", target)
    return target if stored_exists(spark, target) else None
