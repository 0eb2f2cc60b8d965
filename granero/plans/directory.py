"""Contact directory built from the centre network."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.operators.dedupe import first_per_key
from granero.sources.sinks import replace_where

# The two role names that the job regenerates.
CENTRE_ROLE = "RESPONSABLE DE CEDA"
ZONE_ROLE = "COORDINADOR OPERATIVO DE ZONA"
COLUMNS = ("estado", "unidad_operativa", "zona_operativa", "id_ceda_agricultura", "cargo", "curp", "nombre_completo",
           "correo_electronico", "telefono", "comentarios", "fecha_actualizacion")


def _entries(df: DataFrame, role: str, name: Column, mail: Column, phone: Column, now: dt.datetime) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.select(
        "estado", "unidad_operativa", "zona_operativa", "id_ceda_agricultura", F.lit(role).alias("cargo"),
        nothing.alias("curp"), name.alias("nombre_completo"), mail.alias("correo_electronico"),
        phone.alias("telefono"), nothing.alias("comentarios"),
        F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz").alias("fecha_actualizacion"))


def centre_contacts(centres: DataFrame, now: dt.datetime) -> DataFrame:
    """B2: one entry per centre, blank where the network names nobody."""
    blank = F.lit("")
    rows = centres.filter("id_ceda_agricultura IS NOT NULL").withColumnRenamed("coordinacion_estatal", "unidad_operativa")
    return _entries(rows, CENTRE_ROLE, F.coalesce("responsable_cedas", blank), F.coalesce("rc_correo", blank),
                    F.coalesce("rc_telefono", blank), now)


def zone_contacts(centres: DataFrame, now: dt.datetime) -> DataFrame:
    """The first coordinator of each state and zone, by centre."""
    named = centres.filter("coordinador_operativo IS NOT NULL").select(
        "estado", "zona_operativa", "id_ceda_agricultura", F.col("coordinacion_estatal").alias("unidad_operativa"),
        "coordinador_operativo", "coz_correo", "coz_telefono")
    first = first_per_key(named, ["estado", "zona_operativa"], ["id_ceda_agricultura"])
    return _entries(first.withColumn("id_ceda_agricultura", F.lit("N/A")), ZONE_ROLE, F.col("coordinador_operativo"),
                    F.col("coz_correo"), F.col("coz_telefono"), now)


def build_directory(centres: DataFrame, now: dt.datetime) -> DataFrame:
    """Both roles."""
    return centre_contacts(centres, now).unionByName(zone_contacts(centres, now))


def refresh_directory(existing: DataFrame, centres: DataFrame, now: dt.datetime) -> DataFrame:
    """Entries of other roles stay, the two roles are replaced."""
    return replace_where(existing, F.col("cargo").isin(CENTRE_ROLE, ZONE_ROLE), build_directory(centres, now))
