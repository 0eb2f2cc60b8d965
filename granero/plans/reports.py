"""Column layouts of the reports sent to state coordinators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.text import full_name
from granero.operators.filters import open_date_window

NOT_KEPT = "N/A"  # columns the receivers expect and the programme does not hold


def supported_people(full: DataFrame, deliveries: DataFrame, after: dt.date, before: dt.date, programme: str,
                     state: str | None = None) -> DataFrame:
    """People served strictly between two dates, optionally of one state.

    Only rows with a delivery in the window remain, so the lookup is an inner join.
    """
    served = open_date_window(deliveries.select("acuse_estatal", "fecha_entrega"), "fecha_entrega", after, before)
    rows = full if state is None else full.filter(F.col("estado_predio_capturada") == state)
    return rows.join(served, "acuse_estatal").select(
        F.col("id_persona").alias("id_suri"), "nombre", F.col("primer_apellido").alias("primer apellido"),
        F.col("segundo_apellido").alias("segundo apellido"), F.col("curp_renapo").alias("curp"),
        F.col("estado_predio_capturada").alias("estado"), F.col("municipio_predio_capturada").alias("municipio"),
        F.lit(NOT_KEPT).alias("bancarizado"), F.lit("APOYADO").alias("estatus"), F.lit(programme).alias("programa"))


def producers_by_locality(deliveries: DataFrame, full: DataFrame) -> DataFrame:
    """Producers with place, crop and surface; the water regime comes from the full extract."""
    regime = full.select("acuse_estatal", "regimen_hidrico")
    return deliveries.join(regime, "acuse_estatal", "left").select(
        F.col("estado_predio_capturada").alias("Nombre de estado"), F.col("municipio_predio_capturada").alias("Nombre de municipio"),
        full_name(F.col("ln_nombre"), F.col("sn_primer_apellido"), F.col("sn_segundo_apellido")).alias("Nombre de Productor"),
        F.lit(NOT_KEPT).alias("Grupo de cultivos"), F.col("curp_renapo").alias("CURP"), F.col("cultivo").alias("Cultivo"),
        F.lit(NOT_KEPT).alias("Estrato"), F.col("regimen_hidrico").alias("Régimen Hídrico"),
        F.col("superficie_apoyada").alias("Superficie (Hectáreas)"), F.lit(NOT_KEPT).alias("Colmenas"))
