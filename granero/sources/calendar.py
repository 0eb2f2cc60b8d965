"""Date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spanish month and day names, January and Monday first.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
          "Noviembre", "Diciembre")
DAYS = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("fecha"))


def with_calendar_columns(df: DataFrame, date: str = "fecha") -> DataFrame:
    """Year, month, ISO week, day, Spanish names and weekend flag of a date column."""
    d = F.col(date)
    return df.withColumns({
        "anio": F.year(d),
        "mes": F.month(d),
        "semana": F.weekofyear(d).cast("bigint"),
        "dia": F.dayofmonth(d),
        "nombre_mes": F.array(*[F.lit(m) for m in MONTHS])[F.month(d) - 1],
        "nombre_dia": F.array(*[F.lit(x) for x in DAYS])[F.weekday(d)],
        "es_fin_de_semana": F.weekday(d) >= 5,
    })


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The calendar table."""
    return with_calendar_columns(days_between(spark, start, end))


def calendar_covering(df: DataFrame, date: str) -> DataFrame:
    """The calendar table from the first to the last date of a table, whose bounds are one small aggregate."""
    ends = df.agg(F.min(date).cast("date").alias("a"), F.max(date).cast("date").alias("b"))
    return with_calendar_columns(ends.select(F.explode(F.sequence("a", "b")).alias("fecha")))
