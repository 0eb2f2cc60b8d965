"""Preparation of daily series for charts. Inputs hold one row per day, so they stay small."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from granero.functions.dates import iso_week_label, iso_year, week_ending_saturday
from granero.operators.filters import filter_positive

FRIDAY = 4


def _whole() -> WindowSpec:
    """The whole series as one window: one row per day."""
    return Window.partitionBy()


def cumulative(daily: DataFrame, value: str, name: str, date: str = "fecha") -> DataFrame:
    """Running total over the days with a positive value."""
    upto = _whole().orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return filter_positive(daily, value).select(date, F.sum(value).over(upto).alias(name))


def gaps_as_of(series: Mapping[str, tuple[DataFrame, str]], today: dt.date, date: str = "fecha") -> DataFrame:
    """Cumulative values up to the day before `today`, and the four gaps between them.

    `series` maps `proyectado`, `abasto`, `entregado`, `pedido` to (daily frame, value column). A series without days
    counts 0. Each total is a plain sum: the last point of a running total.
    """
    yesterday = today - dt.timedelta(days=1)
    parts = None
    for name, (daily, value) in series.items():
        one = daily.filter((F.col(value) > 0) & (F.col(date) <= F.lit(yesterday))).select(
            F.lit(name).alias("serie"), F.col(value).cast("decimal(28,3)").alias("valor"))
        parts = one if parts is None else parts.unionByName(one)
    row = parts.agg(*[F.coalesce(F.sum(F.when(F.col("serie") == n, F.col("valor"))), F.lit(0)).alias(n)
                      for n in series])
    return row.select(
        "proyectado", "abasto", "entregado", "pedido",
        (F.col("abasto") - F.col("proyectado")).alias("abasto_menos_proyectado"),
        (F.col("entregado") - F.col("proyectado")).alias("entregado_menos_proyectado"),
        (F.col("pedido") - F.col("abasto")).alias("pedidos_por_atender"),
        (F.col("abasto") - F.col("entregado")).alias("inventario_mas_transito"))


def weekly_peak_days(daily: DataFrame, values: Sequence[str], with_year: bool = True, date: str = "fecha") -> DataFrame:
    """The Monday-to-Thursday day with the highest value (or sum of values) per ISO week, first date on a tie."""
    score = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    week = [F.weekofyear(date).alias("semana")] + ([iso_year(F.col(date)).alias("anio_iso")] if with_year else [])
    return (daily.filter(F.weekday(date) <= 3).groupBy(*week)
            .agg(F.min(F.struct((-score).alias("orden"), F.col(date), score.alias("valor"))).alias("p"))
            .select(*(["anio_iso"] if with_year else []), "semana", f"p.{date}", "p.valor"))


def penultimate_date(daily: DataFrame, date: str = "fecha") -> DataFrame:
    """Second latest date of the series, no row when there is only one."""
    n = F.row_number().over(_whole().orderBy(F.desc(date)))
    return daily.select(date, n.alias("n")).filter("n = 2").select(date)


def label_days(daily: DataFrame, values: Sequence[str], drop_last_friday: bool = False, quantile: float = 0.75,
               date: str = "fecha") -> DataFrame:
    """Days to label: Fridays, the penultimate date and the days at or above the quantile of a value.

    With `drop_last_friday`, the newest Friday counts only when it is the last date.
    """
    is_friday = F.weekday(date) == FRIDAY
    last_friday = F.max(F.when(is_friday, F.col(date))).over(_whole())
    last_date = F.max(date).over(_whole())
    keep_friday = ~((F.col(date) == last_friday) & (last_friday != last_date)) if drop_last_friday else F.lit(True)
    flagged = daily.select(
        date, *values,
        (is_friday & keep_friday).alias("es_viernes"),
        (F.row_number().over(_whole().orderBy(F.desc(date))) == 2).alias("es_penultima"),
        *[F.percentile(F.col(v).cast("double"), F.lit(quantile)).over(_whole()).alias(f"umbral_{v}") for v in values])
    peak = F.lit(False)
    for v in values:
        peak = peak | (F.col(v).cast("double") >= F.col(f"umbral_{v}"))
    return flagged.withColumn("es_pico", peak).filter("es_viernes OR es_penultima OR es_pico")


def quantile_of(daily: DataFrame, value: str, q: float) -> DataFrame:
    """Exact quantile with linear interpolation of a daily series; for tables see `positions.exact_quantile`."""
    return daily.agg(F.percentile(F.col(value).cast("double"), F.lit(q)).alias("cuantil"))


def iso_week_sums(daily: DataFrame, values: Sequence[str], date: str = "fecha") -> DataFrame:
    """Sums per ISO week label."""
    return daily.groupBy(iso_week_label(F.col(date)).alias("semana")).agg(*[F.sum(v).alias(v) for v in values])


def saturday_week_sums(daily: DataFrame, values: Sequence[str], date: str = "fecha") -> DataFrame:
    """Sums per week ending on Saturday; weeks without rows between the first and the last stay, with NULLs."""
    weeks = daily.groupBy(week_ending_saturday(F.col(date)).alias("w")).agg(*[F.sum(v).alias(v) for v in values])
    nxt = F.coalesce(F.lead("w").over(_whole().orderBy("w")), F.date_add("w", 7))
    spans = weeks.withColumn("hasta", F.date_sub(nxt, 7))
    every = spans.select("w", *values, F.explode(F.expr("sequence(w, hasta, interval 7 days)")).alias("fin_semana"))
    return every.select("fin_semana", F.weekofyear("fin_semana").alias("semana"),
                        *[F.when(F.col("w") == F.col("fin_semana"), F.col(v)).alias(v) for v in values])


def series_kpis(daily: DataFrame, value: str, target: int) -> DataFrame:
    """A10: total, maximum, mean and percent of a target over the days with a positive value."""
    total = F.sum(value)
    return filter_positive(daily, value).agg(
        total.alias("total"), F.max(value).alias("maximo"), F.min(value).alias("minimo"),
        F.avg(F.col(value).cast("double")).alias("promedio"),
        (total.cast("double") * 100 / F.lit(target)).alias("porcentaje"))
