"""Summary tables: status pivot and surface bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.classify import bucket_surface, surface_order


def pivot_status(df: DataFrame, key: str, status: str, statuses: Sequence[str], metrics: Mapping[str, Column],
                 no_status: str = "sin_estatus") -> DataFrame:
    """One row per key, columns `<status>__<metric>`, 0 where there is nothing. A NULL status and a NULL key are
    groups of their own.

    The statuses are given, so no extra pass looks for them, and rows are combined per key and status first.
    """
    wanted = [*statuses, no_status]
    wide = (df.withColumn(status, F.coalesce(status, F.lit(no_status))).groupBy(key).pivot(status, wanted)
            .agg(*[c.alias(name) for name, c in metrics.items()]))
    joiner = "_" if len(metrics) > 1 else None
    return wide.select(key, *[
        F.coalesce(F.col(f"`{s}{joiner + m if joiner else ''}`"), F.lit(0)).alias(f"{s.replace(' ', '_')}__{m}")
        for s in wanted for m in metrics])


def surface_summary(df: DataFrame, key: str, surface: str, dap: str, urea: str) -> DataFrame:
    """Per surface band the distinct producers, surface and tons; bands without rows are left out.

    Sort by `orden` to show the bands.
    """
    ha = F.col(surface)
    zero = F.lit(0)
    return df.filter(ha >= 0).groupBy(bucket_surface(ha).alias("rango_superficie"), surface_order(ha).alias("orden")).agg(
        F.count_distinct(key).alias("productores"), F.sum(ha).alias("superficie_total_ha"),
        F.sum(dap).alias("ton_dap_entregada"), F.sum(urea).alias("ton_urea_entregada"),
        (F.coalesce(F.sum(dap), zero) + F.coalesce(F.sum(urea), zero)).alias("ton_total_entregada"))
