"""Daily grids: one row per key and calendar day, with zeros and running totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _in_long(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.precision <= 18


def counted(c: Column, kind: T.DataType) -> Column:
    """An amount in units of its last decimal: a sum of longs is far cheaper than one of decimals beyond 18 digits."""
    return (c * F.lit(10 ** kind.scale)).cast("long") if _in_long(kind) else c


def measured(total: Column, kind: T.DataType) -> Column:
    return (total.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast(kind) if _in_long(kind) else total.cast(kind)


def day_spans(facts: DataFrame, spine: DataFrame, keys: Sequence[str], measures: Sequence[str], start: dt.date,
              end: dt.date, date: str = "fecha", totals: Sequence[str] = ()) -> DataFrame:
    """J4, J5, W1 in short form: one row per key and movement day, reaching `hasta` (the day before the next one).

    `facts` has at most one row per key and day, `spine` one row per key to show. Keys outside the spine are lost,
    NULL keys never match, as in the left join from spine to facts. `totals` (amounts of `facts`, shown or not) adds running
    sums named `<measure>_acum` over the whole history: facts before `start` count as an opening amount on that day, which
    the day's own measures leave out.
    Only spine rows and movement days travel, through a single shuffle and sort; the spine's other columns ride on its own
    rows and spread over the key afterwards, so the movement days need no further join. `expand_days` fills the calendar.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    carried = [c for c in spine.columns if c not in keys]
    kind = {m: facts.schema[m].dataType for m in (*measures, *totals)}
    inside = F.col(date) >= F.lit(start)
    reach = F.col(date) <= F.lit(end) if totals else inside & (F.col(date) <= F.lit(end))
    moves = facts.filter(known & reach).select(
        *keys, F.greatest(F.col(date), F.lit(start)).alias(date), F.when(inside, 2).otherwise(1).alias("_turn"),
        *[F.when(inside, F.col(m)).alias(m) for m in measures], *[counted(F.col(m), kind[m]).alias(f"_sum_{m}") for m in totals])
    zeros = spine.select(*keys, F.lit(start).alias(date), F.lit(0).alias("_turn"), F.struct(F.lit(True).alias("_listed"), *carried).alias("_spine"))
    # a fixed partition count: adaptive coalescing would size partitions by the movement days, before they expand
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = moves.unionByName(zeros, allowMissingColumns=True).repartition(parts, *keys)
    # on `start` the spine comes first, then what came before, then the day's own facts; the last of them stands for the day
    ordered = Window.partitionBy(*keys).orderBy(date, "_turn")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    spans = rows.select(
        *keys, date, *[F.coalesce(F.col(m), F.lit(0)).cast(kind[m]).alias(m) for m in measures],
        *[measured(F.coalesce(F.sum(f"_sum_{m}").over(upto), F.lit(0)), kind[m]).alias(f"{m}_acum") for m in totals],
        F.date_sub(F.coalesce(F.lead(date).over(ordered), F.date_add(F.lit(end), 1)), 1).alias("hasta"),
        F.max("_spine").over(upto).alias("_spine"))
    return spans.filter(F.col("_spine").isNotNull() & (F.col("hasta") >= F.col(date))).select(
        *[c for c in spans.columns if c != "_spine"], *[F.col(f"_spine.{c}").alias(c) for c in carried])


def expand_days(spans: DataFrame, measures: Sequence[str], date: str = "fecha") -> DataFrame:
    """One row per day of each span; the measures count on its first day only, everything else is carried."""
    other = [c for c in spans.columns if c not in measures and c not in (date, "hasta")]
    days = spans.select(*other, *measures, F.col(date).alias("_first"),
                        F.explode(F.sequence(F.col(date), F.col("hasta"))).alias(date))
    first = F.col("_first") == F.col(date)
    return days.select(*other, date, *[
        F.when(first, F.col(m)).otherwise(F.lit(0).cast(spans.schema[m].dataType)).alias(m) for m in measures])


def on_calendar(days: DataFrame, facts: DataFrame, measures: Sequence[str], date: str = "fecha") -> DataFrame:
    """Every calendar day with the day's facts, zeros elsewhere. Both sides hold one row per day."""
    return days.select(date).join(facts, date, "left").select(
        date, *[F.coalesce(F.col(m), F.lit(0)).cast(facts.schema[m].dataType).alias(m) for m in measures])


def sum_of(*cols: Column) -> Column:
    """Sum with NULL as 0."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(c, F.lit(0))
    return total
