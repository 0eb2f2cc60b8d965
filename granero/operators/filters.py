"""Filters, column choice, paging and option lists behind the query screens."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.functions.dates import date_bound
from granero.operators.positions import number_rows


def filter_eq(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Q1: all given equalities; an empty value means no filter."""
    for column, value in wanted.items():
        if value not in (None, ""):
            df = df.filter(F.col(column) == F.lit(value))
    return df


def filter_date_range(df: DataFrame, column: str, start: str | dt.date | None, end: str | dt.date | None) -> DataFrame:
    """Q2: inclusive day range; timestamps compare by day, unreadable bounds are ignored.

    The bounds go onto the column itself, so Parquet statistics can skip row groups.
    """
    low = start if isinstance(start, dt.date) else date_bound(start)
    high = end if isinstance(end, dt.date) else date_bound(end)
    kind = df.schema[column].dataType
    if low:
        df = df.filter(F.col(column) >= F.lit(low).cast(kind))
    if high:
        df = df.filter(F.col(column) < F.lit(high + dt.timedelta(days=1)).cast(kind))
    return df


def filter_iexact(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Q3: equal without regard to case."""
    return df if not value else df.filter(F.upper(F.col(column)) == F.upper(F.lit(value)))


def split_list(text: str | None, commas: bool = False) -> list[str]:
    """Q4: entries of a multi-line field, trimmed, blanks dropped; freight also splits commas."""
    lines = (text or "").splitlines()
    parts = [p for line in lines for p in (line.split(",") if commas else [line])]
    return [p.strip() for p in parts if p.strip()]


def filter_in_list(df: DataFrame, column: str, text: str | None, commas: bool = False) -> DataFrame:
    """Q4: rows whose value is listed; an empty list means no filter.

    The list is a literal array that is exploded where it is joined: its size is known to the planner, so the rows of
    `df` are not shuffled for it, however long it is.
    """
    values = sorted(set(split_list(text, commas)))
    if not values:
        return df
    listed = df.sparkSession.range(1, numPartitions=1).select(F.explode(F.split(F.lit("\n".join(values)), "\n")).alias(column))
    return df.join(F.broadcast(listed), column, "left_semi").select(df.columns)  # as long as the text it came from


def select_valid_columns(df: DataFrame, wanted: Sequence[str] | None, default: Sequence[str] | None = None) -> DataFrame:
    """Q5: requested columns that exist, else the defaults that exist, else all."""
    for names in (wanted, default):
        kept = [c for c in names or () if c in df.columns]
        if kept:
            return df.select(*kept)
    return df


def default_to_yesterday(df: DataFrame, column: str, end: str | None, today: dt.date) -> DataFrame:
    """Q6: without an end date, stop at the day before `today`."""
    return filter_date_range(df, column, None, end or today - dt.timedelta(days=1))


def since_first_movement(df: DataFrame, key: str, date: str, inflows: Sequence[str], today: dt.date,
                         cutoff: dt.date | None = None) -> DataFrame:
    """Q7: rows from a centre's first inflow on; a centre without inflow starts at `today`."""
    moved = F.lit(False)
    for c in inflows:
        moved = moved | (F.coalesce(F.col(c), F.lit(0)) > 0)
    first = F.min(F.when(moved, F.col(date))).over(Window.partitionBy(key))  # at most one row per day and centre
    out = (df.withColumn("primer_mov", F.coalesce(first, F.lit(today)))
           .filter(F.col(date) >= F.col("primer_mov")).select(df.columns))
    return out if cutoff is None else out.filter(F.col(date) <= F.lit(cutoff))


def filter_positive(df: DataFrame, measure: str) -> DataFrame:
    """Q9: rows with a positive value; NULL is dropped."""
    return df.filter(F.col(measure) > 0)


def only_authorised(df: DataFrame, column: str = "estatus_pedido_detalle") -> DataFrame:
    """Q10: exactly `Autorizado`."""
    return df.filter(F.col(column) == "Autorizado")


def open_date_window(df: DataFrame, column: str, after: dt.date, before: dt.date) -> DataFrame:
    """Q14: strictly inside the two dates."""
    return df.filter((F.col(column) > F.lit(after)) & (F.col(column) < F.lit(before)))


def has_coordinates(df: DataFrame) -> DataFrame:
    """Q15: centres that can be put on a map."""
    return df.filter(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())


def order_sql_style(*columns: str) -> list[Column]:
    """L1: `-name` sorts descending with NULLs first, `name` ascending with NULLs last."""
    return [F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns]


def page(df: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """L2: one page under a full order.

    Only the order columns are numbered and stored; the page's first and last order values then select its rows from
    `df`, so the table itself is neither sorted nor copied, at any depth.
    """
    start = (max(number, 1) - 1) * size
    by = order_sql_style(*order)
    names = list(dict.fromkeys(c.lstrip("-") for c in order))
    keys = number_rows(df.select(*names), by, "_n").filter(F.col("_n").between(start + 1, start + size)).select(*names, "_n")
    # rows of one page; equal order values are the same row of the page as far as the order can tell
    chosen = keys.groupBy(*names).agg(F.min("_n").alias("_n"), F.count("*").alias("_k"))
    same = F.lit(True)
    renamed = chosen.select(*[F.col(n).alias(f"_o_{n}") for n in names], "_n", "_k")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_o_{n}"))
    within = Window.partitionBy(*[f"_o_{n}" for n in names]).orderBy("_n")
    found = df.join(F.broadcast(renamed), same).withColumn("_i", F.row_number().over(within)).filter("_i <= _k")
    return found.orderBy("_n", "_i").select(df.columns)


def rows_with_summary(df: DataFrame, size: int, order: Sequence[str], summary: Mapping[str, Column]) -> DataFrame:
    """L3: the first `size` rows, each with the summary of all rows."""
    whole = df.agg(*[c.alias(n) for n, c in summary.items()])
    values = whole.first()
    return df.orderBy(*order_sql_style(*order)).limit(size).withColumns(
        {n: F.lit(values[n]).cast(whole.schema[n].dataType) for n in summary})


def clamp_page(number: int, size: int, total: int) -> int:
    """L2: page numbers outside the range go to the nearest page."""
    return min(max(number, 1), max(-(-total // size), 1))


def option_list(df: DataFrame, column: str) -> DataFrame:
    """L4: distinct non-blank values, sorted."""
    values = df.select(column).filter(F.col(column).isNotNull() & (F.col(column) != "")).distinct()
    return values.orderBy(column)


def dependent_options(df: DataFrame, column: str, chosen: Mapping[str, object]) -> DataFrame:
    """Options of one column given the choices already made in others."""
    return option_list(filter_eq(df, chosen), column)
