"""Rules that turn a value into a label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Surface bands, lower bound inclusive, upper bound exclusive.
SURFACE_BANDS = (
    (0, 5, "0 a 4"), (5, 10, "5 a 9"), (10, 15, "10 a 14"), (15, 20, "15 a 19"), (20, None, "20 o más"),
)


def classify_list(status: Column, sep: str = " ") -> Column:
    """C20: new entry when the list name says so, else (also when NULL) direct access."""
    return F.when(status.ilike("%nuevo ingreso%"), F.lit(f"NUEVO{sep}INGRESO")).otherwise(F.lit(f"ACCESO{sep}DIRECTO"))


def assign_centre(status: Column, original: Column, final: Column) -> Column:
    """C18, freight: delivered goes to the final centre, authorised to the original, else none."""
    s = F.lower(status)
    return F.when(s == "entregado", final).when(s == "autorizado", original)


def assign_centre_move(status: Column, original: Column, final: Column) -> Column:
    """C18, transfers and carry-over: anything not delivered, NULL too, stays at the original."""
    return F.when(F.lower(F.trim(status)) == "entregada", final).otherwise(original)


def bucket_surface(c: Column) -> Column:
    """Label of the surface band; negatives and NULL get none."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(SURFACE_BANDS):
        inside = c >= low if high is None else (c >= low) & (c < high)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def surface_order(c: Column) -> Column:
    """Position of the band, to sort the labels."""
    return F.when(c >= 0, F.least(F.floor(c / 5), F.lit(4))).cast("int")


def diff_category(c: Column) -> Column:
    """Size class of a difference in tons."""
    return (
        F.when(c.isNull(), F.lit("—"))
        .when(c == 0, F.lit("0.000"))
        .when(c <= -10, F.lit("> -10 ton"))
        .when(c <= -1, F.lit("< -10 ton"))
        .when(c < 0, F.lit("< -1 ton"))
        .when(c < 1, F.lit("< 1 ton"))
        .when(c < 10, F.lit("< 10 ton"))
        .otherwise(F.lit("> 10 ton"))
    )


def stock_gap_class(c: Column) -> Column:
    """Shortage or surplus, severe beyond one ton; differences within 0.01 count as none."""
    gap = F.coalesce(c, F.lit(0))
    return (
        F.when(gap < -1, F.lit("faltante_grave"))
        .when(gap < F.lit("-0.01").cast("decimal(4,2)"), F.lit("faltante_menor"))
        .when(gap > 1, F.lit("excedente_grave"))
        .when(gap > F.lit("0.01").cast("decimal(4,2)"), F.lit("excedente_menor"))
        .otherwise(F.lit("sin_diferencia"))
    )


def days_late(last_report: Column, today: dt.date) -> Column:
    """Days since the last report, 999 if none; a delay of at most one day shows as 0."""
    late = F.coalesce(F.datediff(F.lit(today), last_report), F.lit(999))
    return F.when(late <= 1, F.lit(0)).otherwise(late)


def reporting_compliance(last_report: Column, today: dt.date, *stocks: Column) -> Column:
    """True when the report is recent or all stocks are practically zero."""
    late = F.coalesce(F.datediff(F.lit(today), last_report), F.lit(999))
    empty = F.lit(True)
    for stock in stocks:
        empty = empty & (F.abs(F.coalesce(stock, F.lit(0))) < F.lit("0.01").cast("decimal(4,2)"))
    return (late <= 1) | empty
