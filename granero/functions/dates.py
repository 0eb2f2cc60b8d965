"""Date and time parsing from text, and calendar arithmetic."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The order in which date layouts are tried. Day first wins over month first.
DATE_FORMATS = (
    "yyyy-M-d", "yyyy/M/d",
    "d/M/yyyy", "d/M/yy",
    "d-M-yyyy", "d-M-yy",
    "M/d/yyyy", "M/d/yy",
)
# Date-and-time layouts of the freight extract.
TIME_FORMATS = ("d/M/yy H:m", "d/M/yyyy H:m", "yyyy-M-d H:m:s")
SENTINEL = dt.date(1900, 1, 1)


def _short_year(t: Column, fmt: str) -> Column:
    """Two-digit years 69-99 belong to the 1900s."""
    if "yyyy" in fmt:
        return t
    return F.when(F.year(t) >= 2069, t - F.make_ym_interval(F.lit(100))).otherwise(t)


# What text each part of a layout can be read from. A text of another shape, or with no such day or month, fits
# no layout; it is left out by pattern, since each failed try of a layout costs far more than the match.
_PARTS = {"y": "[0-9]{2}", "yyyy": "[+-]?[0-9]{4,}", "M": "0*(?:1[0-2]|[1-9])", "d": "0*(?:3[01]|[12][0-9]|[1-9])"}


def _shape(fmt: str) -> str:
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z])", fmt)
    return "^" + "".join(_PARTS.get(a + b) or _PARTS.get(a, "[0-9]+") if a else re.escape(other) for a, b, other in parts) + "$"


def _read(t: Column, fmt: str) -> Column:
    """`t` by one layout, NULL where it does not fit."""
    return F.when(t.rlike(_shape(fmt)), _short_year(F.try_to_timestamp(t, F.lit(fmt)), fmt))


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """C14: the first layout that fits; anything else is NULL."""
    t = F.trim(c)
    return F.coalesce(*[_read(t, f).cast("date") for f in formats])


def parse_timestamp(c: Column, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """As `parse_date` with a time of day; a zero date (`0000`) is NULL."""
    t = F.trim(c)
    parsed = F.coalesce(*[_read(t, f).cast("timestamp_ntz") for f in formats])
    return F.when(~F.contains(t, F.lit("0000-")), parsed)


def parse_date_iso_first(c: Column) -> Column:
    """Cut the time of day, try ISO, then day-first layouts."""
    day = F.split(F.trim(c), r"\s+")[0]
    return parse_date(day, ("yyyy-MM-dd", "d/M/yyyy", "d/M/yy", "d-M-yyyy", "d-M-yy", "yyyy/M/d"))


def parse_date_or_sentinel(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """C17: unusable dates become 1900-01-01."""
    return F.coalesce(parse_date(c, formats), F.lit(SENTINEL))


def replaced_dates(df: DataFrame, key: str, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """C17: the log beside the sentinel: key and text of every date that `parse_date_or_sentinel` replaced."""
    return df.filter(parse_date(F.col(column), formats).isNull()).select(
        F.col(key).cast("string").alias("clave"), F.lit(column).alias("columna"), F.col(column).alias("valor"))


def days_elapsed(delivered: Column, published: Column) -> Column:
    """Days from publication to delivery, counting both ends."""
    return F.datediff(delivered, published) + 1


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def iso_week_label(d: Column) -> Column:
    """ISO week as `YYYY-WW`."""
    return F.concat(iso_year(d).cast("string"), F.lit("-"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def week_ending_saturday(d: Column) -> Column:
    """The Saturday that closes the week of `d` (a Saturday is its own)."""
    return F.next_day(F.date_sub(d, 1), "SAT")


def date_bound(value: str | None) -> dt.date | None:
    """Q2: a filter bound given as d/m/Y or ISO; anything else is ignored."""
    if not value:
        return None
    for fmt in ("%d/%m/%Y", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(str(value).strip(), fmt).date()
        except ValueError:
            continue
    return None
