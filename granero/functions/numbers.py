"""Number cleaning: text in, exact decimals or integers out, bad input to NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDE = T.DecimalType(38, 9)
TONS = "decimal(18,3)"  # fits a long, so sums stay cheap; 10^15 tons is out of reach
BAG_TONS = "0.025"  # one bag weighs 25 kg


def _blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when((t == "") | F.lower(t).isin("none", "nan"), None).otherwise(t)


def _has_digit(c: Column) -> Column:
    """No number is without one; a failed cast costs far more than this."""
    return c.cast("string").rlike("[0-9]")


def to_number(c: Column, thousands: str = ",") -> Column:
    """Drop thousands separators; unparseable text becomes NULL."""
    n = F.replace(F.trim(c), F.lit(thousands), F.lit(""))
    return F.when(_has_digit(n), n.try_cast(WIDE))


def to_number_decimal_comma(c: Column, fill_zero: bool = False) -> Column:
    """Decimal comma to point; one caller wants NULL as 0."""
    n = F.translate(_blank_to_null(c), ",", ".").try_cast(WIDE)
    return F.coalesce(n, F.lit(0).cast(WIDE)) if fill_zero else n


def round3(c: Column) -> Column:
    """Three decimals, half-up."""
    return F.round(c.try_cast(WIDE), 3).cast(T.DecimalType(38, 3))


def to_int(c: Column, fill: int | None = None) -> Column:
    """Whole number from text such as `12` or `12.0`; fractions are cut."""
    n = F.when(_has_digit(c), c.try_cast("double").try_cast("int"))
    return n if fill is None else F.coalesce(n, F.lit(fill))


def fill_zero_numeric(c: Column) -> Column:
    """NULL or unparseable tons count as 0."""
    return F.coalesce(c.try_cast(WIDE), F.lit(0).cast(WIDE))


def enforce_numeric(c: Column, precision: int, scale: int) -> Column:
    """C11: half-up to `scale`; values that do not fit NUMERIC(p,s) become NULL."""
    return F.translate(_blank_to_null(c), ",", ".").try_cast(T.DecimalType(precision, scale))


def numeric_reject_reason(c: Column, precision: int, scale: int) -> Column:
    """Why `enforce_numeric` gave NULL, or NULL when there is nothing to report."""
    raw = F.translate(_blank_to_null(c), ",", ".")
    wide = raw.try_cast("double")
    return (
        F.when(raw.isNull() | raw.try_cast(T.DecimalType(precision, scale)).isNotNull(), None)
        .when(wide.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf")), F.lit("no_convertible"))
        .otherwise(F.lit(f"overflow_{precision}_{scale}"))
    )


def clip_to_max(c: Column, precision: int, scale: int) -> Column:
    """Two decimals, then limited to +-(10^(p-s) - 0.01)."""
    top = F.lit("9" * (precision - scale) + ".99").cast(T.DecimalType(38, 2))
    n = F.round(c.try_cast(WIDE), 2).cast(T.DecimalType(38, 2))
    return F.when(n.isNotNull(), F.greatest(F.least(n, top), -top))


def sum_tons(c: Column) -> Column:
    """Exact sum of tons in the narrow type; a sum beyond it raises instead of being cut."""
    return F.sum(c).cast(TONS)


def bags_to_tons(c: Column) -> Column:
    """Bags times 0.025, three decimals."""
    return F.round(c.cast(T.DecimalType(18, 0)) * F.lit(BAG_TONS).cast(T.DecimalType(4, 3)), 3).cast(
        T.DecimalType(18, 3)
    )


def tons_to_bags(c: Column) -> Column:
    """Tons divided by 0.025 (that is, times 40), to the nearest whole bag."""
    return F.round(c.cast(T.DecimalType(18, 3)) * 40, 0).cast("bigint")


def default_if_null(c: Column, value: int = 3) -> Column:
    """The exports mark a missing value with a literal."""
    return F.coalesce(c, F.lit(value))


def percent_of_target(value: Column, target: Column) -> Column:
    """Whole percent of the target, at most 100, 0 without a target."""
    exact = (F.coalesce(value, F.lit(0)) * 100).cast(T.DecimalType(28, 3))
    pct = F.floor(F.try_divide(exact, target.cast(T.DecimalType(20, 3))))
    return F.when(target.isNull() | (target == 0), F.lit(0)).otherwise(F.least(pct, F.lit(100))).cast("bigint")


def pending(value: Column, target: Column) -> Column:
    """What is missing to the target, never below 0."""
    return F.greatest(F.coalesce(target, F.lit(0)) - F.coalesce(value, F.lit(0)), F.lit(0))
