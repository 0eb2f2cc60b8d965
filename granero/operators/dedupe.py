"""One row per key, and corrections between tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.distinct()
    lead = [c for c in order if c not in keys]
    picked = df.groupBy(*keys).agg(agg(F.struct(*lead, *rest)).alias("r"))
    return picked.select([F.col(c) if c in keys else F.col(f"r.`{c}`") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key by `order` (NULL first), ties settled by the remaining columns.

    A minimum over a struct is combined before the shuffle, so a key that holds a large share of the rows sends one
    row per input split, where a window would gather all of its rows in one task.
    """
    return _pick(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key by `order`; see `first_per_key`."""
    return _pick(df, keys, order, F.max)


def rows_absent(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of `df` whose key is not in `other`; a NULL key is kept."""
    listed = other.select(F.col(other_key or key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(listed, key, "left_anti").select(df.columns)


def rows_present(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of `df` whose key is in `other`, as one semi join."""
    return df.join(other.select(F.col(other_key or key).alias(key)), key, "left_semi").select(df.columns)


def corrections_win(base: DataFrame, corrected: DataFrame, key: str) -> DataFrame:
    """Base rows with a corrected key go, all corrected rows come in."""
    return rows_absent(base, corrected, key).unionByName(corrected, allowMissingColumns=True)


def update_columns(df: DataFrame, source: DataFrame, key: Column, source_key: Column, values: Mapping[str, Column],
                   when: Column | None = None, empty: str = "keep") -> DataFrame:
    """Set columns of `df` from the row of `source` with the same key, in one join.

    The source is reduced to one row per key first (the least by its values, all columns of one row together), so rows
    of `df` are never multiplied. Keys may be expressions (`upper(trim(x))`). `empty` says what a NULL in the source
    does: `keep` leaves the column alone, `set` empties it; keys that the source lacks change nothing.
    """
    picked = F.struct(*[v.alias(c) for c, v in values.items()])
    usable = F.lit(True) if empty == "set" else ~F.forall(F.array(*[v.isNull() for v in values.values()]), lambda n: n)
    fresh = source.filter(source_key.isNotNull() & usable).groupBy(source_key.alias("_clave")).agg(F.min(picked).alias("_nuevo"))
    joined = df.withColumn("_clave", key).join(fresh, "_clave", "left")
    met = F.col("_nuevo").isNotNull()
    if when is not None:
        met = met & F.coalesce(when, F.lit(False))
    return joined.withColumns({
        c: F.when(met & (F.lit(empty == "set") | F.col(f"_nuevo.{c}").isNotNull()), F.col(f"_nuevo.{c}")).otherwise(F.col(c))
        for c in values}).select(df.columns)


def update_from(df: DataFrame, source: DataFrame, key: Column, source_key: Column, column: str, value: Column,
                when: Column | None = None, empty: str = "keep") -> DataFrame:
    """J11, J12 for one column; see `update_columns`."""
    return update_columns(df, source, key, source_key, {column: value}, when, empty)


def set_where(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """Constant or computed update of the rows that match; NULL conditions do not match."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def differs(a: Column, b: Column) -> Column:
    """Q11: IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def difference_report(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows present on both sides where one of `columns` differs; two NULLs are equal."""
    other = right.select(key, *[F.col(c).alias(f"{c}_ref") for c in columns])
    any_diff = F.lit(False)
    for c in columns:
        any_diff = any_diff | differs(F.col(c), F.col(f"{c}_ref"))
    return left.join(other, key, "inner").filter(any_diff)


def map_lookup(df: DataFrame, lookup: DataFrame, key: str, columns: Mapping[str, str], order: str) -> DataFrame:
    """Overwrite columns from a key-value table, NULL when the key is absent; the last value per key counts."""
    last = last_per_key(lookup.select(key, order, *columns.values()), [key], [order])
    renamed = last.select(key, *[F.col(v).alias(f"_{k}") for k, v in columns.items()])
    kept = df.drop(*columns).join(renamed, key, "left")
    return kept.withColumnsRenamed({f"_{k}": k for k in columns}).select(df.columns)


def full_outer_by_date(left: DataFrame, right: DataFrame, date: str = "fecha") -> DataFrame:
    """Two daily series side by side, missing values 0."""
    joined = left.join(right, date, "full")
    return joined.select(date, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in joined.columns if c != date])


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q12: NULL count per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Q12: raise before anything is written when a mandatory column has NULLs."""
    counts = check_not_null(df, columns).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"load refused, empty values in {bad}")


def bad_dates(df: DataFrame, column: str, fmt: str) -> DataFrame:
    """Q13: rows whose text does not follow the layout."""
    return df.filter(F.col(column).isNotNull() & F.try_to_timestamp(F.col(column), F.lit(fmt)).isNull())
