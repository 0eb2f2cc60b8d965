"""Text cleaning on columns, and header normalising on column names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers that the extracts use for "no value".
NULL_TOKENS = ("N/A", "NA", "n/a", "-")
MOVE_NULL_TOKENS = ("nan", "NaN", "None", "NULL", "0000-00-00")

# Words that count as true in the registry extract.
TRUE_WORDS = ("true", "t", "1", "si", "sí", "s", "y", "yes")


# ---- headers (names only, so this runs on the driver) -------------------------------------------

def strip_accents(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", name) if not unicodedata.combining(ch))


def normalize_header(name: str, style: str = "plain") -> str:
    """One header in one of the four styles the loaders use.

    plain   lower case, no accents, spaces to `_`
    strict  every run outside [a-z0-9] to one `_`, none at the ends
    parens  like plain but slashes and brackets also become `_`; parentheses stay
    letters like plain, then anything outside [a-z0-9_] is dropped
    """
    base = strip_accents(name.replace("﻿", "").strip().lower())
    if style == "plain":
        return base.replace(" ", "_")
    if style == "strict":
        return re.sub(r"[^a-z0-9]+", "_", base).strip("_")
    if style == "parens":
        return re.sub(r"_{2,}", "_", re.sub(r"[ /\\\[\]]", "_", base))
    if style == "letters":
        return re.sub(r"[^a-z0-9_]", "", base.replace(" ", "_"))
    raise ValueError(f"unknown header style {style!r}")


def normalize_headers(df: DataFrame, style: str = "plain") -> DataFrame:
    """Rename every column in the given style."""
    return df.toDF(*[normalize_header(c, style) for c in df.columns])


def alias_columns(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Known synonyms to target names; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in aliases.items() if k in df.columns})


def find_column(columns: Sequence[str], wanted: str) -> str | None:
    """Tolerant lookup. Exact after normalising, then as a part, then by all of its words."""
    target = normalize_header(wanted, "strict")
    normal = {c: normalize_header(c, "strict") for c in columns}
    tests = (
        lambda n: n == target,
        lambda n: target in n,
        lambda n: all(word in n for word in target.split("_")),
    )
    for test in tests:
        for column, name in normal.items():
            if test(name):
                return column
    return None


# ---- values -------------------------------------------------------------------------------------

def null_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """The given markers, and blank text, to NULL."""
    return F.when(F.trim(c).isin("", *tokens), None).otherwise(c)


def to_bool(c: Column) -> Column:
    """Known true words; other text is false; blank is NULL."""
    word = F.lower(F.trim(c))
    return F.when(word == "", None).otherwise(word.isin(*TRUE_WORDS))


def enforce_text(c: Column, max_len: int) -> Column:
    """Trimmed, blank to NULL, cut at `max_len`."""
    t = F.trim(c)
    return F.when(t == "", None).otherwise(F.substring(t, 1, max_len))


def enforce_key(c: Column, max_len: int) -> Column:
    """As `enforce_text`, but a key that is too long becomes NULL (its row is dropped)."""
    t = F.trim(c)
    return F.when((t == "") | (F.length(t) > max_len), None).otherwise(t)


def text_reject_reason(c: Column, max_len: int, is_key: bool = False) -> Column:
    """Reason to report for over-long text."""
    prefix = "pk_excede_varchar_" if is_key else "truncado_varchar_"
    return F.when(F.length(F.trim(c)) > max_len, F.lit(f"{prefix}{max_len}"))


def coalesce_prefix(df: DataFrame, prefix: str) -> Column:
    """First non-blank value among the columns whose name starts with `prefix`."""
    found = [c for c in df.columns if c.startswith(prefix)]
    if not found:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")) for c in found])


def full_name(given: Column, first: Column, second: Column) -> Column:
    """Name and surnames; a blank second surname is left out, a NULL first part gives NULL."""
    tail = F.when(F.trim(F.coalesce(second, F.lit(""))) == "", F.lit("")).otherwise(F.concat(F.lit(" "), second))
    return F.concat(given, F.lit(" "), first, tail)


def sex_from_curp(c: Column) -> Column:
    """The 11th character of the person key."""
    ch = F.substring(F.upper(c), 11, 1)
    return F.when(ch == "", None).otherwise(ch)


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 of all columns as text joined by `|`; NULL counts as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def normalize_report_text(df: DataFrame, key: str) -> DataFrame:
    """Centre key trimmed and upper, every other text column trimmed and lower."""
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.withColumns({
        c: F.upper(F.trim(F.col(c))) if c == key else F.lower(F.trim(F.col(c))) for c in df.columns if c in texts
    })


def directory_text(c: Column) -> Column:
    """Directory fields are upper case, blank or NULL is N/A."""
    t = F.upper(F.trim(c))
    return F.when(t.isNull() | (t == ""), F.lit("N/A")).otherwise(t)


def file_safe(c: Column) -> Column:
    """K2: lower case, Spanish accents removed, spaces to `_`, for folder names."""
    plain = F.translate(F.lower(F.trim(c)), "áéíóúüñ", "aeiouun")
    return F.regexp_replace(plain, r"\s+", "_")
