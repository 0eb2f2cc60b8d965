"""Load of the eligibility registry from text: typed rows, rejected values, one row per receipt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import parse_date_iso_first
from granero.functions.numbers import enforce_numeric, numeric_reject_reason
from granero.functions.text import alias_columns, enforce_key, enforce_text, normalize_headers, text_reject_reason
from granero.operators.dedupe import last_per_key
from granero.schemas import REGISTRY, REGISTRY_ALIASES, text_limit
from granero.sources.sinks import align_to_schema, rejects

KEY = "acuse_estatal"


def _texts(raw: DataFrame, order: str) -> DataFrame:
    """Headers normalised and aligned to the registry, all still text, plus the order column."""
    named = alias_columns(normalize_headers(raw, "parens"), REGISTRY_ALIASES)
    have = set(named.columns)
    return named.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast("string").alias(f.name)
                          for f in REGISTRY.fields], F.col(order))


def typed_registry(raw: DataFrame, order: str) -> DataFrame:
    """Registry rows with their declared types; rows without a usable receipt are dropped and the last
    row per receipt in `order` counts, over all files together."""
    columns = []
    for f in REGISTRY.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "decimal":
            c = enforce_numeric(c, f.dataType.precision, f.dataType.scale)
        elif kind == "long":
            c = enforce_numeric(c, 18, 0).cast("bigint")
        elif kind == "date":
            c = parse_date_iso_first(c)
        elif text_limit(f):
            c = enforce_key(c, text_limit(f)) if f.name == KEY else enforce_text(c, text_limit(f))
        columns.append(c.alias(f.name))
    typed = _texts(raw, order).select(*columns, order).filter(F.col(KEY).isNotNull())
    return align_to_schema(last_per_key(typed, [KEY], [order]), REGISTRY)


def registry_rejects(raw: DataFrame, order: str) -> DataFrame:
    """Every value that was cut, or emptied because it does not fit, with the reason."""
    checks = []
    for f in REGISTRY.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "decimal":
            checks.append(("numeric", f.name, numeric_reject_reason(c, f.dataType.precision, f.dataType.scale)))
        elif f.dataType.typeName() == "long":
            checks.append(("numeric", f.name, numeric_reject_reason(c, 18, 0)))
        elif f.dataType.typeName() == "date":
            lost = (F.trim(c) != "") & parse_date_iso_first(c).isNull() & ~F.contains(c, F.lit("0000-"))
            checks.append(("date", f.name, F.when(lost, F.lit("fecha_no_valida"))))
        elif text_limit(f):
            checks.append(("text", f.name, text_reject_reason(c, text_limit(f), f.name == KEY)))
    return rejects(_texts(raw, order), KEY, checks)
